"""Seeded sampling, global row positions, contiguous shards,
conversation extension.

Global positions (O2) never use an unpartitioned window over the data:

1. ``orderBy`` range-partitions and sorts on the (unique) order key;
2. ``monotonically_increasing_id`` then encodes (partition, position in
   partition); the sorted result is saved with a reliable checkpoint so the
   range bounds are computed exactly once even if executors are lost;
3. per-partition counts (one row per partition, a proven small bound) give
   prefix offsets that are broadcast back.

Cost: one range shuffle plus one write of the ranked rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sftprep.session import cut_lineage

_LOW_BITS = (1 << 33) - 1  # monotonically_increasing_id: partition << 33 | position


def _cols(cols: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def with_row_index(
    df: DataFrame, order: Sequence[Column | str], index_col: str = "row_idx"
) -> DataFrame:
    """O2: 0-based position of each row in the order given by ``order``.

    ``order`` must be unique per row (append a key column to break ties) so the
    position is deterministic.
    """
    spark = df.sparkSession
    ordered = df.orderBy(*_cols(order)).withColumn("_mid", F.monotonically_increasing_id())
    saved = cut_lineage(ordered)
    part = F.shiftright(F.col("_mid"), 33)
    counts = saved.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n")).collect()
    # one row per partition: bounded by the partition count, not the data
    counts.sort(key=lambda r: r["_part"])
    offsets, run = [], 0
    for r in counts:
        offsets.append((int(r["_part"]), run))
        run += int(r["_n"])
    off_df = spark.createDataFrame(
        offsets or [(0, 0)],
        T.StructType([T.StructField("_part", T.LongType()), T.StructField("_off", T.LongType())]),
    )
    return (
        saved.withColumn("_part", part)
        .join(F.broadcast(off_df), "_part")
        .withColumn(index_col, F.col("_off") + F.col("_mid").bitwiseAND(F.lit(_LOW_BITS)))
        .drop("_part", "_off", "_mid")
    )


def seeded_key(seed: int | str, key: Column | str) -> Column:
    """md5 of ``seed:key`` - the same value in Spark and in SQL engines."""
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat_ws(":", F.lit(str(seed)), k.cast("string")))


def _hash_threshold(fraction: float) -> str | None:
    """32-hex-digit md5 value below which ``fraction`` of uniform hashes fall (None: all)."""
    if fraction >= 1.0:
        return None
    t = int(fraction * (1 << 128))
    return f"{max(t, 1):032x}"


def seeded_sample(
    df: DataFrame,
    n: int,
    key: Column | str,
    seed: int = 42,
    strict: bool = True,
    distinct: bool = False,
    oversample: float = 4.0,
) -> DataFrame:
    """O1: the ``n`` rows with the smallest ``md5(seed:key)`` (no replacement).

    Exact threshold sampling instead of a plain ``orderBy.limit``, which would
    ship every partition's local top ``n`` to one task (partitions × n rows at
    scale):

    1. estimate the number of keys (HyperLogLog, partially aggregated);
    2. keep rows whose hash is below the threshold that admits about
       ``oversample × n`` keys - a map-only filter, applied before ``distinct``;
    3. take the exact top ``n`` of those candidates.  Every row left out has
       a larger hash than every candidate, so the result equals the global
       top ``n``; if fewer than ``n`` candidates survive, the threshold widens
       and step 3 repeats.

    ``n`` larger than the number of keys is an error unless ``strict`` is False.
    """
    k = F.col(key) if isinstance(key, str) else key
    h = seeded_key(seed, k)
    est = int(df.agg(F.approx_count_distinct(k).alias("d")).first()["d"] or 0)
    fraction = oversample * n / est if est else 1.0
    while True:
        t = _hash_threshold(fraction)
        cand = df if t is None else df.filter(h < F.lit(t))
        if distinct:
            cand = cand.distinct()
        out = cand.orderBy(h, k).limit(n)
        got = out.count()
        if got >= n or t is None:
            break
        fraction *= 4
    if strict and got < n:
        raise ValueError(f"sample of {n} rows requested but only {got} rows exist")
    return out


def shard_size(n_rows: int, num_shards: int) -> int:
    if num_shards <= 0:
        raise ValueError("num_shards must be positive")
    return math.ceil(n_rows / num_shards) if n_rows else 0


def assign_shards(
    df: DataFrame, order: Sequence[Column | str], num_shards: int, index_col: str = "row_idx",
    shard_col: str = "shard",
) -> tuple[DataFrame, int]:
    """A3: contiguous shards, ``size = ceil(n / num)``; returns (rows with ``shard``, n).

    Shard ``i`` holds positions ``[i*size, min((i+1)*size, n))``; trailing
    shards may be empty.
    """
    ranked = with_row_index(df, order, index_col)
    n = ranked.count()
    size = shard_size(n, num_shards)
    shard = F.floor(F.col(index_col) / F.lit(max(size, 1))).cast("int")
    return ranked.withColumn(shard_col, shard), n


def shard_file_name(name: str, shard: Column, num_shards: int) -> Column:
    """``{name}-{i:05d}-of-{n:05d}.parquet`` as a Column."""
    return F.concat(
        F.lit(f"{name}-"), F.lpad(shard.cast("string"), 5, "0"),
        F.lit(f"-of-{num_shards:05d}.parquet"),
    )


def shard_manifest(
    spark, sharded: DataFrame, name: str, num_shards: int
) -> DataFrame:
    """A4 + S12 manifest: every shard 0..num-1 with its file name and row count (0 if empty)."""
    counts = sharded.groupBy("shard").agg(F.count(F.lit(1)).alias("n_rows"))
    return (
        spark.range(num_shards).select(F.col("id").cast("int").alias("shard"))
        .join(counts, "shard", "left")
        .select(
            "shard",
            shard_file_name(name, F.col("shard"), num_shards).alias("file_name"),
            F.coalesce(F.col("n_rows"), F.lit(0)).cast("long").alias("n_rows"),
        )
    )


def extend_conversations(
    df: DataFrame,
    id_col: str,
    conv_col: str,
    k: int,
    seed: int = 3407,
) -> DataFrame:
    """Append the conversations of ``k-1`` seeded shuffled copies, by position.

    Row at position ``p`` (in ``id_col`` order) gets the conversation of the
    row at position ``p`` of each shuffled copy ``i`` (order ``md5(seed+i:id)``).
    The input is saved once; only its ids are ranked, all copies in one sort on
    ``(copy, md5, id)``.  The partners of all copies are matched with one
    position join and fetched with one join on id; each row's own conversation
    and its partners form a group of exactly ``k`` (a fixed bound).
    ``id_col`` must be unique: rows that share an id would collapse.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    if k == 1:
        return df
    df = cut_lineage(df)
    sizes = df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(id_col).alias("d")).first()
    if sizes["n"] != sizes["d"]:
        raise ValueError(f"{id_col} is not unique: {sizes['n']} rows, {sizes['d']} ids")
    copies = df.select(id_col, F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_copy"))
    shuffled = F.md5(F.concat_ws(":", (F.lit(seed) + F.col("_copy")).cast("string"), F.col(id_col).cast("string")))
    copies = copies.withColumn("_h", F.when(F.col("_copy") > 0, shuffled).otherwise(F.lit("")))
    ranked = with_row_index(copies, ["_copy", "_h", id_col], "_idx")
    ranked = ranked.withColumn("_pos", F.col("_idx") - F.col("_copy") * F.lit(sizes["n"]))
    base = ranked.filter("_copy = 0").select(id_col, "_pos")
    partners = ranked.filter("_copy > 0").select("_pos", F.col(id_col).alias("_other"), "_copy")
    pairs = base.join(partners, "_pos")
    fetched = pairs.join(
        df.select(F.col(id_col).alias("_other"), F.col(conv_col).alias("_conv")), "_other"
    ).select(id_col, "_copy", "_conv")
    own = df.select(F.col(id_col), F.lit(0).alias("_copy"), F.col(conv_col).alias("_conv"))
    # each row's own conversation (copy 0) and its k-1 partners: a group of exactly k
    extended = (
        own.unionByName(fetched)
        .groupBy(id_col)
        .agg(F.sort_array(F.collect_list(F.struct("_copy", "_conv"))).alias("_parts"))
        .select(id_col, F.flatten(F.transform("_parts", lambda p: p["_conv"])).alias(conv_col))
    )
    others = [c for c in df.columns if c not in (id_col, conv_col)]
    if others:
        extended = df.select(id_col, *others).join(extended, id_col)
    return extended.select(*df.columns)
