"""Resume from earlier output, count pairs, merge pair sets."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from sftprep.session import cut_lineage, ensure_library_on_workers

KEYS = ("source", "chunk_id")


def pairs_per_chunk(pairs: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """A1: ``keys…, n_pairs`` (hash aggregate, partial counts map-side).

    The key includes ``chunk_id``, so a source holding a third of all pairs
    still spreads over many reducers.
    """
    return pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_pairs"))


def done_chunks(pairs: DataFrame, generate_num: int, keys: Sequence[str] = KEYS) -> DataFrame:
    """Chunk keys that already have at least ``generate_num`` pairs."""
    return pairs_per_chunk(pairs, keys).filter(F.col("n_pairs") >= generate_num).select(*keys)


def _broadcast_budget(spark) -> int:
    raw = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    try:
        v = int(str(raw).lower().rstrip("b"))
    except ValueError:
        v = 10 * 1024 * 1024
    return max(v, 0)


def skip_done_chunks(
    chunks: DataFrame,
    pairs: DataFrame | None,
    generate_num: int,
    keys: Sequence[str] = KEYS,
    broadcast_bytes: int | None = None,
    match_chunk_text: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """Chunks whose existing pair count is below ``generate_num``.

    Placed *before* any model call.  The done-key side is broadcast only
    after measuring it (rows and key bytes) against the budget; beyond the
    budget a Bloom filter of the done keys keeps the chunk rows where they were
    scanned (``_skip_by_filter``).

    With ``partitions`` the result comes out hash-partitioned on the keys into
    exactly that many partitions (the model-call spread), and a shuffled join
    reuses that partitioning: the join is written as a left-outer join with a
    done flag (same rows as a left-anti join, done keys being unique) so the
    optimizer keeps it above the spread, and the small done-key side is
    repartitioned to match.  Chunk rows then move once, not twice.

    With ``match_chunk_text`` the key also includes ``md5(chunk)``, so pairs
    made under other chunk settings (same chunk id, different text) do not
    count as done.
    """
    keys = list(keys)
    if match_chunk_text and pairs is not None:
        chunks = chunks.withColumn("_chunk_md5", F.md5(F.col("chunk")))
        pairs = pairs.withColumn("_chunk_md5", F.md5(F.col("chunk")))
        return skip_done_chunks(chunks, pairs, generate_num, keys + ["_chunk_md5"],
                                broadcast_bytes, partitions=partitions).drop("_chunk_md5")
    spread = chunks.repartition(partitions, *keys) if partitions else chunks
    if pairs is None:
        return spread
    done = done_chunks(pairs, generate_num, keys)
    budget = _broadcast_budget(chunks.sparkSession) if broadcast_bytes is None else broadcast_bytes
    size = done.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.length(F.col(keys[0]).cast("string"))), F.lit(0)).alias("key_bytes"),
    ).first()
    est = int(size["key_bytes"]) + 48 * int(size["rows"])
    if budget > 0 and est <= budget:
        return spread.join(F.broadcast(done), on=keys, how="left_anti")
    if partitions:
        flagged = done.withColumn("_done", F.lit(True)).repartition(partitions, *keys)
        return (
            spread.join(flagged, on=keys, how="left")
            .filter(F.col("_done").isNull())
            .drop("_done")
        )
    return _skip_by_filter(chunks, cut_lineage(done), int(size["rows"]), keys, max(budget, 1))


def _skip_by_filter(chunks: DataFrame, done: DataFrame, n_done: int, keys: list[str], budget: int) -> DataFrame:
    """Chunks that are not done, without a shuffle of chunk rows where that is possible.

    A Bloom filter of the done keys, of at most FILTER_BYTES, tells which chunks may be done; all
    others stay where they were scanned.  Of the possible ones only the keys are joined
    with the exact keys, which leaves the filter's few mistakes.  If these fit the
    broadcast budget, chunk rows meet them by broadcast; if a filter of bounded size
    makes too many, the possible rows go through a shuffled join.
    """
    maybe = bloom_filter(done, n_done, keys)
    tagged = chunks.withColumn("_maybe", maybe(*[F.col(k) for k in keys]))
    mistakes = cut_lineage(tagged.filter("_maybe").select(*keys).distinct().join(done, keys, "left_anti"))
    size = mistakes.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.length(F.col(keys[0]).cast("string"))), F.lit(0)).alias("bytes")).first()
    if int(size["bytes"]) + 48 * int(size["rows"]) <= budget:
        # null keys match nothing that is done
        flags = F.broadcast(mistakes.withColumn("_todo", F.lit(True)))
        match = [F.col(f"c.{k}").eqNullSafe(F.col(f"m.{k}")) for k in keys]
        both = tagged.alias("c").join(flags.alias("m"), reduce(lambda x, y: x & y, match), "left")
        return both.filter(~F.col("_maybe") | F.col("_todo").isNotNull()).select(*[F.col(f"c.{c}") for c in chunks.columns])
    rest = tagged.filter("_maybe").join(done, keys, "left_anti")
    return tagged.filter("NOT _maybe").unionByName(rest.select(*tagged.columns)).drop("_maybe")


#: bits per key and hash functions of the resume filter (1 % mistakes), and its largest size
FILTER_BITS, FILTER_HASHES, FILTER_BYTES = 10, 7, 64 * 1024 * 1024


def bloom_filter(keys_df: DataFrame, n: int, keys: Sequence[str], max_bytes: int = FILTER_BYTES) -> Callable[..., Column]:
    """A Bloom filter built by Spark over the key columns; returns ``maybe(*columns)``, true for every key that is in it.

    Its 64-bit words are or-ed together map-side and by word, so what reaches the
    driver is bounded by ``max_bytes`` whatever the number of keys; beyond that size the
    filter makes more mistakes, never misses.
    """
    spark = keys_df.sparkSession
    ensure_library_on_workers(spark)
    words = max(16, min(n * FILTER_BITS // 64 + 1, max_bytes // 8))
    columns = [F.col(k) for k in keys]
    ones = F.array(*[F.pmod(_hash(columns, i), F.lit(words * 64)) for i in range(FILTER_HASHES)])
    bits = keys_df.select(F.explode(ones).alias("at"))
    merged = bits.groupBy(F.floor(F.col("at") / 64).cast("long").alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("v")
    )
    table = np.zeros(words, dtype=np.int64)
    for part in merged.select("w", "v").toArrow().to_batches():  # at most ``words`` rows
        table[part.column(0).to_numpy()] = part.column(1).to_numpy()
    shared = spark.sparkContext.broadcast(table.view(np.uint64))

    @arrow_udf("boolean")
    def held(hashes: pa.Array) -> pa.Array:
        found = np.ones(len(hashes), dtype=bool)
        flat = hashes.flatten().to_numpy().reshape(len(hashes), FILTER_HASHES)
        for i in range(FILTER_HASHES):
            at = flat[:, i]
            found &= (shared.value[at // 64] >> (at % 64).astype(np.uint64)) & np.uint64(1) == 1
        return pa.array(found)

    def maybe(*cols: Column) -> Column:
        return held(F.array(*[F.pmod(_hash(cols, i), F.lit(words * 64)) for i in range(FILTER_HASHES)]))

    return maybe


def _hash(cols: Sequence[Column], i: int) -> Column:
    return F.xxhash64(F.lit(i), *cols)


def merge_pairs(*pair_sets: DataFrame) -> DataFrame:
    """Union of all pair sets by column name (every row of every set)."""
    if not pair_sets:
        raise ValueError("nothing to merge")
    return reduce(lambda a, b: a.unionByName(b), pair_sets)
