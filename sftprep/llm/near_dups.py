"""Operator 1: MinHash near-dedup by a multi-index Hamming join.

A document's set is its distinct word shingles, as 64-bit hashes.  SIGNATURE
minhashes, cut to 16 bits, form its signature: similar sets differ in few
positions.  INDEXED of them are split into CHUNKS of WIDTH positions.  Two
of these that differ in fewer than ``CHUNKS * 2`` positions agree in some
chunk up to one position (pigeonhole), so every chunk is filed once for each
position that may be wrong, with that position left out: all pairs below that
distance share a key.  At similarity 0.8 a pair beyond it still shares a key
unless all CHUNKS chunks have two errors, which happens to one pair in 10**7.

Pairs are not listed.  Exact copies are folded first.  Within a key, every
document is compared with the smallest one; verified links give components.
Only keys that still hold several components go on: signatures there are
compared in bounded blocks, each pair at its first shared key only, and yield
(document, other component) combinations; these are compared exactly, on full
sets, with all members of that component.  So no link is lost, no key or
partner count is capped, and groups of any size are dealt out in blocks by
measured weight.

Defined results: null or empty texts have an empty set and link with nothing;
a text of fewer words than a shingle is one shingle, its whole sequence; a null
doc_id takes no part (component null, kept); rows that share a doc_id are one
document, and if their texts differ each row is placed by its own text; an
empty table gives no rows; only the key and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sftprep.llm.common import WordHashes, column, list_array, mixed, ship, stored, table, utf8_values

CHUNKS, WIDTH = 12, 5
INDEXED = CHUNKS * WIDTH
#: all positions: those of the index, and more that only sharpen the distance of candidates
SIGNATURE = 128
#: signature positions that a pair of at least 80 % similarity may differ in: 26 expected, 5 deviations above
MAX_DISTANCE = 49
#: rows of a key that are compared at once, and shingles that one task compares at once
BLOCK = 512
WEIGHT = 1_000_000
_rng = np.random.default_rng(20240229)
FACTORS = _rng.integers(1, 2**63, SIGNATURE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
TERMS = _rng.integers(0, 2**63, SIGNATURE, dtype=np.uint64)
TAGS = _rng.integers(0, 2**63, (CHUNKS, WIDTH), dtype=np.uint64)
STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct 64-bit shingles of a document's word hashes."""
    n = len(hashes)
    if not n:
        return np.empty(0, dtype=np.int64)
    short = n < size
    acc = np.full(1 if short else n - size + 1, np.uint64(n if short else 0))
    for k in range(n if short else size):
        acc = mixed(acc * STEP + (hashes[k : k + 1] if short else hashes[k : k + n - size + 1]))
    return np.unique(acc.view(np.int64))


def signature(items: np.ndarray) -> np.ndarray:
    low = np.full(SIGNATURE, np.uint64(2**64 - 1))
    values = items.view(np.uint64)
    for i in range(0, len(values), 512):
        part = values[None, i : i + 512] * FACTORS[:, None] + TERMS[:, None]
        np.minimum(low, part.min(1), out=low)
    return mixed(low).astype(np.uint16)


def keys_of(signatures: np.ndarray) -> np.ndarray:
    """The INDEXED keys of each signature: a chunk without one of its positions."""
    n = len(signatures)
    chunks = signatures[:, :INDEXED].reshape(n, CHUNKS, WIDTH).astype(np.uint64)
    out = np.empty((n, CHUNKS, WIDTH), dtype=np.uint64)
    for j in range(WIDTH):
        packed = np.zeros((n, CHUNKS), dtype=np.uint64)
        for k in range(WIDTH):
            if k != j:
                packed = packed << np.uint64(16) | chunks[:, :, k]
        out[:, :, j] = mixed(packed ^ TAGS[None, :, j])
    return out.reshape(n, INDEXED).view(np.int64)


def fingerprints(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(id, n, f1, f2, sig) for every row; f1 and f2 are 128 bits of the whole set."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        words = WordHashes()
        for batch in batches:
            n, prints, sigs = [], [], []
            for t in utf8_values(column(batch, "t")):
                items = shingles(words.of(t.lower().split()), size)
                n.append(len(items))
                prints.append(xxhash.xxh3_128_digest(items.tobytes()))
                sigs.append(signature(items).tobytes())
            both = np.frombuffer(b"".join(prints), dtype="<i8").reshape(-1, 2)
            arrays = [column(batch, "id"), pa.array(n, pa.int64()), pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(sigs, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "n", "f1", "f2", "sig"])

    picked = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("t"))
    return picked.mapInArrow(rows, "id long, n long, f1 long, f2 long, sig binary")


def sets_of(docs: DataFrame, size: int) -> DataFrame:
    """(id, f1, f2, set) for rows (id, t)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        words = WordHashes()
        for batch in batches:
            ids = column(batch, "id")
            for start in range(0, len(ids), 200):
                part = column(batch, "t").slice(start, 200)
                items = [shingles(words.of(t.lower().split()), size) for t in utf8_values(part)]
                both = np.frombuffer(b"".join(xxhash.xxh3_128_digest(i.tobytes()) for i in items), dtype="<i8").reshape(-1, 2)
                arrays = [ids.slice(start, 200), pa.array(both[:, 0]), pa.array(both[:, 1]), list_array(items, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=["id", "f1", "f2", "set"])

    return docs.mapInArrow(rows, "id long, f1 long, f2 long, set array<long>")


def matrix(sigs: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(sigs.to_pylist()), dtype=np.uint16).reshape(-1, SIGNATURE)


def filed(nodes: DataFrame) -> DataFrame:
    """(key, id): each node under all its keys."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = column(batch, "id").to_numpy(zero_copy_only=False)
            for i in range(0, len(ids), 2_000):
                keys = keys_of(matrix(column(batch, "sig").slice(i, 2_000)))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(ids[i : i + 2_000], INDEXED))], names=["key", "id"])

    return nodes.select("id", "sig").mapInArrow(rows, "key long, id long")


def components(links: DataFrame) -> DataFrame:
    """(id, comp) of all linked ids; comp is the smallest id reachable.

    Alternating large-star and small-star steps; each round is written to the
    shared folder, and the rounds end when an edge count and checksum stay.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).filter("hi <> lo").distinct(), "links")
    state = None
    while True:
        both = edges.union(edges.select("lo", "hi")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        # stored, as it is read three times: else one plan holds each part of it as often
        large = stored(both.join(least, "u").filter("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct(), "large-star")
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        others = large.join(low, "hi").filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        edges = stored(others.union(low.select("hi", "m")).toDF("hi", "lo").distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.toDF("id", "comp")
        state = now


def linked(combos: DataFrame, comps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of (x, comp) combinations: x with a member of comp, on full sets.

    One link for each combination and part of a component is enough.  Members
    and documents are dealt to tasks in parts of about WEIGHT shingles.
    """
    sizes = sets.select("id", F.size("set").cast("long").alias("n"))
    members = comps.join(combos.select("comp").distinct(), "comp", "left_semi")
    inside = members.join(sizes, "id").groupBy("comp").agg(F.sum("n").alias("w"))
    outside = combos.join(sizes, combos["x"] == sizes["id"]).groupBy("comp").agg(F.sum("n").alias("wx"), F.count("*").alias("k"))
    plan = inside.join(outside, "comp").select(
        "comp", F.ceil(F.col("w") / WEIGHT).alias("parts"), F.ceil(F.col("wx") / WEIGHT).alias("turns"), "w", "wx"
    )
    plan = stored(plan, "dealt")
    total = plan.agg(F.sum(F.col("w") * F.col("turns") + F.col("wx") * F.col("parts"))).first()[0] or 0
    packs = max(1, -(-int(total) // WEIGHT))
    deal = F.pmod(F.xxhash64("comp", "part", "turn"), F.lit(packs)).alias("pack")
    left = members.join(plan, "comp").join(sets, "id").select(
        "comp", "id", "set", F.pmod(F.xxhash64("id"), "parts").alias("part"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("turns") - 1)).alias("turn")
    )
    right = combos.join(plan, "comp").join(sets.toDF("x", "items"), "x").select(
        "comp", F.col("x").alias("id"), F.col("items").alias("set"), F.pmod(F.xxhash64("x"), "turns").alias("turn"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")
    )

    def compared(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        units: dict[tuple, list[int]] = {}
        ids, items = _rows(mine)
        for i, u in enumerate(zip(*(mine.column(c).to_pylist() for c in ("comp", "part", "turn")))):
            units.setdefault(u, []).append(i)
        index: dict[tuple, tuple] = {}
        a, b = [], []
        other_ids, others = _rows(theirs)
        for k, u in enumerate(zip(*(theirs.column(c).to_pylist() for c in ("comp", "part", "turn")))):
            own = units.get(u, [])
            if not own:
                continue
            x = others[k]
            if len(own) < 4:
                common = np.array([_common(x, items[i]) for i in own])
            else:
                if u not in index:
                    flat = np.concatenate([items[i] for i in own])
                    owner = np.repeat(np.arange(len(own)), [len(items[i]) for i in own])
                    order = np.argsort(flat, kind="stable")
                    index[u] = (flat[order], owner[order])
                flat, owner = index[u]
                lo, hi = np.searchsorted(flat, x, "left"), np.searchsorted(flat, x, "right")
                count = hi - lo
                at = np.repeat(lo - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
                common = np.bincount(owner[at], minlength=len(own))
            sizes = np.array([len(items[i]) for i in own])
            good = np.flatnonzero(100 * common >= percent * (sizes + len(x) - common))
            if good.size:
                a.append(other_ids[k])
                b.append(min(ids[own[i]] for i in good))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    left, right = left.select("*", deal), right.select("*", deal)
    pairs = left.toDF(*left.columns).groupBy("pack").cogroup(right.toDF(*right.columns).groupBy("pack"))
    return pairs.applyInArrow(compared, "a long, b long")


def _rows(t: pa.Table) -> tuple[list[int], list[np.ndarray]]:
    lists = t.column("set").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) and lists.num_chunks else lists
    if not len(t):
        return [], []
    offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
    return t.column("id").to_pylist(), [flat[x:y] for x, y in zip(offsets[:-1], offsets[1:])]


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """Values that two sorted sets share."""
    small, big = (x, y) if len(x) <= len(y) else (y, x)
    if not len(small):
        return 0
    return int((big[np.minimum(np.searchsorted(big, small), len(big) - 1)] == small).sum())


def crossing(shared: DataFrame, comps: DataFrame, nodes: DataFrame) -> DataFrame:
    """(x, comp): pairs of near signatures whose components differ, x of the smaller component."""
    sizes = comps.groupBy("comp").agg(F.count("*").alias("size"))
    placed = shared.join(comps.join(sizes, "comp"), "id")
    mixed_keys = placed.groupBy("key").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2"), F.max(F.struct("size", "comp"))["comp"].alias("core")).filter("c1 <> c2")
    # stored (only keys of several components): counted, and dealt out in three ways, from there
    rows = stored(placed.join(mixed_keys.select("key", "core"), "key").withColumn("inner", F.col("comp") == F.col("core")).drop("core"), "mixed-keys")
    counts = rows.groupBy("key").agg(F.count_if("inner").alias("nc"), F.count_if(~F.col("inner")).alias("ns"))
    blocks = stored(counts.select("key", F.ceil(F.col("nc") / BLOCK).alias("bc"), F.ceil(F.col("ns") / BLOCK).alias("bs")), "blocks")
    rows = rows.join(blocks, "key").join(nodes.select("id", "sig"), "id")
    upto = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    own = F.pmod(F.xxhash64("id"), F.when(F.col("inner"), F.col("bc")).otherwise(F.col("bs")))
    rows = rows.withColumn("own", own)
    # kind 0: a block of the largest component against a block of the rest; kind 1: blocks of the rest among themselves
    core = rows.filter("inner").withColumn("o", F.explode(upto("bs"))).withColumns({"kind": F.lit(0), "i": F.col("own"), "j": F.col("o"), "side": F.lit(0)})
    rest = rows.filter(~F.col("inner"))
    outer = rest.withColumn("o", F.explode(upto("bc"))).withColumns({"kind": F.lit(0), "i": F.col("o"), "j": F.col("own"), "side": F.lit(1)})
    among = rest.withColumn("o", F.explode(upto("bs"))).withColumns(
        {"kind": F.lit(1), "i": F.least("own", "o"), "j": F.greatest("own", "o"), "side": F.when(F.col("own") == F.col("o"), 2).when(F.col("own") < F.col("o"), 0).otherwise(1)}
    )
    units = core.unionByName(outer).unionByName(among).select(F.xxhash64("key", "kind", "i", "j").alias("unit"), "key", "side", "id", "comp", "size", "sig")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, "unit"):
            sigs, side = matrix(column(t, "sig")), column(t, "side").to_numpy(zero_copy_only=False)
            ids, comp, size = (column(t, c).to_numpy(zero_copy_only=False) for c in ("id", "comp", "size"))
            at = int(np.argmax(keys_of(sigs[:1])[0] == column(t, "key")[0].as_py()))
            left, right = (np.flatnonzero(side == 2),) * 2 if (side == 2).any() else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
            found = []
            for s in range(0, len(left), 128):
                x = left[s : s + 128]
                differ = sigs[x][:, None, :] != sigs[right][None, :, :]
                close = (differ.sum(2) <= MAX_DISTANCE) & (comp[x][:, None] != comp[right][None, :])
                p, q = np.nonzero(close)
                if not p.size:
                    continue
                errors = differ[p, q][:, :INDEXED].reshape(-1, CHUNKS, WIDTH)
                shares = errors.sum(2) <= 1
                chunk = shares.argmax(1)
                first = chunk * WIDTH + errors[np.arange(len(p)), chunk].argmax(1)
                p, q = x[p[first == at]], right[q[first == at]]
                less = (size[p] < size[q]) | (size[p] == size[q]) & (comp[p] < comp[q])
                found.append(np.stack([np.where(less, ids[p], ids[q]), np.where(less, comp[q], comp[p])], 1))
            if found:
                out = np.unique(np.concatenate(found), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], names=["x", "comp"])

    dealt = units.repartition("unit").sortWithinPartitions("unit")
    return dealt.mapInArrow(near, "x long, comp long").distinct()


def runs(batches: Iterator[pa.RecordBatch], by: str) -> Iterator[pa.RecordBatch]:
    """Rows of equal ``by`` together, from batches sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        values = column(batch, by).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(batch)]
        for x, y in zip(cuts[:-1], cuts[1:]):
            if held and column(held[-1], by)[0].as_py() != values[x]:
                yield pa.concat_batches(held)
                held = []
            held.append(batch.slice(x, y - x))
    if held:
        yield pa.concat_batches(held)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """(key, n_shingles, component_id, kept) for every row of ``docs``."""
    ship(docs.sparkSession)
    prints = stored(fingerprints(docs, key, text, shingle), "fingerprints")
    whole = prints.filter("n > 0 and id is not null")
    # one node for each different set, with a number of its own: one id may hold several sets
    groups = whole.groupBy("f1", "f2", "n").agg(F.min("id").alias("rep"), F.first("sig").alias("sig"))
    groups = stored(groups.withColumn("node", F.monotonically_increasing_id()), "sets")
    nodes = groups.select(F.col("node").alias("id"), "f1", "n", "sig")
    keys = filed(nodes)
    heads = keys.groupBy("key").agg(F.min("id").alias("head"), F.max("id").alias("top")).filter("head < top")
    shared = stored(keys.join(heads.select("key", "head"), "key"), "shared-keys")
    needed = shared.select(F.col("id").alias("node")).distinct().join(groups.select("node", "rep", "f1", "f2"), "node")
    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("t")).join(needed.select(F.col("rep").alias("id")).distinct(), "id", "left_semi")
    sets = sets_of(texts, shingle).join(needed.withColumnRenamed("rep", "id"), ["id", "f1", "f2"]).select(F.col("node").alias("id"), "set")
    sets = stored(sets.dropDuplicates(["id"]), "candidate-sets")

    alone = shared.select(F.col("id"), F.col("id").alias("comp")).distinct()
    star = shared.filter("id <> head").select(F.col("id").alias("x"), F.col("head").alias("comp")).distinct()
    first = stored(linked(stored(star, "star"), alone, sets, percent), "first-links")
    found = components(first)
    comps = stored(alone.join(found.withColumnRenamed("comp", "c"), "id", "left").select("id", F.coalesce("c", "id").alias("comp")), "first-components")
    combos = stored(crossing(shared, comps, nodes), "crossing")
    second = stored(linked(combos, comps, sets, percent), "second-links")
    final = components(first.union(second)).toDF("node", "comp")
    final = stored(final.union(final.select("comp", "comp")).distinct(), "members")  # the smallest node is of its component too

    # a component goes by the smallest id of its sets
    placed = groups.select("f1", "f2", "n", "rep", "node").join(final, "node", "left")
    named = placed.filter("comp is not null").groupBy("comp").agg(F.min("rep").alias("smallest"))
    placed = placed.join(named, "comp", "left").select("f1", "f2", "n", F.coalesce("smallest", "rep").alias("component"))
    out = prints.select("id", "n", "f1", "f2").join(placed, ["f1", "f2", "n"], "left")
    component = F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("component")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True))
    )


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose document stays, columns unchanged: one document of each group."""
    gone = near_duplicates(docs, key, text, **options).filter(~F.col("kept")).select(F.col(key).alias("gone")).distinct()
    return docs.join(gone, docs[key].cast("long") == gone["gone"], "left_anti")


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of ``documents`` at 2-word shingles and similarity 0.8."""
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=2, percent=80)
