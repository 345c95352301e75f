"""Operator 8: reversible line dedup on sharded cuckoo filters and exact reference counts.

The index is three tables below the shared folder, rewritten version by version:

* ``postings`` (shard, k1, k2, doc): which document holds which line key,
* ``counts`` (shard, k1, k2, refs, owner): exact number of holders, smallest holder,
* ``filters`` (shard, filter): a cuckoo filter of each shard's keys.

A key is in its shard's filter once if one document holds it and twice if more
do, so the filter answers both "is it known?" (an insertion skips the exact
counts for keys that are surely new) and "may it be repeated?" (a document's
lines go to the exact counts only if they may be).  Whatever a filter lets
through is decided by the exact counts, so its errors change no result.
Deletions take documents out of the postings, lower the counts, hand a line to
the next smallest holder, and take copies out of the filters.

A key that a third of all documents hold costs one row per map task in the
counts, and its shard's filter is dealt out in as many copies as the shard's
measured rows need.

Defined results: a null or empty text is one empty line; keys are 128-bit
hashes of the stripped, lower-cased line; keys shorter than ``min_length`` code
points are no keys; rows that share a doc_id are one document; a null doc_id
counts as the largest id; a repeated insertion of a document changes nothing;
an empty table gives no rows; other columns are untouched.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sftprep.llm.bpe import slices
from sftprep.llm.common import column, ship, stored, table, utf8_values

MIN_LENGTH = 10
SHARDS = 64
#: rows of one shard that a task probes; larger shards are dealt to several tasks
DEAL = 200_000
SLOTS = 4
LAST = 2**63 - 1


def line_keys(text: bytes, min_length: int) -> tuple[list[bytes], list[bytes | None]]:
    """The lines of a text, and each line's 16-byte key or None."""
    import xxhash

    lines = text.split(b"\n")
    keys: list[bytes | None] = []
    for line in lines:
        key = line.strip().lower()
        n = len(key)
        # a UTF-8 code point has at most 4 bytes
        long = n >= min_length and (n >= 4 * min_length or len(key.decode("utf-8", "replace")) >= min_length)
        keys.append(xxhash.xxh3_128_digest(key) if long else None)
    return lines, keys


class CuckooFilter:
    """Buckets of SLOTS 16-bit fingerprints; a key may be held twice."""

    def __init__(self, bits: int, slots: bytes | None = None):
        self.bits = bits
        self.table = array("H", slots if slots is not None else bytes(2 * SLOTS << bits))

    @classmethod
    def sized(cls, copies: int) -> CuckooFilter:
        """Room for ``copies`` at a load of at most four fifths."""
        return cls(max(4, int(np.ceil(np.log2(max(1, copies) / (SLOTS * 0.8))))))

    @staticmethod
    def load(raw: bytes) -> CuckooFilter:
        return CuckooFilter(raw[0], raw[1:])

    def dump(self) -> bytes:
        return bytes([self.bits]) + self.table.tobytes()

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys = keys.view(np.uint64)
        mark = (keys & np.uint64(0xFFFF)).astype(np.int64)
        mark[mark == 0] = 1
        first = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        return mark, first, self._other(first, mark)

    def _other(self, bucket, mark):
        """The partner bucket: its own inverse, from the bucket and the fingerprint alone."""
        return bucket ^ ((mark * 0x5BD1E995 >> 3) & ((1 << self.bits) - 1))

    def count(self, keys: np.ndarray) -> np.ndarray:
        """Copies that each key seems to have; never fewer than it has."""
        mark, a, b = self._places(keys)
        slots = np.frombuffer(self.table, dtype=np.uint16).reshape(-1, SLOTS)
        held = (slots[a] == mark[:, None]).sum(1)
        return held + np.where(a != b, (slots[b] == mark[:, None]).sum(1), 0)

    def add(self, keys: np.ndarray) -> bool:
        """Put one copy of each key in; False if there was no room."""
        t, seed = self.table, 1
        for mark, a, b in zip(*(x.tolist() for x in self._places(keys))):
            for bucket in (a, b):
                at = bucket * SLOTS
                free = next((s for s in range(at, at + SLOTS) if not t[s]), -1)
                if free >= 0:
                    t[free] = mark
                    break
            else:
                for _ in range(500):  # move a fingerprint to its partner bucket
                    seed = seed * 1103515245 + 12345 & 0x7FFFFFFF
                    s = bucket * SLOTS + (seed >> 16) % SLOTS
                    mark, t[s] = t[s], mark
                    bucket = self._other(bucket, mark)
                    at = bucket * SLOTS
                    free = next((s for s in range(at, at + SLOTS) if not t[s]), -1)
                    if free >= 0:
                        t[free] = mark
                        break
                else:
                    return False
        return True

    def remove(self, keys: np.ndarray) -> None:
        """Take one copy of each key out; only keys that were put in may be taken out."""
        for mark, a, b in zip(*(x.tolist() for x in self._places(keys))):
            for bucket in (a, b):
                at = bucket * SLOTS
                found = next((s for s in range(at, at + SLOTS) if self.table[s] == mark), -1)
                if found >= 0:
                    self.table[found] = 0
                    break


def postings_of(docs: DataFrame, key: str, text: str, min_length: int, shards: int) -> DataFrame:
    """(shard, k1, k2, doc): the distinct line keys of each row."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = column(batch, "doc").to_pylist()
            found, owners = [], []

            def out() -> pa.RecordBatch:
                keys = np.frombuffer(b"".join(found), dtype="<i8").reshape(-1, 2)
                return pa.RecordBatch.from_arrays([pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(owners, pa.int64())], names=["k1", "k2", "doc"])

            for doc, t in zip(ids, utf8_values(column(batch, "t"))):
                own = set(line_keys(t, min_length)[1]) - {None}
                found.extend(own)
                owners.extend([doc] * len(own))
                if len(found) > 100_000:
                    yield out()
                    found, owners = [], []
            if found:
                yield out()

    picked = docs.select(document(F.col(key)).alias("doc"), F.col(text).alias("t"))
    return picked.mapInArrow(rows, "k1 long, k2 long, doc long").select(F.pmod("k2", F.lit(shards)).cast("int").alias("shard"), "k1", "k2", "doc")


def document(key: Column) -> Column:
    return F.coalesce(key.cast("long"), F.lit(LAST))


class LineIndex:
    """The state; every change returns a new index and leaves the old one readable."""

    def __init__(self, spark: SparkSession, shards: int, min_length: int, tables: dict[str, DataFrame] | None):
        self.spark, self.shards, self.min_length, self.tables = spark, shards, min_length, tables

    @staticmethod
    def empty(spark: SparkSession, shards: int = SHARDS, min_length: int = MIN_LENGTH) -> LineIndex:
        ship(spark)
        return LineIndex(spark, shards, min_length, None)

    def _next(self, postings: DataFrame, counts: DataFrame, changes: DataFrame) -> LineIndex:
        """The index after ``changes`` (shard, k1, k2, before, after), the refs of changed keys."""
        old = self.tables["filters"] if self.tables else None
        return LineIndex(self.spark, self.shards, self.min_length, {"postings": postings, "counts": counts, "filters": updated_filters(changes, counts, old)})

    def insert(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> LineIndex:
        """Add documents; those that the index has already stay as they are."""
        new = postings_of(docs, key, text, self.min_length, self.shards)
        if self.tables is None:
            new = stored(new, "line-postings")
            counts = stored(counted(new), "line-counts")
            return self._next(new, counts, counts.select("shard", "k1", "k2", F.lit(0).cast("long").alias("before"), F.col("refs").alias("after")))
        new = stored(new.join(self.tables["postings"].select("doc").distinct(), "doc", "left_anti").select("shard", "k1", "k2", "doc"), "line-postings")
        delta = stored(counted(new), "line-delta")
        probed = stored(probe(delta.withColumn("need", F.lit(1)), self.tables["filters"], "refs long, owner long, need int"), "line-probed")
        keys = ["shard", "k1", "k2"]
        known = probed.filter("hit")  # the exact counts are asked for these only
        old = self.tables["counts"].toDF(*keys, "old_refs", "old_owner")
        joined = known.join(old, keys, "left").select(
            *keys, (F.col("refs") + F.coalesce("old_refs", F.lit(0))).alias("refs"), F.least("owner", "old_owner").alias("owner"), F.coalesce("old_refs", F.lit(0)).alias("before")
        )
        fresh = probed.filter("not hit").select(*keys, "refs", "owner", F.lit(0).cast("long").alias("before"))
        changed = stored(joined.unionByName(fresh), "line-changed")
        kept = self.tables["counts"].join(changed.filter("before > 0").select(keys), keys, "left_anti")
        counts = stored(kept.unionByName(changed.drop("before")), "line-counts")
        return self._next(self.tables["postings"].unionByName(new), counts, changed.select(*keys, "before", F.col("refs").alias("after")))

    def delete(self, docs: DataFrame, key: str = "doc_id") -> LineIndex:
        """Take the documents with these ids out again."""
        if self.tables is None:
            return self
        gone = docs.select(document(F.col(key)).alias("doc")).distinct()
        keys = ["shard", "k1", "k2"]
        out = self.tables["postings"].join(gone, "doc", "left_semi")
        left = stored(self.tables["postings"].join(gone, "doc", "left_anti").select(*keys, "doc"), "line-postings")
        touched = stored(out.select(keys).distinct(), "line-touched")
        again = counted(left.join(touched, keys, "left_semi"))
        changed = touched.join(self.tables["counts"], keys).withColumnRenamed("refs", "before").drop("owner")
        changed = stored(changed.join(again, keys, "left").select(*keys, "before", F.coalesce("refs", F.lit(0)).alias("after"), "owner"), "line-changed")
        kept = self.tables["counts"].join(touched, keys, "left_anti")
        counts = stored(kept.unionByName(changed.filter("after > 0").select(*keys, F.col("after").alias("refs"), "owner")), "line-counts")
        return self._next(left, counts, changed.select(*keys, "before", "after"))

    def dropped(self) -> DataFrame:
        """(doc, k1s, k2s): the keys that each indexed document loses."""
        keys = ["shard", "k1", "k2"]
        maybe = probe(self.tables["postings"].withColumn("need", F.lit(2)), self.tables["filters"], "doc long, need int").filter("hit")
        repeated = self.tables["counts"].filter("refs > 1").select(*keys, "owner")
        lost = maybe.join(repeated, keys).filter("doc <> owner")
        return lost.groupBy("doc").agg(F.collect_list("k1").alias("k1s"), F.collect_list("k2").alias("k2s"))

    def clean(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        """The rows of ``docs`` as (row, r): the row with its text moved to r = struct<kept, n_lines, n_dropped>; a null text stays null."""
        rows = docs.select(F.struct("*").alias("row"), document(F.col(key)).alias("doc"))
        both = rows.join(self.dropped(), "doc", "left").select("row", "k1s", "k2s")
        shape = T.StructType([both.schema["row"], T.StructField("r", T.StructType.fromDDL("kept string, n_lines bigint, n_dropped bigint"))])
        min_length = self.min_length

        def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start, stop in slices(column(batch, "row").field(text)):
                    part = batch.slice(start, stop - start)
                    row = column(part, "row")
                    r = without(row.field(text), column(part, "k1s"), column(part, "k2s"), min_length)
                    kinds = [row.type.field(i) for i in range(row.type.num_fields)]
                    fields = [pa.nulls(len(row), f.type) if f.name == text else row.field(f.name) for f in kinds]
                    yield pa.RecordBatch.from_arrays([pa.StructArray.from_arrays(fields, fields=kinds), r], names=["row", "r"])

        return both.mapInArrow(cleaned, shape)


def counted(postings: DataFrame) -> DataFrame:
    """Exact reference counts; rows that repeat a document's key count once."""
    once = postings.select("shard", "k1", "k2", "doc").distinct()
    return once.groupBy("shard", "k1", "k2").agg(F.count("*").alias("refs"), F.min("doc").alias("owner"))


def updated_filters(changes: DataFrame, counts: DataFrame, old: DataFrame | None) -> DataFrame:
    """(shard, filter) after the changes; a full filter is built anew, larger, from the counts."""
    copies = lambda c: F.least(F.col(c), F.lit(2))
    moved = changes.select("shard", "k1", (copies("after") - copies("before")).cast("int").alias("by"), F.lit(None).cast("binary").alias("filter")).filter("by <> 0")
    held = counts.groupBy("shard").agg(F.sum(copies("refs")).cast("int").alias("n"))
    spark = changes.sparkSession
    if old is None:
        old = spark.createDataFrame([], "shard int, filter binary")
    start = held.join(old, "shard", "left").select("shard", F.lit(0).cast("long").alias("k1"), F.col("n").alias("by"), F.coalesce("filter", F.lit(b"")).alias("filter"))

    def build(t: pa.Table) -> pa.Table:
        head = np.flatnonzero(~t.column("filter").combine_chunks().is_null().to_numpy(zero_copy_only=False))
        shard = t.column("shard")[0].as_py()
        if not len(head):  # no key of the shard is left
            return pa.table({"shard": pa.array([], pa.int32()), "filter": pa.array([], pa.binary()), "full": pa.array([], pa.bool_())})
        raw = t.column("filter")[int(head[0])].as_py()
        n = t.column("by")[int(head[0])].as_py()
        keys = np.delete(t.column("k1").to_numpy(), head)
        by = np.delete(t.column("by").to_numpy(), head)
        f = CuckooFilter.load(raw) if raw else CuckooFilter.sized(n)
        f.remove(np.concatenate([keys[by <= -1], keys[by == -2]]))
        fits = f.add(np.concatenate([keys[by >= 1], keys[by == 2]]))
        return pa.table({"shard": pa.array([shard], pa.int32()), "filter": pa.array([f.dump()], pa.binary()), "full": pa.array([not fits or bool(raw) and n > 0.9 * SLOTS * (1 << f.bits)])})

    shape = "shard int, filter binary, full boolean"
    built = stored(moved.unionByName(start).groupBy("shard").applyInArrow(build, shape), "line-filters")
    full = built.filter("full").select("shard")
    if full.isEmpty():
        return built.select("shard", "filter")

    def larger(t: pa.Table) -> pa.Table:
        keys, refs = t.column("k1").to_numpy(), t.column("refs").to_numpy()
        wanted = np.concatenate([keys, keys[refs > 1]])
        room = 2 * len(wanted)
        while not (f := CuckooFilter.sized(room)).add(wanted):
            room *= 2
        return pa.table({"shard": pa.array([t.column("shard")[0].as_py()], pa.int32()), "filter": pa.array([f.dump()], pa.binary())})

    grown = counts.join(full, "shard", "left_semi").select("shard", "k1", "refs").groupBy("shard").applyInArrow(larger, "shard int, filter binary")
    return stored(built.filter("not full").select("shard", "filter").unionByName(grown), "line-filters")


def probe(rows: DataFrame, filters: DataFrame, extra: str) -> DataFrame:
    """``rows`` (shard, k1, k2, extra...) with ``hit``: whether the filter shows ``need`` copies.

    Each task gets the filter of its shard ahead of its rows; a shard with many
    rows is dealt to several tasks, each with its own copy of the filter.
    """
    names = [f.split()[0] for f in extra.split(", ")]
    turns = rows.groupBy("shard").agg(F.ceil(F.count("*") / DEAL).alias("turns"))
    turns = F.broadcast(turns)  # at most one row per shard
    dealt = rows.join(turns, "shard").withColumns({"turn": F.pmod(F.xxhash64("k1", names[0]), "turns"), "filter": F.lit(None).cast("binary")})
    lead = filters.join(turns, "shard").select(
        "shard", *[F.lit(0).cast("long").alias(k) for k in ("k1", "k2")], *[F.lit(0).cast(f.split()[1]).alias(f.split()[0]) for f in extra.split(", ")],
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("turns") - 1)).alias("turn"), "filter",
    )
    both = dealt.select(lead.columns).unionByName(lead).repartition("shard", "turn").sortWithinPartitions("shard", "turn", F.col("filter").isNull())

    def probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, f = None, None
        for batch in batches:
            at = list(zip(column(batch, "shard").to_pylist(), column(batch, "turn").to_pylist()))
            blobs = column(batch, "filter")
            heads = np.flatnonzero(~blobs.is_null().to_numpy(zero_copy_only=False)).tolist()
            shard, turn = (column(batch, c).to_numpy() for c in ("shard", "turn"))
            k1, need = column(batch, "k1").to_numpy(), column(batch, "need").to_numpy()
            hit = np.zeros(len(batch), dtype=bool)
            cuts = np.flatnonzero((shard[1:] != shard[:-1]) | (turn[1:] != turn[:-1])) + 1
            for x, y in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)]):
                if at[x] != current:
                    current, f = at[x], None  # a shard without a filter has no keys
                if x in heads:
                    f = CuckooFilter.load(blobs[x].as_py())
                if f is not None:
                    hit[x:y] = f.count(k1[x:y]) >= need[x:y]
            rest = pa.array(np.delete(np.arange(len(batch)), heads))
            out = pa.RecordBatch.from_arrays([column(batch, c) for c in ("shard", "k1", "k2", *names)] + [pa.array(hit)], names=["shard", "k1", "k2", *names, "hit"])
            yield out.take(rest)

    return both.mapInArrow(probed, f"shard int, k1 long, k2 long, {extra}, hit boolean").drop("need")


def without(texts: pa.Array, k1s: pa.Array, k2s: pa.Array, min_length: int) -> pa.StructArray:
    """The texts without the lines of the given keys, and the numbers of lines before and dropped."""
    kept, before, lost = [], [], []
    for t, valid, x, y in zip(utf8_values(texts), texts.is_valid(), k1s, k2s):
        gone = np.stack([x.values.to_numpy(), y.values.to_numpy()], 1).astype("<i8").tobytes() if x.is_valid else b""
        n, dropped = t.count(b"\n") + 1, 0
        if gone:
            out = {gone[i : i + 16] for i in range(0, len(gone), 16)}
            lines, keys = line_keys(t, min_length)
            stay = [line for line, k in zip(lines, keys) if k not in out]
            t, dropped = b"\n".join(stay), n - len(stay)
        kept.append(t if valid.as_py() else None)
        before.append(n)
        lost.append(dropped)
    fields = [pa.array(kept, pa.binary()).cast(pa.string()), pa.array(before, pa.int64()), pa.array(lost, pa.int64())]
    return pa.StructArray.from_arrays(fields, names=["kept", "n_lines", "n_dropped"])


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", length: str | None = None) -> DataFrame:
    """``docs`` with repeated lines gone, columns unchanged; ``length`` names a column to hold the new text's length."""
    index = LineIndex.empty(docs.sparkSession).insert(docs, key, text)
    cleaned = index.clean(docs, key, text)
    fields = {text: F.col("r.kept")}
    if length:
        fields[length] = F.length("r.kept").cast(docs.schema[length].dataType)
    return cleaned.select(*[fields.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line dedup over every row of ``documents``, through a new index of all of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    index = LineIndex.empty(spark).insert(docs)
    return index.clean(docs).select(
        "row.doc_id", "r.n_lines", "r.n_dropped", F.sha2(F.coalesce("r.kept", F.lit("")).cast("binary"), 256).alias("kept_sha256")
    )


WHITE_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
OP8_SQL = f"""
WITH l AS (
  SELECT doc_id, u.line, u.i, translate(trim(u.line, {WHITE_SQL}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(a) AS line, generate_subscripts(a, 1) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents)) u
), o AS (
  SELECT k, min(doc_id) AS owner FROM l WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) > 1
), d AS (
  SELECT l.*, o.k IS NOT NULL AND l.doc_id <> o.owner AS gone FROM l LEFT JOIN o USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM d GROUP BY doc_id
"""
