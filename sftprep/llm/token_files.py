"""Operator 6: token ids in files, coded by a static range asymmetric numeral system.

The corpus is tokenized once, where its texts are scanned; only the ids, two bytes
each for vocabularies below 65,536 tokens, are stored and then ordered by document
id into blocks of whole documents.  One frequency table, counted over all ids and scaled to
2**PRECISION, is shared by every block, so blocks are coded and decoded independently.  Inside
a block LANES coders are interleaved: symbol i belongs to lane i % LANES, and a
step moves all lanes at once.  A block holds its coded words, a checkpoint
(states and word position) every CHECKPOINT steps, from which decoding may start,
and a checksum of its ids that is verified on reading.

Files, below one folder: ``table`` (token, frequency) and ``blocks`` (shard,
block, first, docs, lengths, coded), both Parquet.  ``first`` counts the ids of
the shard before the block; a shard is a range of document ids.

Defined results: a null or empty text is its end id alone; rows that share a
doc_id are documents of their own, ordered by a digest of their ids; null ids come first; a text
of any length is one document of one block; an empty table gives no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sftprep.llm import bpe
from sftprep.llm.common import column, list_array, ship, stored, table
from sftprep.session import scratch_path

END_ID = 2
BLOCK = 1 << 18
LANES = 1024
CHECKPOINT = 128
PRECISION = 20
#: bytes of text that are tokenized at once
TEXTS = 8_000_000
LOW = np.uint64(1 << 31)
HEAD = struct.Struct("<4sIIIIII")  # magic, ids, lanes, steps, checkpoint interval, words, checksum
MAGIC = b"RNS1"


class FrequencyTable:
    """Frequencies that sum to 2**PRECISION, at least 1 for every token that occurs."""

    def __init__(self, frequency: np.ndarray):
        self.frequency = frequency.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(frequency)[:-1]]).astype(np.uint64)
        self._symbol = None

    @property
    def symbol(self) -> np.ndarray:
        if self._symbol is None:
            self._symbol = np.repeat(np.arange(len(self.frequency), dtype=np.uint32), self.frequency.astype(np.int64))
        return self._symbol

    @staticmethod
    def scaled(counts: np.ndarray) -> np.ndarray:
        """Counts scaled to the sum; what rounding leaves goes to or comes from the most frequent tokens."""
        room = 1 << PRECISION
        total = int(counts.sum())
        if not total:
            return counts
        out = np.where(counts > 0, np.maximum(1, counts * (room / total)), 0).astype(np.int64)
        order = np.argsort(-out, kind="stable")
        rest = room - int(out.sum())
        for k in order:
            step = rest if rest > 0 else max(rest, 1 - int(out[k]))
            out[k] += step
            rest -= step
            if not rest:
                break
        return out


def encode_block(ids: np.ndarray, t: FrequencyTable) -> bytes:
    n = len(ids)
    lanes = int(min(LANES, max(1, n)))
    steps = -(-n // lanes)
    state = np.full(lanes, LOW, dtype=np.uint64)
    groups: list[np.ndarray] = [None] * steps
    marks: dict[int, bytes] = {}
    shift, limit = np.uint64(PRECISION), np.uint64(63 - PRECISION)
    for s in range(steps - 1, -1, -1):
        part = ids[s * lanes : (s + 1) * lanes]
        x = state[: len(part)]
        f, c = t.frequency[part], t.start[part]
        over = x >= (f << limit)
        groups[s] = (x[over] & np.uint64(0xFFFFFFFF)).astype("<u4")
        x = np.where(over, x >> np.uint64(32), x)
        q, r = np.divmod(x, f)
        state[: len(part)] = (q << shift) + r + c
        if s % CHECKPOINT == 0:
            marks[s] = state.astype("<u8").tobytes()
    ends = np.concatenate([[0], np.cumsum([len(g) for g in groups])]).astype(int) if steps else np.zeros(1, int)
    words = b"".join(g.tobytes() for g in groups)
    points = b"".join(struct.pack("<I", ends[s]) + marks[s] for s in sorted(marks))
    head = HEAD.pack(MAGIC, n, lanes, steps, CHECKPOINT, len(words) // 4, zlib.crc32(ids.astype("<u4").tobytes()))
    return head + points + words


def decode_block(raw: bytes, t: FrequencyTable, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Ids [start, stop) of a block, from the last checkpoint before ``start``; a whole block is verified."""
    magic, n, lanes, steps, interval, n_words, crc = HEAD.unpack_from(raw)
    if magic != MAGIC:
        raise ValueError("not a token block")
    stop = n if stop is None else min(stop, n)
    if start >= stop:
        return np.empty(0, dtype="<u4")
    size = 4 + 8 * lanes
    first = start // lanes // interval
    at = HEAD.size + first * size
    position = struct.unpack_from("<I", raw, at)[0]
    state = np.frombuffer(raw, dtype="<u8", count=lanes, offset=at + 4).astype(np.uint64)
    words = np.frombuffer(raw, dtype="<u4", count=n_words, offset=HEAD.size + -(-steps // interval) * size)
    mask, shift = np.uint64((1 << PRECISION) - 1), np.uint64(PRECISION)
    out = []
    for s in range(first * interval, -(-stop // lanes)):
        live = min(lanes, n - s * lanes)
        x = state[:live]
        slot = x & mask
        symbol = t.symbol[slot]
        out.append(symbol)
        x = t.frequency[symbol] * (x >> shift) + slot - t.start[symbol]
        low = np.flatnonzero(x < LOW)
        x[low] = x[low] << np.uint64(32) | words[position : position + len(low)].astype(np.uint64)
        position += len(low)
        state[:live] = x
    base = first * interval * lanes
    ids = np.concatenate(out)[start - base : stop - base].astype("<u4")
    # a whole block ends in the coder's first state, and its ids have the written checksum
    if (start, stop) == (0, n) and ((state != LOW).any() or zlib.crc32(ids.tobytes()) != crc):
        raise ValueError("token block does not match its checksum")
    return ids


def tokenized(docs: DataFrame, path: str, key: str, text: str, end_id: int) -> DataFrame:
    """(k, ids, null) for every document, and (null, null, counts by token) for every task."""
    file = bpe.shared_file(docs.sparkSession, path)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = bpe.loaded(file.value)
        kind = vocabulary.kind
        total = np.zeros(max(len(vocabulary.tokens), end_id + 1), dtype="<i8")
        for batch in batches:
            for start, stop in bpe.slices(column(batch, "t"), TEXTS):
                ids, ends = vocabulary.encode_array(column(batch, "t").slice(start, stop - start))
                ids = np.insert(ids, ends, end_id).astype(kind)  # an end id after each document
                total += np.bincount(ids, minlength=len(total))
                offsets = np.concatenate([[0], ends + np.arange(1, len(ends) + 1)]) * kind.itemsize
                data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets.astype("<i8")), pa.py_buffer(ids.tobytes())])
                yield pa.RecordBatch.from_arrays([column(batch, "k").slice(start, stop - start), data.cast(pa.binary()), pa.nulls(len(ends), pa.binary())], names=["k", "ids", "counts"])
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([total.tobytes()], pa.binary())], names=["k", "ids", "counts"])

    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
    return rows.mapInArrow(encoded, "k long, ids binary, counts binary")


def in_blocks(encoded: DataFrame, kind: str, frequency) -> DataFrame:
    """(shard, block, first, docs, lengths, coded): whole documents in ascending order of their ids."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = FrequencyTable(frequency.value)
        shard, block, first, held = TaskContext.get().partitionId(), 0, 0, 0
        names, parts, lengths = [], [], []

        def out() -> pa.RecordBatch:
            coded = encode_block(np.frombuffer(b"".join(parts), dtype=kind), t)
            columns = [pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([first], pa.int64()), pa.array([names], pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays([*columns, list_array([np.array(lengths)], pa.int32()), pa.array([coded], pa.binary())], names=["shard", "block", "first", "docs", "lengths", "coded"])

        size = np.dtype(kind).itemsize
        for batch in batches:
            for name, ids in zip(column(batch, "k").to_pylist(), column(batch, "ids")):
                names.append(name)
                parts.append(ids.as_py())
                lengths.append(len(parts[-1]) // size)
                held += lengths[-1]
                if held >= BLOCK:
                    yield out()
                    first, block, held = first + held, block + 1, 0
                    names, parts, lengths = [], [], []
        if names:
            yield out()

    shards = int(encoded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the digest deals out rows of one id (or without one) among shards, and orders them
    rows = encoded.select("k", "ids", F.md5("ids").alias("tie"))
    ordered = rows.repartitionByRange(shards, "k", "tie").sortWithinPartitions("k", "tie")
    return ordered.select("k", "ids").mapInArrow(blocks, "shard int, block int, first long, docs array<long>, lengths array<int>, coded binary")


def write_tokens(docs: DataFrame, folder: str, path: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID) -> None:
    """Tokenize ``docs`` and write the files below ``folder``."""
    spark = docs.sparkSession
    ship(spark)
    encoded = stored(tokenized(docs, path, key, text, end_id), "token-ids", "zstd")
    with open(path, "rb") as f:
        vocabulary = bpe.loaded(f.read())
    total = np.zeros(max(len(vocabulary.tokens), end_id + 1), dtype=np.int64)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = np.zeros(len(total), dtype="<i8")
        for batch in batches:
            for part in column(batch, "counts"):
                mine += np.frombuffer(part.as_py(), dtype="<i8")
        held = np.flatnonzero(mine)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(mine[held])], names=["token", "n"])

    seen = encoded.select("counts").filter("counts IS NOT NULL").mapInArrow(summed, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    for row in seen.toLocalIterator():  # at most one row per vocabulary token
        total[row.token] = row.n
    scaled = FrequencyTable.scaled(total)
    rows = [(int(k), int(scaled[k])) for k in np.flatnonzero(scaled)]
    spark.createDataFrame(rows, "token long, frequency long").coalesce(1).write.parquet(f"{folder}/table")
    in_blocks(encoded.filter("ids IS NOT NULL"), vocabulary.kind.str, spark.sparkContext.broadcast(scaled)).write.parquet(f"{folder}/blocks")


def read_tokens(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids): each document's place among all ids, and its ids as little-endian 32-bit integers."""
    ship(spark)
    held = spark.read.parquet(f"{folder}/table").collect()  # at most one row per vocabulary token
    frequency = np.zeros(max([r.token for r in held], default=0) + 1, dtype=np.int64)
    for r in held:
        frequency[r.token] = r.frequency
    shared = spark.sparkContext.broadcast(frequency)
    blocks = spark.read.parquet(f"{folder}/blocks")
    sizes = blocks.groupBy("shard").agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    before = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    offsets = F.broadcast(sizes.select("shard", F.coalesce(before, F.lit(0)).alias("offset")))  # one row per shard

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = FrequencyTable(shared.value)
        for batch in batches:
            for i in range(len(batch)):
                ids = decode_block(column(batch, "coded")[i].as_py(), t)
                docs = column(batch, "docs").slice(i, 1).flatten()
                lengths = column(batch, "lengths").slice(i, 1).flatten().to_numpy()
                ends = np.cumsum(lengths)
                start = column(batch, "offset")[i].as_py() + column(batch, "first")[i].as_py() + ends - lengths
                raw = ids.tobytes()
                parts = [raw[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_arrays([docs, pa.array(start, pa.int64()), pa.array(lengths, pa.int64()), pa.array(parts, pa.binary())], names=["k", "start", "n_tokens", "ids"])

    rows = blocks.join(offsets, "shard").mapInArrow(decoded, "k long, start long, n_tokens long, ids binary")
    return rows.withColumnRenamed("k", key)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` written as token files and read back."""
    import public_tokenizers

    folder = scratch_path(spark, "token-files")
    write_tokens(table(spark, sf_dir, "documents"), folder, public_tokenizers.path(bpe.VOCABULARY))
    back = read_tokens(spark, folder)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
