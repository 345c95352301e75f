"""One large JSON array file, read by many tasks.

A byte range of the file cannot be parsed before it is known whether it begins
inside a string and how deep it is nested.  Both follow from a prefix scan: every
task reports for its range the parity of its quotes and its change of depth, once for
each way the range may begin; the driver composes these few numbers (one row per
task) and hands every task its state.  A task's range is a run of neighbouring
blocks, read one after the other, so the tasks are bounded by the file's bytes and
a task's memory by the block.  A record belongs to the block in which its opening
brace lies; its task reads on to the closing one.
"""

from __future__ import annotations

from collections.abc import Generator, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sftprep.session import ensure_library_on_workers
from sftprep.sources.listing import file_system

BLOCK_BYTES = 64 * 1024 * 1024
QUOTE, BACKSLASH, COMMA = b'"'[0], b"\\"[0], b","[0]
OPEN, CLOSE = (b"{"[0], b"["[0]), (b"}"[0], b"]"[0])
BLANK = tuple(b" \t\r\n")


def _quotes(data: np.ndarray, run: int) -> np.ndarray:
    """Places of unescaped quotes; ``run`` backslashes stand right before the data."""
    quotes = np.flatnonzero(data == QUOTE)
    other = np.flatnonzero(data != BACKSLASH)
    # the last byte before each quote that is no backslash
    at = np.searchsorted(other, quotes) - 1
    before = np.where(at >= 0, other[np.maximum(at, 0)], -1 - run)
    return quotes[(quotes - before - 1) % 2 == 0]


def _inside(data: np.ndarray, run: int, inside: bool) -> np.ndarray:
    """Whether each byte lies in a string (its closing quote does, its opening one too)."""
    flips = np.zeros(len(data), dtype=np.int8)
    quotes = _quotes(data, run)
    flips[quotes] = 1
    state = (np.cumsum(flips, dtype=np.int64) + inside) % 2 == 1
    state[quotes] = True
    return state


def _steps(data: np.ndarray, outside: np.ndarray) -> np.ndarray:
    up = (data == OPEN[0]) | (data == OPEN[1])
    down = (data == CLOSE[0]) | (data == CLOSE[1])
    return np.where(outside, up.astype(np.int8) - down.astype(np.int8), 0)


class _File:
    def __init__(self, path: str):
        filesystem, inner = file_system(path)
        self.f = filesystem.open_input_file(inner)
        self.size = self.f.size()

    def bytes(self, start: int, n: int) -> np.ndarray:
        n = max(0, min(n, self.size - start))
        return np.frombuffer(self.f.read_at(n, start), dtype=np.uint8) if n else np.empty(0, dtype=np.uint8)

    def run_before(self, start: int) -> int:
        """Number of backslashes right before a place."""
        run, step = 0, 64
        while start - run > 0:
            part = self.bytes(max(0, start - run - step), min(step, start - run))
            tail = len(part) - 1 - np.flatnonzero(part != BACKSLASH)
            if tail.size:
                return run + int(tail.min())
            run, step = run + len(part), step * 2
        return run


def _records(file: _File, start: int, n: int, inside: bool, depth: int) -> Generator[str, None, tuple[bool, int]]:
    """The array's records that begin in a block, whole; returns the state after the block."""
    data = file.bytes(start, n)
    run = file.run_before(start)
    outside = ~_inside(data, run, inside)
    levels = depth + np.cumsum(_steps(data, outside), dtype=np.int64)  # after each byte
    opened = outside & (data == OPEN[0]) & (levels == 2)
    closed = outside & (data == CLOSE[0]) & (levels == 1)
    # between records there are commas and blanks only
    loose = outside & (levels == 1) & ~closed & (data != COMMA) & ~np.isin(data, BLANK) & (data != OPEN[1])
    nested = outside & (levels == 2) & (data == OPEN[1]) & (np.concatenate([[depth], levels[:-1]]) == 1)
    if loose.any() or nested.any() or (~outside & (levels == 1)).any():
        raise ValueError(f"an element of the array is no object, near byte {start}")
    begins, ends = np.flatnonzero(opened), np.flatnonzero(closed)
    ends = ends[ends > begins[0]] if begins.size else ends[:0]
    raw = data.tobytes()
    for a, b in zip(begins, ends):
        yield raw[a : b + 1].decode("utf-8")
    if len(begins) > len(ends):  # the last one goes on behind the block
        yield _whole(file, start + int(begins[-1]))
    return inside ^ bool(len(_quotes(data, run)) % 2), int(levels[-1]) if len(levels) else depth


def _whole(file: _File, start: int) -> str:
    size = 1 << 16
    while True:
        data = file.bytes(start, size)
        levels = np.cumsum(_steps(data, ~_inside(data, 0, False)), dtype=np.int64)
        ends = np.flatnonzero(levels == 0)
        if ends.size:
            return data[: int(ends[0]) + 1].tobytes().decode("utf-8")
        if start + size >= file.size:
            raise ValueError(f"a record that begins at byte {start} has no end")
        size *= 4


def json_array_records(spark: SparkSession, path: str, length: int, block: int = BLOCK_BYTES) -> DataFrame:
    """The objects of a JSON array file as text, one ``value`` a row; a file that is no array of objects fails."""
    ensure_library_on_workers(spark)
    blocks = max(1, -(-length // block))
    tasks = min(blocks, max(4 * spark.sparkContext.defaultParallelism, -(-length // BLOCK_BYTES)))
    share = -(-blocks // tasks)  # blocks of a task
    spans = -(-blocks // share)
    ranges = spark.range(0, spans, 1, spans).select(F.col("id").alias("span"))

    def starts(span: int) -> range:
        return range(span * share * block, min((span + 1) * share, blocks) * block, block)

    def measure(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rows = []
            for span in batch.column(0).to_pylist():
                file, odd, steps = _File(path), 0, [0, 0]
                for start in starts(span):
                    data, run = file.bytes(start, block), file.run_before(start)
                    for entry in (0, 1):
                        steps[entry] += int(_steps(data, ~_inside(data, run, bool(entry ^ odd))).sum(dtype=np.int64))
                    odd ^= len(_quotes(data, run)) % 2
                rows.append([span, odd, *steps])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)] or [pa.array([], pa.int64())] * 4, names=["span", "odd", "plain", "quoted"])

    inside, depth, states = False, 0, []
    for r in sorted(ranges.mapInArrow(measure, "span long, odd long, plain long, quoted long").collect()):  # one row per task
        states.append((r.span, inside, depth))
        depth += r.quoted if inside else r.plain
        inside ^= bool(r.odd)
    if inside or depth:
        raise ValueError(f"{path} is no complete JSON array")

    def records(span: int, inside: bool, depth: int) -> Iterator[str]:
        file = _File(path)
        for start in starts(span):
            inside, depth = yield from _records(file, start, block, inside, depth)

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for state in zip(*(c.to_pylist() for c in batch.columns)):
                held, size = [], 0
                for record in records(*state):
                    held.append(record)
                    size += len(record)
                    if size >= 4_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], names=["value"])
                        held, size = [], 0
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], names=["value"])

    known = spark.createDataFrame(states, "span long, inside boolean, depth long").repartitionById(spans, F.col("span").cast("int"))
    return known.mapInArrow(cut, "value string")
