"""Operator 11: periodic runs of words, by internal pattern matching.

A run is a stretch of consecutive words with smallest period q and length of at
least max(MIN_LENGTH, MIN_POWER * q) that no neighbouring word extends keeping
the period.  A batch of texts becomes one number sequence; the sequence gets a
suffix array by prefix doubling, whose levels rank all substrings of 2**k words,
and a wavelet tree over the suffix array.

For each dyadic length b (8, 16, 32, ...) the blocks that start at multiples of
b are patterns.  The block's occurrences are one interval of the suffix array;
range-successor queries on the wavelet tree list those in the window of the next
2 * b words.  Occurrences that overlap by half a block or more form an arithmetic
progression, whose ends follow from longest common extensions, so a progression
costs two queries whatever its length.  The distances from the block to single
occurrences, and between the ends of the two progressions, are the candidate
periods; each is extended to both sides and kept if it is long enough.

Why none is lost: a run with period q <= 8 and 24 words or more holds a block of 8
and its copy q words on, the block's first occurrence.  A run with q > 8 and 3 * q
words holds a block of b words, q / 2 < b <= q, and its copy.  The copy is a
single occurrence, or lies in a progression that ends (or begins) inside the run,
and that end is q words from the same end around the block; a progression that
did neither would give the run a smaller period.  Smallest periods win among
candidates for one stretch.  MIN_LENGTH and MIN_POWER may be raised, not lowered.

Texts without any repeated 8 words hold no run and are not indexed.

Defined results: a null or empty text has no words and no runs; texts are taken
whole, a text of any length in one piece of a batch; repeated rows each give a
row; a null key is passed through; an empty table gives an empty table; columns
beside the key and the text are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sftprep.llm.bpe import slices
from sftprep.llm.common import column, mixed, ship, table, utf8_values

MIN_LENGTH = 24
MIN_POWER = 3
FIRST_BLOCK = 8
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
WORDS = r"[^\x20\x09-\x0D]+"


class Wavelet:
    """Wavelet tree (one bit of all values a level, high bits first) with range-successor queries."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.ones, self.zeros = [], []
        for k in range(self.bits - 1, -1, -1):
            bit = (values >> k) & 1
            ones = np.zeros(len(values) + 1, dtype=np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(values) - int(ones[-1]))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def below(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many of the values at [lo, hi) are less than x."""
        lo, hi, out = lo.copy(), hi.copy(), np.zeros(len(x), dtype=np.int64)
        big = x >= 1 << self.bits
        out[big] = (hi - lo)[big]
        for k, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            one = (x >> (self.bits - 1 - k)) & 1 == 1
            a, b = ones[lo], ones[hi]
            out += np.where(one & ~big, (hi - b) - (lo - a), 0)
            lo, hi = np.where(one, zeros + a, lo - a), np.where(one, zeros + b, hi - b)
        return out

    def smallest(self, lo: np.ndarray, hi: np.ndarray, nth: np.ndarray) -> np.ndarray:
        """The nth (from 0) smallest value at [lo, hi)."""
        lo, hi, nth, out = lo.copy(), hi.copy(), nth.copy(), np.zeros(len(nth), dtype=np.int64)
        for ones, zeros in zip(self.ones, self.zeros):
            a, b = ones[lo], ones[hi]
            few = (hi - b) - (lo - a)
            one = nth >= few
            nth = np.where(one, nth - few, nth)
            out = out * 2 + one
            lo, hi = np.where(one, zeros + a, lo - a), np.where(one, zeros + b, hi - b)
        return out

    def successor(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The smallest value at [lo, hi) that is x or more; -1 where there is none."""
        before = self.below(lo, hi, x)
        found = before < hi - lo
        out = np.full(len(x), -1, dtype=np.int64)
        out[found] = self.smallest(lo[found], hi[found], before[found])
        return out


class Index:
    """Suffix array by prefix doubling: ``rank[k][i]`` is the first suffix-array place of i's 2**k words."""

    def __init__(self, symbols: np.ndarray, longest: int):
        n = len(symbols)
        order = np.argsort(symbols, kind="stable")
        self.suffixes = order.copy()
        fresh = np.ones(n, dtype=bool)
        fresh[1:] = symbols[order][1:] != symbols[order][:-1]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
        self.rank = [rank.astype(np.int32)]
        while 1 << len(self.rank) <= longest:
            # only places whose substring occurs elsewhere are sorted further
            sizes = np.bincount(rank, minlength=n)
            slots = np.flatnonzero(sizes[rank[self.suffixes]] > 1)
            live = self.suffixes[slots]
            step = 1 << (len(self.rank) - 1)
            key = (rank[live] << 32) | rank[np.minimum(live + step, n - 1)]
            by = np.argsort(key, kind="stable")
            live, key = live[by], key[by]
            self.suffixes[slots] = live
            fresh = np.ones(len(live), dtype=bool)
            fresh[1:] = key[1:] != key[:-1]
            rank = rank.copy()
            if len(live):
                rank[live] = slots[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
            self.rank.append(rank.astype(np.int32))

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension to the right of places a < b."""
        n, out = len(self.suffixes), np.zeros(len(a), dtype=np.int64)
        for k in range(len(self.rank) - 1, -1, -1):
            live = np.arange(len(a))
            while live.size:  # only the top level can match more than once
                at = b[live] + out[live]
                same = at < n
                same[same] = self.rank[k][a[live[same]] + out[live[same]]] == self.rank[k][at[same]]
                live = live[same]
                out[live] += 1 << k
                if k < len(self.rank) - 1:
                    break
        return out

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension to the left, before places a < b."""
        out = np.zeros(len(a), dtype=np.int64)
        for k in range(len(self.rank) - 1, -1, -1):
            live = np.arange(len(a))
            while live.size:
                at = a[live] - out[live] - (1 << k)
                same = at >= 0
                same[same] = self.rank[k][at[same]] == self.rank[k][b[live[same]] - out[live[same]] - (1 << k)]
                live = live[same]
                out[live] += 1 << k
                if k < len(self.rank) - 1:
                    break
        return out


def _candidates(index: Index, tree: Wavelet, level: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) pairs from all blocks of 2**level words."""
    size, rank, n = 1 << level, index.rank[level].astype(np.int64), len(index.suffixes)
    occurs = np.bincount(rank, minlength=n)
    block = np.arange(0, n, size)
    block = block[occurs[rank[block]] > 1]
    lo = rank[block]
    hi = lo + occurs[lo]
    after = block.copy()  # the last occurrence that is dealt with
    places, distances = [], []

    def add(place: np.ndarray, distance: np.ndarray) -> None:
        places.append(place)
        distances.append(distance)

    first = True
    while block.size:
        if first:  # the progression around the block itself starts at the block
            at = block
        else:
            at = tree.successor(lo, hi, after + 1)
            inside = (at > block) & (at <= block + 2 * size)
            block, lo, hi, after, at = block[inside], lo[inside], hi[inside], after[inside], at[inside]
            if not block.size:
                break
            add(block, at - block)
        following = tree.successor(lo, hi, at + 1)
        step = following - at
        linked = (following >= 0) & (step <= size // 2)
        after = at.copy()
        if linked.any():
            i, j, p = block[linked], at[linked], step[linked]
            end = j + p + index.forward(j, j + p)
            after[linked] = end - size
            if first:
                add(i, p)
            else:
                own_end = i + p + index.forward(i, i + p)
                add(i, end - own_end)
                add(i, (j - index.backward(j, j + p)) - (i - index.backward(i, i + p)))
        first = False
    if not places:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return np.concatenate(places), np.concatenate(distances)


def find_runs(symbols: np.ndarray, longest: int, min_length: int = MIN_LENGTH, min_power: int = MIN_POWER) -> np.ndarray:
    """Rows (start, end, period) of all runs, by start and period.

    ``symbols`` holds texts that share no number, each ended by a number that
    occurs once; ``longest`` is the length of the longest text.
    """
    if min_length < MIN_LENGTH or min_power < MIN_POWER:
        raise ValueError(f"runs below {MIN_LENGTH} words or {MIN_POWER} periods are not searched")
    index = Index(symbols, max(FIRST_BLOCK, longest // min_power))
    tree = Wavelet(index.suffixes)
    first = FIRST_BLOCK.bit_length() - 1
    found = [_candidates(index, tree, k) for k in range(first, len(index.rank))]
    place, period = (np.concatenate(c) for c in zip(*found))
    good = period > 0
    pairs = np.unique(np.stack([place[good], period[good]], 1), axis=0)
    place, period = pairs[:, 0], pairs[:, 1]
    inside = place + period < len(symbols)
    place, period = place[inside], period[inside]
    start = place - index.backward(place, place + period)
    end = place + period + index.forward(place, place + period)
    long = end - start >= np.maximum(min_length, min_power * period)
    rows = np.stack([start[long], end[long], period[long]], 1)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    smallest = np.ones(len(rows), dtype=bool)
    smallest[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
    rows = rows[smallest]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _repeating(symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Which texts hold some 8 words twice (or seem to, by a 64-bit fingerprint)."""
    n = len(symbols) - FIRST_BLOCK + 1
    if n < 2:
        return np.zeros(len(starts), dtype=bool)
    prints = np.zeros(n, dtype=np.uint64)
    hashes = mixed(symbols.astype(np.uint64))
    for k in range(FIRST_BLOCK):
        prints = prints * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n]
    held = np.sort(prints)
    twice = np.unique(held[1:][held[1:] == held[:-1]])
    at = np.flatnonzero(np.isin(prints, twice))
    out = np.zeros(len(starts), dtype=bool)
    out[np.searchsorted(starts, at, side="right") - 1] = True
    return out & (lengths >= MIN_LENGTH)


def runs_of_texts(texts: list[list[bytes]], min_length: int = MIN_LENGTH, min_power: int = MIN_POWER) -> list[np.ndarray]:
    """Rows (start, length, period) of the runs of each list of words."""
    number = defaultdict(count(1).__next__)
    lengths = np.array([len(w) for w in texts], dtype=np.int64)
    starts = np.cumsum(lengths + 1) - lengths - 1
    words = np.zeros(int((lengths + 1).sum()), dtype=np.int64)
    for s, w in zip(starts.tolist(), texts):
        words[s : s + len(w)] = np.fromiter(map(number.__getitem__, w), dtype=np.int64, count=len(w))
    # texts share no number; 0 becomes the text's own end mark
    symbols = np.repeat(np.arange(len(texts)), lengths + 1) * (len(number) + 1) + words
    kept = np.flatnonzero(_repeating(symbols, starts, lengths))
    out = [np.empty((0, 3), dtype=np.int64)] * len(texts)
    if not kept.size:
        return out
    part = np.concatenate([symbols[starts[t] : starts[t] + lengths[t] + 1] for t in kept])
    begins = np.cumsum(lengths[kept] + 1) - lengths[kept] - 1
    rows = find_runs(part, int(lengths[kept].max()), min_length, min_power)
    owner = np.searchsorted(begins, rows[:, 0], side="right") - 1
    for k, t in enumerate(kept):
        own = rows[owner == k] if len(kept) < 64 else rows[np.searchsorted(owner, k) : np.searchsorted(owner, k, side="right")]
        out[t] = np.stack([own[:, 0] - begins[k], own[:, 1] - own[:, 0], own[:, 2]], 1)
    return out


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words joined by a space, of each run its first period only."""
    if not len(runs):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    keep = np.cumsum(change[:-1]) == 0
    return b" ".join([words[i] for i in np.flatnonzero(keep).tolist()])


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_power: int = MIN_POWER) -> DataFrame:
    """(key, n_words, runs by start and period, collapsed text) for every row of ``docs``."""
    ship(docs.sparkSession)
    kinds = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(column(batch, "t")):
                texts = [t.split() for t in utf8_values(column(batch, "t").slice(start, stop - start))]
                runs = runs_of_texts(texts, min_length, min_power)
                flat = np.concatenate(runs)
                offsets = np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int32)
                fields = pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], fields=list(kinds.value_type))
                short = pa.array([collapsed(w, r) for w, r in zip(texts, runs)], type=pa.binary()).cast(pa.string())
                n = pa.array([len(w) for w in texts], type=pa.int64())
                columns = [column(batch, "k").slice(start, stop - start), n, pa.ListArray.from_arrays(pa.array(offsets), fields, type=kinds), short]
                yield pa.RecordBatch.from_arrays(columns, names=["k", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    kind = rows.schema["k"].dataType.simpleString()
    return rows.mapInArrow(found, f"k {kind}, n_words long, runs {RUNS}, collapsed string").withColumnRenamed("k", key)


def planted(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The check's periodic texts: in every tenth row, by its key's crc32, the words repeat from a place on."""
    h = F.crc32(F.col(key).cast("string"))
    words = F.when(h % 10 == 0, F.regexp_extract_all(text, F.lit(f"({WORDS})"), 1))
    rows = docs.select(key, text, F.floor(h / 10).alias("g"), words.alias("w"))
    n, w = F.size("w"), F.col("w")
    a = F.pmod("g", n).cast("int")
    rows = rows.select(key, text, "w", n.alias("n"), a.alias("a"), (1 + F.floor((n - a) / (3 + F.pmod("g", F.lit(8))))).cast("int").alias("p"))
    rest = F.col("n") - F.col("a")
    again = F.array_repeat(F.slice(w, F.col("a") + 1, F.col("p")), F.ceil(rest / F.col("p")).cast("int"))
    whole = F.concat(F.slice(w, F.lit(1), F.col("a")), F.slice(F.flatten(again), F.lit(1), rest))
    return rows.select(key, F.when(F.col("n") > 0, F.array_join(whole, " ")).otherwise(F.col(text)).alias(text))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs and collapsed texts of all ``documents``, with the check's periodic texts in place."""
    docs = planted(table(spark, sf_dir, "documents"))
    r = F.col("runs")
    longer = F.reduce(r, F.get(r, F.lit(0)), lambda best, x: F.when(x["length"] * best["period"] > best["length"] * x["period"], x).otherwise(best))
    found = periodic_runs(docs).withColumn("best", longer)
    lines = F.transform(r, lambda x: F.concat(F.concat_ws(",", x["start"].cast("string"), x["length"].cast("string"), x["period"].cast("string")), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
