"""Operator 2: benchmark decontamination by latent semantic retrieval.

Benchmark items are cut into pieces of at most PIECE words, documents into
passages of WINDOW words every STRIDE words.  Pieces and passages are TF-IDF
vectors over the benchmark's words; document frequencies are counted over the
passages of all documents.  A distributed randomised SVD finds the latent
space: every task adds up its share of A'(A R) for a fixed random R of RANDOM
columns, the shares are summed by word, and the left singular vectors of the sum are the
corpus's strongest directions.  Every passage of every document is compared with
every piece in two ways, in blocks, inside the scan: by the plain cosine, and by the
same product taken in the latent directions, where words that often occur together in the corpus
stand for each other.  A candidate has by either at least MIN_PART of the
cosine that an exact copy of the piece's length is expected to have.  Texts are split
into words once: the places of the words of the items and answers are saved, without the text, and
the later scans and checks read those.

Each candidate is then checked on the words themselves: the longest common
subsequence of the item and a stretch of the document of about its length, and
the item's answer (its ``answer`` column if named, else its last sentence).  Every
stretch is judged by itself; one with fewer words of the item than an accepted or better subsequence
needs is passed over.  A stretch is ``verbatim`` from 80 % of the item's words, and a ``paraphrase`` from
60 % with at least 80 % of the answer.

What reaches the driver grows with the benchmark, not with the corpus: its
words' counts and SPACE-sized matrices.  Benchmarks beyond GROUP spaces take
further scans.

Defined results: null or empty texts and items match nothing; an item without
words matches nothing; rows that
share a doc_id give one pair, the best; an empty table on either side gives no rows; other columns are
not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Hashable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from sftprep.llm.common import column, list_array, ship, stored, table

PIECE, WINDOW, STRIDE = 40, 80, 40
SPACE, RANDOM = 128, 24
#: directions that are kept of those: the others only make the first ones exact
RANK = 16
GROUP = 8
#: a word weighs nothing if it is in more than this share of all passages ...
MAX_FREQUENCY = 0.02
#: ... and in LEAKED times more of them than the rarest words (this quantile) of each piece that has it
LEAKED, RAREST = 3, 0.2
#: at least this share of a piece's different words keep their weight
KEPT = 0.5
MIN_WEIGHT = 0.5
#: a passage is checked from this part of the cosine that an exact copy of the piece is expected to have in it
MIN_PART = 0.5
VERBATIM, PARAPHRASE, ANSWER = 0.8, 0.6, 0.8
PUNCTUATION = b".,;:!?\"'()[]{}<>|#*$%&=+-_/\\@~`^"
SPACED = bytes.maketrans(PUNCTUATION, b" " * len(PUNCTUATION))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(SPACED).split()


def answer_of(text: str) -> list[bytes]:
    """The words of the last sentence."""
    sentences = [w for s in text.replace("?", ".").replace("!", ".").split(".") if (w := words_of(s))]
    return sentences[-1] if sentences else []


class Space:
    """The latent space of up to SPACE pieces: their words, weights, basis and latent vectors."""

    def __init__(self, pieces: list[tuple[int, list[bytes]]], names: list[bytes]):
        self.items = np.array([i for i, _ in pieces])
        # n words among WINDOW of like weight have a cosine of about sqrt(n / WINDOW) with the whole passage
        self.floor = MIN_PART * np.sqrt(np.array([min(1.0, len(w) / WINDOW) for _, w in pieces], dtype=np.float32))
        self.at = {w: k for k, w in enumerate(names)}
        self.pieces = pieces
        self.idf = self.basis = self.latent = self.own = None

    def weigh(self, seen: dict[bytes, int], passages: int) -> None:
        n = passages + len(self.pieces)
        df = np.array([seen.get(w, 0) + 1 for w in self.at], dtype=float)
        idf = np.maximum(np.log((1 + n) / df), MIN_WEIGHT)
        # where a piece's rarest words are frequent too, it has leaked widely: its words keep their weight
        allowed = np.full(len(df), MAX_FREQUENCY * n)
        for _, words in self.pieces:
            at = [self.at[w] for w in set(words)]
            allowed[at] = np.maximum(allowed[at], max(LEAKED * np.quantile(df[at], RAREST), np.quantile(df[at], KEPT)))
        self.idf = np.where(df > allowed, 0, idf).astype(np.float32)
        self.at = {w: k for w, k in self.at.items() if self.idf[k] > 0}
        rows = np.zeros((len(self.pieces), len(self.idf)), dtype=np.float32)
        for r, (_, words) in enumerate(self.pieces):
            for w in words:
                if w in self.at:
                    rows[r, self.at[w]] += self.idf[self.at[w]]
        self.rows = rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)

    def random(self) -> np.ndarray:
        return np.random.default_rng(len(self.idf)).standard_normal((len(self.idf), RANDOM)).astype(np.float32)

    def solve(self, share: np.ndarray, passages: int) -> None:
        """The corpus's strongest directions, from its share of A'A R, and the pieces in them."""
        u, s, _ = np.linalg.svd(share / np.sqrt(max(1, passages)), full_matrices=False)
        held = s > s[0] * 1e-6 if s.size and s[0] > 0 else np.zeros(len(s), dtype=bool)
        self.basis = u[:, :RANK][:, held[:RANK]].astype(np.float32)
        self.latent = self.rows @ self.basis
        # the pieces that hold each word, for the plain cosine
        word, piece = np.nonzero(self.rows.T)
        self.first = np.searchsorted(word, np.arange(len(self.idf) + 1))
        self.piece, self.value = piece, self.rows[piece, word]
        self.rows = None


def places_of(places: pa.Array, words: pa.Array, number: np.ndarray, limit: int = 400_000) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, row, position, number) of the weighty words, for runs of rows with about ``limit`` known words."""
    offsets = places.offsets.to_numpy()
    where, known = places.values.to_numpy(), words.values.to_numpy()
    start, n = 0, len(places)
    while start < n:
        stop = min(n, max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1))
        ids = number[known[offsets[start] : offsets[stop]]]
        owner = np.repeat(np.arange(start, stop), np.diff(offsets[start : stop + 1]))
        here = ids >= 0
        yield start, stop, owner[here], where[offsets[start] : offsets[stop]][here], ids[here]
        start = stop


class Passages:
    """The weighty words of some documents by blocks of STRIDE words, and the passages of two blocks each."""

    def __init__(self, space: Space, owner: np.ndarray, at: np.ndarray, ids: np.ndarray):
        ids = space.own[ids]
        here = ids >= 0
        owner, step, self.ids = owner[here], at[here] // STRIDE, ids[here]
        new = np.ones(len(step), dtype=bool)
        new[1:] = (step[1:] != step[:-1]) | (owner[1:] != owner[:-1])
        self.starts = np.flatnonzero(new)
        self.block = np.cumsum(new) - 1
        self.weight = space.idf[self.ids]
        owner, step = owner[self.starts], step[self.starts]
        n = len(owner)
        square = np.bincount(self.block, self.weight.astype(float) ** 2, minlength=n)
        follows = np.zeros(n, dtype=bool)
        follows[1:] = (owner[1:] == owner[:-1]) & (step[1:] == step[:-1] + 1)
        # a passage for each block and the next; and one that ends in a block whose predecessor holds no word
        lone = np.flatnonzero(~follows & (step > 0))
        self.pair = np.flatnonzero(follows) - 1
        self.first = np.concatenate([np.arange(n), lone])
        self.owner, self.begin = owner[self.first], np.concatenate([step, step[lone] - 1]) * STRIDE
        both = square[self.first]
        both[self.pair] += square[self.pair + 1]
        self.norm = np.sqrt(both).astype(np.float32)[:, None]

    def scaled(self, of_blocks: np.ndarray) -> np.ndarray:
        """Sums by block to sums by passage of unit length."""
        out = of_blocks[self.first]
        out[self.pair] += of_blocks[self.pair + 1]
        return out / self.norm

    def shared(self, of_passages: np.ndarray) -> np.ndarray:
        """For each block the sum over the passages that hold it."""
        scaled = of_passages / self.norm
        n = len(self.starts)
        out = scaled[:n].copy()
        out[self.pair + 1] += scaled[self.pair]
        out[self.first[n:]] += scaled[n:]
        return out

    def images(self, directions: np.ndarray) -> np.ndarray:
        """Each block's words in some directions."""
        return np.add.reduceat(directions[self.ids] * self.weight[:, None], self.starts)

    def dots(self, space: Space) -> np.ndarray:
        """Each block's product with every piece, through the pieces that hold its words."""
        count = space.first[self.ids + 1] - space.first[self.ids]
        entry = np.repeat(np.arange(len(self.ids)), count)
        at = np.arange(len(entry)) - np.repeat(np.cumsum(count) - count - space.first[self.ids], count)
        pieces = len(space.items)
        where = self.block[entry] * pieces + space.piece[at]
        return np.bincount(where, self.weight[entry] * space.value[at], minlength=len(self.starts) * pieces).astype(np.float32).reshape(-1, pieces)


def grouped(texts: pa.Array, limit: int = 400_000) -> Iterator[tuple[int, list[list[bytes]]]]:
    """(first row, words of the rows) for runs of rows with about ``limit`` words."""
    start, held, size = 0, [], 0
    for i, t in enumerate(texts):
        held.append(words_of(t.as_py()))
        size += len(held[-1])
        if size >= limit:
            yield start, held
            start, held, size = i + 1, [], 0
    if held:
        yield start, held


def common_length(mask: dict[Hashable, int], n: int, words: list) -> int:
    """Length of the longest common subsequence, one bit of an integer for each item word."""
    v = full = (1 << n) - 1
    for w in words:
        m = mask.get(w)
        if m:
            u = v & m
            v = (v + u | v - u) & full
    return n - v.bit_count()


def masks(words: list) -> dict[Hashable, int]:
    out: dict[Hashable, int] = defaultdict(int)
    for i, w in enumerate(words):
        out[w] |= 1 << i
    return dict(out)


def accepted(lcs: float, share: float) -> bool:
    return lcs >= VERBATIM or lcs >= PARAPHRASE and share >= ANSWER


class Item:
    """An item for checks: the masks of its words and of its answer's, by the numbers of the words."""

    def __init__(self, name: object, words: list[bytes], answer: list[bytes], number: dict[bytes, int]):
        self.name, self.size, self.answer_size = name, len(words), len(answer)
        self.mask, self.answer_mask = (masks([number[w] for w in part]) for part in (words, answer))


def checked(item: Item, at: np.ndarray, words: np.ndarray, length: int, start: int) -> tuple[float, float] | None:
    """Share of the item, and of its answer there, in the best accepted stretch of the document around a passage.

    The document of ``length`` words has the known ``words`` at the places ``at``;
    no other word is in a common subsequence.  Every stretch is judged by itself:
    one with more of the item but not its answer hides no other.
    """
    n = item.size
    stretch, step = n + max(2, n // 5), max(1, n // 8)
    lo, hi = max(0, start - n), min(length, start + WINDOW + n)
    stop = max(lo + 1, hi - stretch + step)
    a, b = np.searchsorted(at, (lo, stop - 1 + stretch))
    known, places = words[a:b].tolist(), at[a:b].tolist()
    here = [i for i, w in enumerate(known) if w in item.mask]
    if len(here) / n < PARAPHRASE:
        return None
    where, own = [places[i] for i in here], [known[i] for i in here]
    best = None
    for s in range(lo, stop, step):
        i, j = bisect_left(where, s), bisect_left(where, s + stretch)
        # the subsequence has at most j - i words
        if (j - i) / n < PARAPHRASE or best and (j - i) / n <= best[0]:
            continue
        share = common_length(item.mask, n, own[i:j]) / n
        if share < PARAPHRASE or best and share <= best[0]:
            continue
        part = known[bisect_left(places, s) : bisect_left(places, s + stretch)]
        told = common_length(item.answer_mask, item.answer_size, part) / max(1, item.answer_size)
        if accepted(share, told):
            best = (share, told)
    return best


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", question: str = "text", answer: str | None = None) -> DataFrame:
    """(key, item, cosine, lcs, answer_share, kind) for each document and item that it holds."""
    spark = docs.sparkSession
    ship(spark)
    items: dict[int, tuple[object, list[bytes], list[bytes]]] = {}
    pieces: list[tuple[int, list[bytes]]] = []
    picked = benchmark.select(item, question, *([answer] if answer else [])).orderBy(item, question)
    for n, row in enumerate(picked.toLocalIterator()):
        words = words_of(row[1])
        items[n] = (row[0], words, (words_of(row[2]) if answer else []) or answer_of(row[1] or ""))
        parts = -(-len(words) // PIECE)
        pieces += [(n, words[k * len(words) // parts : (k + 1) * len(words) // parts]) for k in range(parts)]
    out = None
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    for g in range(0, max(1, len(pieces)), SPACE * GROUP):
        part = pieces[g : g + SPACE * GROUP]
        own = {i: items[i] for i, _ in part}
        found = _search(rows, part, own, benchmark.schema[item].dataType.simpleString())
        out = found if out is None else out.union(found)
    best = F.max(F.struct("lcs", "cosine", "answer_share"))
    out = out.groupBy("k", "item").agg(best.alias("b"))
    kind = F.when(F.col("b.lcs") >= VERBATIM, "verbatim").otherwise("paraphrase")
    return out.select(F.col("k").alias(key), F.col("item").alias(item), "b.cosine", "b.lcs", "b.answer_share", kind.alias("kind"))


def _search(rows: DataFrame, pieces: list, items: dict, item_kind: str) -> DataFrame:
    """One scan group: frequencies, latent spaces, search."""
    spark = rows.sparkSession
    parts = [pieces[i : i + SPACE] for i in range(0, len(pieces), SPACE)]
    names = [list(dict.fromkeys(w for _, words in p for w in words)) for p in parts]
    spaces = [Space(p, n) for p, n in zip(parts, names)]
    # after the words of the spaces those that only checks ask for: of an item's other pieces, of answers
    searched = dict.fromkeys(w for n in names for w in n)
    known = spark.sparkContext.broadcast({w: k for k, w in enumerate(searched | dict.fromkeys(w for i in items.values() for part in i[1:] for w in part))})
    items = {i: Item(*item, known.value) for i, item in items.items()}

    def known_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row's length and the places of the words that the benchmark has; at the end the passages that hold each word."""
        at = known.value
        seen, passages = np.zeros(len(at) + 1, dtype="<i8"), 0
        names = ["k", "n", "at", "w", "seen"]
        for batch in batches:
            for first, docs in grouped(column(batch, "t")):
                ids, blocks, places = [], [], []
                for words in docs:
                    found = np.fromiter(map(at.get, words, repeat(-1)), dtype=np.int32, count=len(words))
                    here = np.flatnonzero(found >= 0)
                    places.append(here)
                    ids.append(found[here])
                    blocks.append(passages + here // STRIDE)
                    passages += -(-len(words) // STRIDE)
                once = np.unique(np.concatenate(blocks) * (len(at) + 1) + np.concatenate(ids))
                seen += np.bincount(once % (len(at) + 1), minlength=len(at) + 1)
                sizes = pa.array([len(words) for words in docs], pa.int32())
                yield pa.RecordBatch.from_arrays([column(batch, "k").slice(first, len(docs)), sizes, list_array(places, pa.int32()), list_array(ids, pa.int32()), pa.nulls(len(docs), pa.binary())], names=names)
        seen[-1] = passages
        empty = list_array([np.empty(0)], pa.int32())
        yield pa.RecordBatch.from_arrays([pa.nulls(1, keys), pa.nulls(1, pa.int32()), empty, empty, pa.array([seen.tobytes()], pa.binary())], names=names)

    kind = rows.schema["k"].dataType.simpleString()
    keys = to_arrow_type(rows.schema["k"].dataType)
    places = stored(rows.mapInArrow(known_words, f"k {kind}, n int, at array<int>, w array<int>, seen binary"), "known-words")
    size = len(known.value) + 1

    def summed_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype="<i8")
        for batch in batches:
            for part in column(batch, "seen"):
                total += np.frombuffer(part.as_py(), dtype="<i8")
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["w", "n"])

    tasks = places.select("seen").filter("seen IS NOT NULL")
    places = places.filter("seen IS NULL")
    counts = {r.w: r.n for r in tasks.mapInArrow(summed_up, "w long, n long").groupBy("w").agg(F.sum("n").alias("n")).toLocalIterator()}
    passages = counts.pop(len(known.value), 0)
    seen = {w: counts.get(k, 0) for w, k in known.value.items()}
    for s in spaces:
        s.weigh(seen, passages)
    weighty = list(dict.fromkeys(w for s in spaces for w in s.at))
    for s in spaces:
        s.own = np.array([s.at.get(w, -1) for w in weighty], dtype=np.int32)
    place = {w: k for k, w in enumerate(weighty)}
    number = np.array([place.get(w, -1) for w in known.value] or [-1], dtype=np.int32)  # known word to weighty word
    weighed = spark.sparkContext.broadcast(spaces)

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spaces = weighed.value
        randoms = [s.random() for s in spaces]
        sums = [np.zeros(r.shape, dtype=np.float32) for r in randoms]
        for batch in batches:
            for _, _, *found in places_of(column(batch, "at"), column(batch, "w"), number):
                for s, r, total in zip(spaces, randoms, sums):
                    p = Passages(s, *found)
                    if len(p.starts):
                        back = p.shared(p.scaled(p.images(r)))[p.block] * p.weight[:, None]
                        order = np.argsort(p.ids, kind="stable")
                        words, first = np.unique(p.ids[order], return_index=True)
                        total[words] += np.add.reduceat(back[order], first)
        for k, total in enumerate(sums):
            held = np.flatnonzero(total.any(1))
            for a in range(0, len(held), 2_000):
                part = held[a : a + 2_000]
                lists = pa.FixedSizeListArray.from_arrays(pa.array(total[part].ravel()), RANDOM).cast(pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), k)), pa.array(part), lists], names=["s", "w", "v"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of sorted rows of equal (s, w)."""
        held, total = None, None
        for batch in batches:
            s, w = column(batch, "s").to_numpy(), column(batch, "w").to_numpy()
            v = column(batch, "v").values.to_numpy().reshape(-1, RANDOM)
            cuts = np.append(0, np.flatnonzero((s[1:] != s[:-1]) | (w[1:] != w[:-1])) + 1) if len(s) else np.empty(0, int)
            sums = np.add.reduceat(v.astype(float), cuts) if len(s) else v
            for i, c in enumerate(cuts):
                if held == (s[c], w[c]):
                    total = total + sums[i]
                else:
                    if held is not None:
                        yield _share(held, total)
                    held, total = (s[c], w[c]), sums[i]
        if held is not None:
            yield _share(held, total)

    partial = places.select("at", "w").mapInArrow(shares, "s long, w long, v array<float>")
    sums = [np.zeros((len(s.idf), RANDOM)) for s in spaces]
    if pieces:
        dealt = partial.repartition("s", "w").sortWithinPartitions("s", "w")
        for r in dealt.mapInArrow(summed, "s long, w long, v array<double>").toLocalIterator():
            sums[r.s][r.w] = r.v
    for s, total in zip(spaces, sums):
        s.solve(total, passages)
    solved = spark.sparkContext.broadcast((spaces, items))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spaces, items = solved.value
        for batch in batches:
            at, words, length = column(batch, "at"), column(batch, "w"), column(batch, "n").to_numpy()
            starts, where, what = at.offsets.to_numpy(), at.values.to_numpy(), words.values.to_numpy()
            for _, _, *found in places_of(at, words, number):
                best: dict[tuple[int, int], tuple] = {}
                for s in spaces:
                    passage = Passages(s, *found)
                    if not len(passage.starts):
                        continue
                    cosine = passage.scaled(passage.dots(s))
                    # the same product through the corpus's directions: words that occur together stand for each other
                    latent = passage.scaled(passage.images(s.basis)) @ s.latent.T
                    for p, q in zip(*np.nonzero((cosine >= s.floor) | (latent >= s.floor))):
                        d, item = int(passage.owner[p]), int(s.items[q])
                        own = slice(starts[d], starts[d + 1])
                        hit = checked(items[item], where[own], what[own], int(length[d]), int(passage.begin[p]))
                        if hit:
                            best[d, item] = max(best.get((d, item), (0.0,)), (hit[0], float(cosine[p, q]), hit[1]))
                if best:
                    rows = pa.array([d for d, _ in best])
                    names = pa.array([items[i].name for _, i in best])
                    columns = [pa.array([b[c] for b in best.values()], pa.float64()) for c in (1, 0, 2)]
                    yield pa.RecordBatch.from_arrays([column(batch, "k").take(rows), names, *columns], names=["k", "item", "cosine", "lcs", "answer_share"])

    return places.select("k", "n", "at", "w").mapInArrow(search, f"k {kind}, item {item_kind}, cosine double, lcs double, answer_share double")


def _share(at: tuple, total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([at[0]]), pa.array([at[1]]), pa.array([total], pa.list_(pa.float64()))], names=["s", "w", "v"])


def drop_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, columns unchanged."""
    found = stored(leaks(docs, benchmark, key, text, **options).select(F.col(key).alias("leaky")).distinct(), "leaks")
    return docs.join(found, docs[key] == found["leaky"], "left_anti")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaks of ``benchmark`` in every row of ``documents``."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
