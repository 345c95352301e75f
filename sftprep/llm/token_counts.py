"""Operator 13: token counts with a whole-token shortcut, for byte-level BPE files.

Offline, once per tokenizer file, every vocabulary string is run through the
merges on its own.  Those that end as a single token are proven whole: as the
merges of a pre-token depend on nothing outside it, a pre-token equal to such a
string is exactly one token wherever it occurs.  Texts are split into
pre-tokens; the whole ones are counted by a lookup, and only the rest is merged.
Counts of merged pre-tokens are remembered up to a bound.

Counts equal the ``tokenizers`` library without special tokens added; the
file's own special strings inside a text count as one token each, as there.
Letters outside the verified ranges are split by the library's own pre-tokenizer.

Defined results: a null or empty text has no bytes and no tokens; texts of any
length are counted whole, in parts cut where white space follows a visible
character (no pre-token spans such a place); repeated rows each give a row; a
null key is passed through; an empty table gives an empty table; columns beside
the key and the text are not read.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sftprep.llm.bpe import byte_alphabet, slices
from sftprep.llm.common import column, ship, table

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 512
#: merged pre-tokens remembered per worker; then it starts anew
REMEMBERED = 500_000
#: characters of text that are split at once
SEGMENT = 1_000_000
#: pre-tokens above this many bytes are merged with a heap
LONG = 64
#: the byte-level pre-tokenizer's pattern (fixed value); L and N are its classes of letters and numbers
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"
#: code points whose classes are spelled out in the pattern: Latin, general punctuation, currency
VERIFIED = [(0x00, 0x24F), (0x2010, 0x2027), (0x2030, 0x205E), (0x20A0, 0x20BF)]
CUT = re.compile(r"(?<=\S)(?=\s)")


def _pieces() -> tuple[re.Pattern, re.Pattern]:
    """The pattern over the verified code points, and one that finds any other code point."""
    import regex

    points = [chr(c) for a, b in VERIFIED for c in range(a, b + 1)]
    kinds = {name: "".join(re.escape(c) for c in points if regex.match(p, c)) for name, p in (("L", r"\p{L}"), ("N", r"\p{N}"), ("S", r"\p{White_Space}"))}
    other = "".join(f"{chr(a)}-{chr(b)}" for a, b in VERIFIED[1:])
    return re.compile(PATTERN.format(**kinds)), re.compile(f"[^\x00-ɏ{other}]")


class Merges:
    """Byte-pair merges over byte strings."""

    def __init__(self, spec: dict):
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        plain = not spec["normalizer"] and not model.get("ignore_merges") and not model.get("dropout") and not model.get("end_of_word_suffix")
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex") or not plain:
            raise ValueError("not a plain byte-level BPE file")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("added tokens with matching options are not supported")
        self.byte = {c: b for b, c in enumerate(byte_alphabet())}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank = {(self.raw(a), self.raw(b)): r for r, (a, b) in enumerate(pairs)}
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.strings = [self.raw(t) for t in model["vocab"] if t not in set(self.special)]

    def raw(self, token: str) -> bytes:
        return bytes(map(self.byte.__getitem__, token))

    def count(self, piece: bytes) -> int:
        """Tokens of one pre-token: the merge of lowest rank first, leftmost among equals."""
        if len(piece) > LONG:
            return self._count_long(piece)
        parts = [piece[i : i + 1] for i in range(len(piece))]
        ranks = [self.rank.get(p) for p in zip(parts, parts[1:])]
        while True:
            best = min((r for r in ranks if r is not None), default=None)
            if best is None:
                return len(parts)
            i = ranks.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            ranks[max(0, i - 1) : i + 2] = [self.rank.get((parts[j], parts[j + 1])) for j in (i - 1, i) if 0 <= j < len(parts) - 1]

    def _count_long(self, piece: bytes) -> int:
        parts: list[bytes | None] = [piece[i : i + 1] for i in range(len(piece))]
        n = len(parts)
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, i + 1) for i in range(n - 1) if (r := self.rank.get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        count = n
        while heap:
            r, i, j = heapq.heappop(heap)
            # stale unless both sides are still neighbours with the merge of that rank
            if parts[i] is None or right[i] != j or j >= n or self.rank.get((parts[i], parts[j])) != r:
                continue
            parts[i], parts[j] = parts[i] + parts[j], None
            count -= 1
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
            for a, b in ((left[i], i), (i, right[i])):
                if a >= 0 and b < n and (new := self.rank.get((parts[a], parts[b]))) is not None:
                    heapq.heappush(heap, (new, a, b))
        return count

    def whole(self) -> frozenset[str]:
        """The vocabulary strings proven to be one token on their own (those that are text)."""
        out = set()
        for s in self.strings:
            if self.count(s) == 1:
                try:
                    out.add(s.decode())
                except UnicodeDecodeError:
                    pass  # part of a character: no pre-token equals it
        return frozenset(out)


class Counter(dict):
    """Tokens by pre-token: 1 for the whole ones, merged on demand for the rest."""

    def __init__(self, raw: bytes, whole: frozenset[str]):
        from tokenizers import Tokenizer

        self.merges, self.whole = Merges(json.loads(raw)), dict.fromkeys(whole, 1)
        self.library = Tokenizer.from_str(raw.decode()).pre_tokenizer
        self.pieces, self.unverified = _pieces()
        special = sorted(self.merges.special, key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.update(self.whole)

    def __missing__(self, piece: str) -> int:
        if len(self) > REMEMBERED + len(self.whole):
            self.clear()
            self.update(self.whole)
        n = self.merges.count(piece.encode())
        if len(piece) <= LONG:
            self[piece] = n
        return n

    def _segment(self, text: str) -> int:
        if not text.isascii() and self.unverified.search(text):
            raw = self.merges.raw
            return sum(self[raw(p).decode()] for p, _ in self.library.pre_tokenize_str(text))
        return sum(map(self.__getitem__, self.pieces.findall(text)))

    def _parts(self, text: str) -> Iterator[str]:
        """Parts of at most about SEGMENT characters, cut between a visible character and white space."""
        start = 0
        while len(text) - start > SEGMENT:
            at = CUT.search(text, start + SEGMENT)
            if at is None:
                break
            yield text[start : at.start()]
            start = at.start()
        yield text[start:] if start else text

    def count(self, text: str) -> int:
        between = self.special.split(text) if self.special else [text]
        return len(between) - 1 + sum(self._segment(s) for part in between for s in self._parts(part))


_LOADED: dict[bytes, Counter] = {}


def _loaded(raw: bytes, whole: frozenset[str]) -> Counter:
    if raw not in _LOADED:
        _LOADED.clear()
        _LOADED[raw] = Counter(raw, whole)
    return _LOADED[raw]


def count_tokens(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) for every row of ``docs``."""
    spark = docs.sparkSession
    ship(spark)
    with open(path, "rb") as f:
        raw = f.read()
    # a few MB each, whatever the corpus
    shared = spark.sparkContext.broadcast((raw, Merges(json.loads(raw)).whole()))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _loaded(*shared.value)
        for batch in batches:
            texts = column(batch, "t")
            for start, stop in slices(texts):
                n = [counter.count(t.as_py() or "") for t in texts.slice(start, stop - start)]
                yield pa.RecordBatch.from_arrays([*(column(batch, c).slice(start, stop - start) for c in ("k", "b")), pa.array(n, pa.int64())], names=["k", "b", "n"])

    rows = docs.select(F.col(key).alias("k"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("b"), F.col(text).alias("t"))
    kind = rows.schema["k"].dataType.simpleString()
    out = rows.mapInArrow(counted, f"k {kind}, b long, n long")
    return out.select(F.col("k").alias(key), F.col("b").alias("n_bytes"), F.col("n").alias("n_tokens"), (F.col("n") > limit).alias("over_limit"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every text of ``documents``."""
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
