"""Operator 10: byte-pair encoding and decoding with forced-boundary splitting.

A merge can only join two neighbouring bytes if some vocabulary token holds
them side by side.  Byte pairs that no token holds are therefore certain cuts:
the fragments between them (and between the pre-tokenizer's pieces) are encoded
independently and their ids concatenated.  Fragments repeat far more often than
texts do, so each worker remembers the ids of those it has met, and runs the
merges for the unknown fragments of a batch together as one numpy matrix.

Results equal the ``tokenizers`` library for the word-level BPE file format
(NFC, white space dropped, lower case, ``</w>`` word ends), without special
tokens added; the file's own special strings inside a text map to their ids, as
the library does.

Defined results: a null or empty text has no ids and decodes to ``''``; texts
of any length are encoded whole, in segments cut at white space; repeated rows
each give a row; an empty table gives an empty table; a null key column is
passed through; columns beside the key and the text are not read.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sftprep.llm.common import column, list_array, ship, table

VOCABULARY = "word_bpe_49k.json"
NONE = np.int32(2**31 - 1)
#: bytes that UTF-8 never has: the end of a pre-tokenizer piece, the end of a word
END, WORD = b"\xff", b"\xfe"
MARK = "\ue000"  # stands for END until the text is encoded; not a common letter
#: remembered fragments and white-space separated strings per worker; then it starts anew
REMEMBERED = 300_000
#: words of the compact word table, which arrays of texts use
TABLE = 1_500_000
#: longest fragment that goes through the matrix; longer ones use a heap
MATRIX_WIDTH = 48
#: characters of text that are split into words at once
SEGMENT = 1_000_000
#: white space of the pre-tokenizer's \s (fixed value): str.split() also splits at \x1c-\x1f
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
WHITE = re.compile(f"[{SPACES}]")
WORDS = re.compile(f"[^{SPACES}]+")
SEPARATORS = re.compile("[\x1c-\x1f]")
#: up to here Python's and the library's Unicode tables agree; other words ask the library for their pieces
COMMON = re.compile("[\x00-\u024f]*")


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte value, as byte-level BPE files write them."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = {b: chr(b) for b in shown}, 256
    for b in range(256):
        if b not in letters:
            letters[b] = chr(extra)
            extra += 1
    return [letters[b] for b in range(256)]


def common_pieces() -> re.Pattern:
    """The pre-tokenizer's pattern, or a space, with the classes of the lower-cased common letters spelled out."""
    import regex

    lowered = sorted({c for i in range(0x250) for c in chr(i).lower()})
    letters, numbers = ("".join(c for c in lowered if regex.match(rf"\p{{{kind}}}", c)) for kind in "LN")
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{SPACES}{letters}{numbers}]+| ")


class Vocabulary:
    """Tables built once per worker from the bytes of a tokenizer file."""

    def __init__(self, raw: bytes):
        from tokenizers import Tokenizer

        spec = json.loads(raw)
        self.library = Tokenizer.from_str(raw.decode())
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.ids = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pieces = common_pieces()
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        size = max([*self.ids.values(), *self.special.values()]) + 1
        self.kind = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self.tokens = [""] * size
        for token, i in [*self.ids.items(), *self.special.items()]:
            self.tokens[i] = token
        letters = byte_alphabet()
        self.value = value = {c: b for b, c in enumerate(letters)}
        self.inner = np.array([self.ids[c] for c in letters], dtype=np.int32)
        self.last = np.array([self.ids[c + self.end] for c in letters], dtype=np.int32)
        self._merge_table(model["merges"])
        self.joined = np.zeros((256, 256), dtype=bool)  # byte pairs that some token holds
        for token in self.ids:
            b = [value[c] for c in token.removesuffix(self.end) if c in value]
            self.joined[b[:-1], b[1:]] = True
        self.joined[END[0], :] = self.joined[:, END[0]] = True
        self.words: dict[str, bytes] = {}
        self._clear_table()
        self.fragments: dict[bytes, bytes] = {}  # a fragment that ends its piece has END at its end

    def _merge_table(self, merges: list) -> None:
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        self.merged = np.array([self.ids[a + b] for a, b in pairs], dtype=np.int32)
        self.rank = {(self.ids[a], self.ids[b]): r for r, (a, b) in enumerate(pairs)}
        keys = np.array([a << 32 | b for a, b in self.rank], dtype=np.uint64)
        ranks = np.fromiter(self.rank.values(), dtype=np.int32, count=len(keys))
        self.slot_bits = max(12, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        mask = (1 << self.slot_bits) - 1
        self.slot_key = np.full(mask + 1, np.uint64(2**64 - 1))
        self.slot_rank = np.full(mask + 1, NONE, dtype=np.int32)
        waiting, shift = np.arange(len(keys)), 0
        home = self._slots(keys)
        while len(waiting):  # linear probing: every key of a slot but the first tries the next slot
            slot = (home[waiting] + shift) & mask
            free = self.slot_rank[slot] == NONE
            _, first = np.unique(slot, return_index=True)
            take = np.zeros(len(waiting), dtype=bool)
            take[first] = True
            take &= free
            self.slot_key[slot[take]], self.slot_rank[slot[take]] = keys[waiting[take]], ranks[waiting[take]]
            waiting, shift = waiting[~take], shift + 1
        self.probes = shift

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.slot_bits)).astype(np.int64)

    def ranks_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge ranks of symbol pairs; NONE where no merge joins them (or a symbol is missing, -1)."""
        keys = a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64) & np.uint64(0xFFFFFFFF)
        flat, out = keys.ravel(), np.full(keys.size, NONE, dtype=np.int32)
        home, mask = self._slots(flat), len(self.slot_key) - 1
        left = np.arange(flat.size)
        for shift in range(self.probes):
            slot = (home[left] + shift) & mask
            held = self.slot_key[slot]
            hit = held == flat[left]
            out[left[hit]] = self.slot_rank[slot[hit]]
            left = left[~hit & (self.slot_rank[slot] != NONE)]
            if not left.size:
                break
        return out.reshape(keys.shape)

    # -- merging ---------------------------------------------------------------

    def _merge_matrix(self, fragments: list[bytes]) -> list[bytes]:
        flat = np.frombuffer(b"".join(fragments), dtype=np.uint8)
        lengths = np.fromiter(map(len, fragments), dtype=np.int64, count=len(fragments))
        final = flat[np.cumsum(lengths) - 1] == END[0]
        flat, lengths = flat[flat != END[0]], lengths - final
        n, width = len(fragments), int(lengths.max())
        here = np.arange(width)[None, :] < lengths[:, None]
        symbols = np.full((n, width + 1), -1, dtype=np.int32)
        symbols[:, :width][here] = self.inner[flat]
        symbols[final, lengths[final] - 1] = self.last[flat[np.cumsum(lengths)[final] - 1]]
        done = symbols.copy()
        rows = np.arange(n)
        ranks = self.ranks_of(symbols[:, :-1], symbols[:, 1:])
        while rows.size:
            at = ranks.argmin(1)
            best = ranks[np.arange(rows.size), at]
            busy = best != NONE
            if not busy.all():
                done[rows[~busy]] = symbols[~busy]
                rows, symbols, ranks, at, best = rows[busy], symbols[busy], ranks[busy], at[busy], best[busy]
                if not rows.size:
                    break
            each = np.arange(rows.size)
            after = np.arange(symbols.shape[1])[None, :] > at[:, None]
            shifted = np.concatenate([symbols[:, 1:], np.full((rows.size, 1), -1, dtype=np.int32)], 1)
            symbols = np.where(after, shifted, symbols)
            symbols[each, at] = self.merged[best]
            shifted = np.concatenate([ranks[:, 1:], np.full((rows.size, 1), NONE, dtype=np.int32)], 1)
            ranks = np.where(after[:, :-1], shifted, ranks)
            ranks[each, at] = self.ranks_of(symbols[each, at], symbols[each, at + 1])
            before = np.flatnonzero(at > 0)
            left = at[before] - 1
            ranks[before, left] = self.ranks_of(symbols[before, left], symbols[before, left + 1])
        kept = done >= 0
        data = done[kept].astype(self.kind).tobytes()
        cuts = np.concatenate([[0], np.cumsum(kept.sum(1))]) * self.kind.itemsize
        return [data[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]

    def _merge_long(self, fragment: bytes) -> bytes:
        """The same merges for one long fragment: lowest rank first, leftmost among equals."""
        final, fragment = fragment.endswith(END), fragment.removesuffix(END)
        symbols = [int(i) for i in self.inner[np.frombuffer(fragment, dtype=np.uint8)]]
        if final:
            symbols[-1] = int(self.last[fragment[-1]])
        n = len(symbols)
        following, previous = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, symbols[i], symbols[i + 1]) for i in range(n - 1) if (r := self.rank.get((symbols[i], symbols[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = following[i]
            if symbols[i] != a or j >= n or symbols[j] != b:
                continue
            symbols[i], symbols[j] = int(self.merged[r]), -1
            following[i] = following[j]
            if following[j] < n:
                previous[following[j]] = i
            for p, q in ((previous[i], i), (i, following[i])):
                if p >= 0 and q < n and (new := self.rank.get((symbols[p], symbols[q]))) is not None:
                    heapq.heappush(heap, (new, p, symbols[p], symbols[q]))
        return np.array([s for s in symbols if s >= 0], dtype=self.kind).tobytes()

    def _learn_fragments(self, fragments: set[bytes]) -> None:
        by_width: dict[int, list[bytes]] = {}
        for f in fragments:
            if len(f) > MATRIX_WIDTH:
                self.fragments[f] = self._merge_long(f)
            else:
                by_width.setdefault(-(-len(f) // 4), []).append(f)
        for same in by_width.values():
            for i in range(0, len(same), 20_000):
                part = same[i : i + 20_000]
                self.fragments.update(zip(part, self._merge_matrix(part)))

    # -- splitting -------------------------------------------------------------

    def _marked(self, words: list[str]) -> bytes:
        """All pieces of ``words`` as UTF-8, END after each piece and WORD after each word."""
        common = " ".join(words)
        if not common.isascii():
            common = unicodedata.normalize("NFC", common)
        pieces = self.pieces.findall(common.lower())
        return MARK.join(pieces).encode().replace(MARK.encode(), END).replace(END + b" " + END, END + WORD) + END + WORD

    def _rare(self, word: str) -> bytes:
        """The same for one word outside the common letters, by the library's own splitting."""
        pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(word))
        return b"".join(bytes(map(self.value.__getitem__, p)) + END for p, _ in pieces) + WORD

    def _learn_words(self, words: list[str]) -> None:
        words, ids, upto = self._ids_of_words(words)
        ends = upto.tolist()
        self.words.update(zip(words, [ids[x:y] for x, y in zip([0, *ends[:-1]], ends)]))

    def _ids_of_words(self, words: list[str]) -> tuple[list[str], bytes, np.ndarray]:
        """The words in another order, all their ids, and where each word's ids end (in bytes)."""
        if len(self.fragments) > REMEMBERED:
            self.fragments.clear()
        rare = [] if COMMON.fullmatch("".join(words)) else [w for w in words if not COMMON.fullmatch(w)]
        common = [w for w in words if COMMON.fullmatch(w)] if rare else words
        marked = (self._marked(common) if common else b"") + b"".join(map(self._rare, rare))
        with_marks = np.frombuffer(marked, dtype=np.uint8)
        at_word = with_marks == WORD[0]
        data = with_marks[~at_word]
        word_ends = np.flatnonzero(at_word) - np.arange(int(at_word.sum()))
        # a fragment ends after each END and at each byte pair that no token holds
        cut = np.append(~self.joined[data[:-1], data[1:]], True)
        cut |= data == END[0]
        bounds = np.flatnonzero(cut) + 1
        plain, stops = data.tobytes(), bounds.tolist()
        fragments = [plain[x:y] for x, y in zip([0, *stops[:-1]], stops)]
        self._learn_fragments(set(fragments) - self.fragments.keys())
        ids = list(map(self.fragments.__getitem__, fragments))
        joined = b"".join(ids)
        ends = np.cumsum(np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)))
        return [*common, *rare], joined, ends[np.searchsorted(bounds, word_ends, side="right") - 1]

    def _plain(self, segments: list[str]) -> list[bytes]:
        split = [WORDS.findall(s) if SEPARATORS.search(s) else s.split() for s in segments]
        needed = set().union(*split)
        unknown = needed - self.words.keys()
        if len(self.words) + len(unknown) > REMEMBERED:
            self.words.clear()
            unknown = needed
        if unknown:
            self._learn_words(list(unknown))
        return [b"".join(map(self.words.__getitem__, s)) for s in split]

    def segments(self, text: str) -> Iterator[str]:
        """Parts of at most about SEGMENT characters, cut at white space."""
        start = 0
        while len(text) - start > SEGMENT:
            gap = WHITE.search(text, start + SEGMENT)
            if gap is None:
                break
            yield text[start : gap.start()]
            start = gap.start()
        yield text[start:] if start else text

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, as little-endian integers of ``kind``."""
        out: list[list[bytes]] = [[] for _ in texts]
        waiting: list[tuple[int, str]] = []

        def flush() -> None:
            for (i, _), ids in zip(waiting, self._plain([s for _, s in waiting])):
                out[i].append(ids)
            waiting.clear()

        size = 0
        for i, text in enumerate(texts):
            parts = self.special_pattern.split(text or "") if self.special and text else [text or ""]
            for k, part in enumerate(parts):
                if k % 2:
                    flush()
                    out[i].append(np.array([self.special[part]], dtype=self.kind).tobytes())
                    continue
                for segment in self.segments(part):
                    waiting.append((i, segment))
                    size += len(segment)
                    if size > SEGMENT:
                        flush()
                        size = 0
        flush()
        return [b"".join(parts) for parts in out]

    def _table_places(self, distinct: pa.Array) -> np.ndarray:
        """Places of some distinct words in the word table; unknown words are encoded and appended."""
        import pyarrow.compute as pc

        if len(self.table_words) + len(distinct) > TABLE:
            self._clear_table()
        found = pc.index_in(distinct, value_set=self.table_words)
        missing = found.is_null()
        new = distinct.filter(missing)
        place = pc.fill_null(found, -1).to_numpy(zero_copy_only=False).copy()
        if not len(new):
            return place
        words, ids, upto = self._ids_of_words(new.to_pylist())
        ends = upto // self.kind.itemsize
        sizes = np.diff(ends, prepend=0)
        self.table_begins = np.concatenate([self.table_begins, len(self.table_ids) + ends - sizes])
        self.table_sizes = np.concatenate([self.table_sizes, sizes])
        self.table_ids = np.concatenate([self.table_ids, np.frombuffer(ids, dtype=self.kind)])
        known, ordered = len(self.table_words), pa.array(words, pa.large_string())
        self.table_words = pa.concat_arrays([self.table_words, ordered])
        place[missing.to_numpy(zero_copy_only=False)] = known + pc.index_in(new, value_set=ordered).to_numpy()
        return place

    def _clear_table(self) -> None:
        """The word table holds the empty string only (what splitting leaves beside white space)."""
        self.table_words = pa.array([""], pa.large_string())
        self.table_begins, self.table_sizes = np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)
        self.table_ids = np.empty(0, dtype=self.kind)

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text's ids end): every distinct word of the array is looked up once."""
        import pyarrow.compute as pc

        texts = pc.fill_null(texts, "").cast(pa.large_string())
        # special strings, the separators that are no white space here, and long texts go one by one
        apart = pc.or_(pc.match_substring_regex(texts, "[\x1c-\x1f]"), pc.greater(pc.binary_length(texts), SEGMENT))
        for special in self.special:
            apart = pc.or_(apart, pc.match_substring(texts, special))
        plain = texts.filter(pc.invert(apart))
        words = pc.utf8_split_whitespace(plain)
        coded = words.flatten().dictionary_encode()
        place = self._table_places(coded.dictionary)
        begins, sizes, flat = self.table_begins[place], self.table_sizes[place], self.table_ids
        at = coded.indices.to_numpy()
        lengths = sizes[at]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        ids = flat[np.repeat(begins[at] - ends + lengths, lengths) + np.arange(total)]
        bounds = np.cumsum(pc.list_value_length(words).to_numpy())
        stops = np.concatenate([[0], ends])[bounds]
        rare = np.flatnonzero(apart.to_numpy(zero_copy_only=False))
        if not rare.size:
            return ids, stops
        pieces = np.split(ids, stops[:-1]) if len(stops) else []
        order = iter(pieces)
        special_ids = dict(zip(rare.tolist(), self.encode([texts[int(i)].as_py() for i in rare])))
        each = [np.frombuffer(special_ids[i], dtype=self.kind) if i in special_ids else next(order) for i in range(len(texts))]
        return np.concatenate(each), np.cumsum([len(x) for x in each])

    def decode(self, ids: np.ndarray) -> str:
        """Token strings joined by a space: what a file without a decoder gives."""
        return " ".join(map(self.tokens.__getitem__, ids.tolist()))


_LOADED: dict[int, tuple[bytes, Vocabulary]] = {}


def loaded(raw: bytes) -> Vocabulary:
    """The tables for a file's bytes, built once per worker process."""
    import zlib

    key = zlib.crc32(raw)
    if key not in _LOADED or _LOADED[key][0] != raw:
        _LOADED.clear()
        _LOADED[key] = (raw, Vocabulary(raw))
    return _LOADED[key][1]


def shared_file(spark: SparkSession, path: str):
    """The tokenizer file's bytes as a broadcast: a few MB, whatever the corpus."""
    ship(spark)
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode_documents(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, token_ids array<int>) for every row of ``docs``."""
    file = shared_file(docs.sparkSession, path)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = loaded(file.value)
        for batch in batches:
            for start, stop in slices(column(batch, "t")):
                ids = vocabulary.encode(column(batch, "t").slice(start, stop - start).to_pylist())
                arrays = [np.frombuffer(i, dtype=vocabulary.kind).astype(np.int32) for i in ids]
                yield pa.RecordBatch.from_arrays([column(batch, "k").slice(start, stop - start), list_array(arrays, pa.int32())], names=["k", "token_ids"])

    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    kind = rows.schema["k"].dataType.simpleString()
    return rows.mapInArrow(encoded, f"k {kind}, token_ids array<int>").withColumnRenamed("k", key)


def slices(texts: pa.Array, limit: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch that hold about ``limit`` bytes of text each, at least one row."""
    import pyarrow.compute as pc

    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        base = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, base + limit, side="right")))
        yield start, stop
        start = stop


def decode_documents(ids: DataFrame, path: str, key: str = "doc_id", token_ids: str = "token_ids") -> DataFrame:
    """(key, decoded) for rows of token ids; a null list decodes to ''."""
    file = shared_file(ids.sparkSession, path)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = loaded(file.value)
        for batch in batches:
            lists = column(batch, "i")
            offsets = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False)
            row, n = 0, len(lists)
            while row < n:
                stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + 1_000_000, side="right")) - 1)
                stop = min(stop, n)
                texts = [vocabulary.decode(flat[offsets[r] : offsets[r + 1]]) for r in range(row, stop)]
                yield pa.RecordBatch.from_arrays([column(batch, "k").slice(row, stop - row), column(batch, "i").slice(row, stop - row), pa.array(texts, type=pa.string())], names=["k", "i", "decoded"])
                row = stop

    rows = ids.select(F.col(key).alias("k"), F.coalesce(F.col(token_ids), F.array().cast("array<int>")).alias("i"))
    kind = rows.schema["k"].dataType.simpleString()
    return rows.mapInArrow(decoded, f"k {kind}, i array<int>, decoded string").withColumnsRenamed({"k": key, "i": token_ids})


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` encoded and decoded; digests of the ids and of the decoded text."""
    import public_tokenizers

    path = public_tokenizers.path(VOCABULARY)
    both = decode_documents(encode_documents(table(spark, sf_dir, "documents"), path), path)
    return both.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
