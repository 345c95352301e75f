"""Operator 9: quality rules with a distribution-divergence verdict.

Base counts decide the obvious cases.  Beyond them, a document's histograms of
character classes and of common words are compared with references of each
language by Jensen-Shannon distance (base 2, 0 to 1).  References are sums over
all base-passing documents that declare the language, so they follow the
corpus.  A document is measured against its nearest language; it is rejected if
a distance is above its limit.  All words that are not common share one bin, so
even a text without any common word stays near the references by its words; the
share of common words is therefore measured on its own, as a fraction of the
distance that a text without them has, and rejected beyond half of it (a share above
the reference's is never divergent).  A document that declares a language without a word
list is compared by its character classes only, with its own language's texts among the
references: no verdict on words is given without a reference for them.  Short documents are
guarded: below ``min_words`` words no divergence verdict is given.

Defined results: null text counts as empty; empty text has no words and fails
the base rule; a null language, or one that is no language tag, only means that the document adds to
no reference and is judged by all that have words; without any reference (empty table) the base rule decides alone;
repeated rows each give a row; texts are taken whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from sftprep.llm.bpe import slices
from sftprep.llm.common import column, list_array, ship, stored, table, utf8_values

#: common words of the reference languages (fixed values)
COMMON_WORDS = {
    "en": "the of and to in is that it was for on are as with be this by from at have",
    "fr": "le la les de des et en un une du que qui dans pour par sur est avec au pas",
    "de": "der die das und zu in den von mit sich ist nicht ein eine als auf im dem für auch",
    "es": "el la los las de y que en un una por con para se del al es no como su",
}
#: a declared language: its primary subtag (at most 26**2 + 26**3 of them) names the reference
TAG = re.compile("([a-z]{2,3})(?:[-_][a-z0-9]{1,8})*")
MIN_WORDS = 50
MAX_CLASS_DISTANCE = 0.30
MAX_WORD_DISTANCE = 0.50
#: half way from the reference's share of common words to none
MAX_SHARE_DISTANCE = 0.50
WINDOW = 8
SYMBOLS = b"#*$%&|<>"
WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"
FEATURES = (
    "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,"
    "classes:array<bigint>,words:array<bigint>>"
)
CLASS_NAMES = ["lower", "upper", "digit", "white", "stop", "symbol", "accented", "other"]


def _class_table() -> np.ndarray:
    """Class of each byte; continuation bytes of UTF-8 have none, so a character counts once."""
    out = np.full(256, CLASS_NAMES.index("other"))
    out[[*range(ord("a"), ord("z") + 1)]] = 0
    out[[*range(ord("A"), ord("Z") + 1)]] = 1
    out[[*range(ord("0"), ord("9") + 1)]] = 2
    out[list(WHITE)] = 3
    out[list(b".,;:!?'\"()-")] = 4
    out[list(b"#*$%&|<>=+@/\\^~_`{}[]")] = 5
    out[0xC3:0xC6] = 6  # Latin-1 supplement and Latin extended-A
    out[0x80:0xC0] = len(CLASS_NAMES)
    return out


CLASSES = _class_table()
BINS = {w.encode(): i for i, w in enumerate(dict.fromkeys(w for ws in COMMON_WORDS.values() for w in ws.split()))}
N_BINS = len(BINS) + 1  # the last holds all other words


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a WINDOW-word window found twice or more in the text."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    hashes = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).astype(np.uint64)
    prints = np.zeros(n, dtype=np.uint64)
    for k in range(WINDOW):
        prints = prints * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n]
    order = np.argsort(prints, kind="stable")
    same = prints[order][1:] == prints[order][:-1]
    if not same.any():
        return 0
    alike = np.zeros(n, dtype=bool)
    alike[order[1:][same]] = alike[order[:-1][same]] = True
    found = np.flatnonzero(alike).tolist()  # equal fingerprints are confirmed word by word
    seen = Counter(tuple(words[i : i + WINDOW]) for i in found)
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    for i in found:
        if seen[tuple(words[i : i + WINDOW])] > 1:
            covered[i] += 1
            covered[i + WINDOW] -= 1
    return int((np.cumsum(covered) > 0).sum())


def features_of(text: bytes) -> tuple:
    words = text.split()
    counts = np.bincount(CLASSES[np.frombuffer(text, dtype=np.uint8)], minlength=len(CLASS_NAMES) + 1)[:-1]
    code_points = int(counts.sum())
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [s for s in text.split(b"\n") if s and not s.isspace()]
    bins = [0] * N_BINS
    for w, n in Counter(map(BINS.get, text.lower().translate(None, b".,;:!?\"'()").split())).items():
        bins[-1 if w is None else w] = n
    return (len(words), code_points - int(counts[3]), symbols, len(lines) - len(set(lines)), repeat_words(words), counts.tolist(), bins)


FEATURE_NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURE_TYPE = pa.struct([*[pa.field(n, pa.int64()) for n in FEATURE_NAMES], pa.field("classes", pa.list_(pa.int64())), pa.field("words", pa.list_(pa.int64()))])


def measured_texts(texts: pa.Array) -> np.ndarray:
    """Features of each text as one row of numbers: the base counts, the class counts, the word bins."""
    width = len(FEATURE_NAMES) + len(CLASS_NAMES) + N_BINS
    out = np.zeros((len(texts), width), dtype=np.int64)
    for i, t in enumerate(utf8_values(texts)):
        f = features_of(t)
        out[i, :5], out[i, 5 : 5 + len(CLASS_NAMES)], out[i, 5 + len(CLASS_NAMES) :] = f[:5], f[5], f[6]
    return out


def features(text: Column) -> Column:
    @arrow_udf(FEATURES)
    def of(texts: pa.Array) -> pa.Array:
        numbers = measured_texts(texts)
        lists = []
        for part in (numbers[:, 5 : 5 + len(CLASS_NAMES)], numbers[:, 5 + len(CLASS_NAMES) :]):
            offsets = np.arange(len(texts) + 1, dtype=np.int32) * part.shape[1]
            lists.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(part.ravel())))
        return pa.StructArray.from_arrays([*[pa.array(numbers[:, c]) for c in range(5)], *lists], fields=list(FEATURE_TYPE))

    return of(text)


def base_failed(f: Column) -> Column:
    return (f["n_words"] < 20) | (100 * f["n_repeat_words"] > 30 * f["n_words"])


def tag_of(lang: str | None) -> str | None:
    """The primary subtag of a declared language, or None."""
    found = TAG.fullmatch((lang or "").strip(" ").lower())
    return found[1] if found else None


def references(measured: DataFrame, lang: str = "lang", f: str = "f") -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Summed histograms by language: one row for each declared primary subtag reaches the driver."""
    c = F.col(f)
    sums = [F.sum(c["classes"][i]).alias(f"c{i}") for i in range(len(CLASS_NAMES))]
    sums += [F.sum(c["words"][i]).alias(f"w{i}") for i in range(N_BINS)]
    tag = F.regexp_extract(F.lower(F.trim(lang)), f"^{TAG.pattern}$", 1)
    known = measured.filter(~base_failed(c)).groupBy(tag.alias("tag")).agg(*sums).filter("tag <> ''")
    return _split({row[0]: np.array(row[1:], dtype=float) for row in known.collect()})


def _split(sums: dict[str, np.ndarray]) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    return {k: (v[: len(CLASS_NAMES)], v[len(CLASS_NAMES) :]) for k, v in sums.items()}


def references_of_texts(docs: DataFrame, lang: str, text: str) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """The same straight from the texts: a task keeps one sum per declared language and emits nothing else."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for start, stop in slices(column(batch, "t")):
                numbers = measured_texts(column(batch, "t").slice(start, stop - start))
                good = (numbers[:, 0] >= 20) & (100 * numbers[:, 4] <= 30 * numbers[:, 0])
                tags = np.array([tag_of(x) or "" for x in column(batch, "l").slice(start, stop - start).to_pylist()])
                for k in set(tags[good].tolist()) - {""}:
                    total[k] = total.get(k, 0) + numbers[good & (tags == k), 5:].sum(0)
        held = list(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.string()), list_array([total[k] for k in held], pa.int64())], names=["l", "v"])

    rows = docs.select(F.col(lang).cast("string").alias("l"), F.col(text).alias("t")).mapInArrow(summed, "l string, v array<bigint>")
    each = [F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(len(CLASS_NAMES) + N_BINS)]
    return _split({r[0]: np.array(r[1:], dtype=float) for r in rows.groupBy("l").agg(*each).collect()})


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distances of the rows of ``p`` to the histogram ``q``; rows without counts get 1."""
    total = p.sum(1, keepdims=True)
    p, q = p / np.maximum(total, 1), (q / max(q.sum(), 1))[None, :]
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        half = [np.where(x > 0, x * np.log2(x / m), 0).sum(1) for x in (p, np.broadcast_to(q, p.shape))]
    return np.where(total[:, 0] > 0, np.sqrt(np.clip((half[0] + half[1]) / 2, 0, 1)), 1.0)


def share_distance(words: np.ndarray, ref: np.ndarray) -> np.ndarray:
    """How far the share of common words falls below the reference's: 0 as common or more, 1 without any common word."""
    two = lambda x: np.stack([x[:, :-1].sum(1), x[:, -1]], 1)
    q, p = two(ref[None, :])[0], two(words)
    none = js_distance(np.array([[0.0, 1.0]]), q)[0]
    rarer = p[:, 0] * q.sum() < q[0] * p.sum(1)
    return np.where(rarer, js_distance(p, q) / (none or 1), 0.0)


def divergence(classes: np.ndarray, words: np.ndarray, langs: list, refs: dict[str, tuple[np.ndarray, np.ndarray]]) -> tuple[list, np.ndarray]:
    """By row: the nearest language, and the three distances to it.

    Rows that declare a language without a word list have distances of words of 0.
    """
    out, d = [None] * len(langs), np.zeros((3, len(langs)))
    tags = [tag_of(x) for x in langs]
    full = sorted(k for k in refs if k in COMMON_WORDS)
    usual = np.array([t is None or t in COMMON_WORDS for t in tags], dtype=bool)
    own = np.flatnonzero(usual)
    if full and own.size:
        dc = np.stack([js_distance(classes[own], refs[k][0]) for k in full])
        dw = np.stack([js_distance(words[own], refs[k][1]) for k in full])
        ds = np.stack([share_distance(words[own], refs[k][1]) for k in full])
        at = (dc + dw).argmin(0)
        d[:, own] = np.stack([x[at, np.arange(len(at))] for x in (dc, dw, ds)])
        for i, k in zip(own.tolist(), at.tolist()):
            out[i] = full[k]
    for tag in {t for t, u in zip(tags, usual) if not u}:
        own = np.array([i for i, t in enumerate(tags) if t == tag])
        near = [*full, tag] if tag in refs else full
        if not near:
            continue
        dc = np.stack([js_distance(classes[own], refs[k][0]) for k in near])
        d[0, own] = dc.min(0)
        for i, k in zip(own.tolist(), dc.argmin(0).tolist()):
            out[i] = near[k]
    return out, d


def distances(f: Column, lang: Column, refs: dict[str, tuple[np.ndarray, np.ndarray]]) -> Column:
    """Distances to the nearest language: struct<language, class_distance, word_distance, share_distance>."""

    @arrow_udf("struct<language:string,class_distance:double,word_distance:double,share_distance:double>")
    def measured(classes: pa.Array, words: pa.Array, langs: pa.Array) -> pa.Array:
        names = ["class_distance", "word_distance", "share_distance"]
        kind = pa.struct([("language", pa.string()), *[(k, pa.float64()) for k in names]])
        c = np.array(classes.to_pylist(), dtype=float).reshape(len(langs), len(CLASS_NAMES))
        w = np.array(words.to_pylist(), dtype=float).reshape(len(langs), N_BINS)
        language, d = divergence(c, w, langs.to_pylist(), refs)
        return pa.StructArray.from_arrays([pa.array(language, pa.string()), *map(pa.array, d)], fields=list(kind))

    return measured(f["classes"], f["words"], lang.cast("string"))


def rejected(f: Column, d: Column, min_words: int = MIN_WORDS, max_class: float = MAX_CLASS_DISTANCE, max_word: float = MAX_WORD_DISTANCE, max_share: float = MAX_SHARE_DISTANCE) -> Column:
    """The base rule, or a divergence above its limit in a document that is long enough to measure."""
    divergent = (f["n_words"] >= min_words) & ((d["class_distance"] > max_class) | (d["word_distance"] > max_word) | (d["share_distance"] > max_share))
    return base_failed(f) | divergent


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", **limits) -> DataFrame:
    """(key, the base counts, base_failed, nearest language and distances, kept) for every row."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(key).alias("k"), F.col(lang).alias("lang"), features(F.col(text)).alias("f"))
    measured = stored(rows, "quality-features")  # counts only: the texts are read once
    d = distances(F.col("f"), F.col("lang"), references(measured))
    out = measured.withColumn("d", d)
    return out.select(
        F.col("k").alias(key),
        *[F.col(f"f.{n}").alias(n) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        base_failed(F.col("f")).alias("base_failed"),
        (~rejected(F.col("f"), F.col("d"), **limits)).alias("kept"),
        "d.language",
        "d.class_distance",
        "d.word_distance",
        "d.share_distance",
    )


def keep_good(
    docs: DataFrame, text: str = "text", lang: str = "lang", min_words: int = MIN_WORDS, max_class: float = MAX_CLASS_DISTANCE, max_word: float = MAX_WORD_DISTANCE, max_share: float = MAX_SHARE_DISTANCE
) -> DataFrame:
    """The rows of ``docs`` that are not rejected, all columns unchanged; no row is shuffled.

    Two scans: the first leaves a few sums by language, the second measures and filters
    slices of bounded bytes, whose rows pass through unread but for the text.
    """
    ship(docs.sparkSession)
    refs = references_of_texts(docs, lang, text)
    limits = np.array([max_class, max_word, max_share])[:, None]

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = column(batch, "row").field(text)
            for start, stop in slices(texts):
                numbers = measured_texts(texts.slice(start, stop - start))
                out = (numbers[:, 0] < 20) | (100 * numbers[:, 4] > 30 * numbers[:, 0])
                langs = column(batch, "row").field(lang).slice(start, stop - start).cast(pa.string()).to_pylist()
                _, d = divergence(numbers[:, 5 : 5 + len(CLASS_NAMES)].astype(float), numbers[:, 5 + len(CLASS_NAMES) :].astype(float), langs, refs)
                out |= (numbers[:, 0] >= min_words) & (d > limits).any(0)
                yield batch.slice(start, stop - start).filter(pa.array(~out))

    rows = docs.select(F.struct("*").alias("row"))
    return rows.mapInArrow(kept, rows.schema).select("row.*")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the divergence verdict for every row of ``documents``."""
    return judge(table(spark, sf_dir, "documents"))
