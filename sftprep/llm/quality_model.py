"""Operator 5: quality classification by co-training of two views.

The text view sees only numbers measured on the whole text, the metadata view
only source, language and recorded length.  Both start from the labelled
training rows.  In each round either classifier scores all unlabelled rows, and
its most confident ones, some of each class, become training rows of the other
view.  At the end each view is calibrated on labelled rows that its classifier
was not fitted on, and a logistic model of the two calibrated scores combines
them.  All rows are scored.

The labelled sample is bounded by ``labelled`` rows (first by a hash of the id),
and a round exchanges at most ``exchanged`` rows of each class and view; the rows
to choose from are all rows, measured once and kept as numbers.

Defined results: a null or empty text is measured as empty; null metadata is a
value of its own; null labels are no labels and null ids are never trained on;
without two classes among the training labels every score is the share of good
labels, 1 without labels; repeated rows each give a row; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sftprep.llm.common import column, list_array, ship, stored, table, utf8_values

LABELLED, EXCHANGED, ROUNDS = 20_000, 500, 3
CONFIDENT = 0.9
SOURCES = 64
TEXT_WIDTH, META_WIDTH = 14, SOURCES + 12
SEED = 29


def held_out(key):
    return F.crc32(key.cast("string").cast("binary")) % 5 == 0


def text_view(text: bytes) -> list[float]:
    """Shares and logarithms, all of about unit size."""
    words = text.split()
    n, size = len(words), max(1, len(text))
    lines = [s for s in text.split(b"\n") if s and not s.isspace()]
    share = lambda chars: 1 - len(text.translate(None, chars)) / size if text else 0.0
    upper = share(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    repeated = sum(a == b for a, b in zip(words, words[1:])) / max(1, n - 1)
    grams = len({*zip(words, words[1:], words[2:])}) / max(1, n - 2) if n > 2 else 1.0
    return [
        min(n, 20) / 20, min(n, 100) / 100, np.log1p(n) / 10, len(text) / max(1, n) / 20,
        10 * share(b"#*$%&<>"), 10 * share(b"|"), upper, 10 * share(b"!"), 5 * share(b"0123456789"),
        repeated, grams, len(set(words)) / max(1, n), 1 - len(set(lines)) / max(1, len(lines)), share(b".,;"),
    ]


def meta_view(source: str | None, lang: str | None, length: int | None) -> list[float]:
    out = [0.0] * META_WIDTH
    out[zlib.crc32((source or "").encode()) % SOURCES] = 1.0
    out[SOURCES + zlib.crc32((lang or "").encode()) % 8] = 1.0
    size = np.log1p(max(0, length or 0))
    out[SOURCES + 8 :] = [float(length is None), size / 10, float(size < np.log1p(100)), float(size > np.log1p(10_000))]
    return out


def measured(docs: DataFrame, key: str, text: str, source: str, lang: str, length: str) -> DataFrame:
    """(id, a, b): the two views of every row."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a = [np.array(text_view(t)) for t in utf8_values(column(batch, "t"))]
            b = [np.array(meta_view(*m)) for m in zip(*(column(batch, c).to_pylist() for c in ("source", "lang", "length")))]
            yield pa.RecordBatch.from_arrays([column(batch, "id"), list_array(a, pa.float64()).cast(pa.list_(pa.float32())), list_array(b, pa.float64()).cast(pa.list_(pa.float32()))], names=["id", "a", "b"])

    picked = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("t"), F.col(source).cast("string").alias("source"), F.col(lang).cast("string").alias("lang"), F.col(length).cast("long").alias("length"))
    return picked.mapInArrow(rows, "id long, a array<float>, b array<float>")


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, decay: float = 1e-3) -> np.ndarray:
    """Weights of a logistic model, the bias last, by Newton steps."""
    x = np.concatenate([x, np.ones((len(x), 1))], 1)
    weight = np.ones(len(x)) if weight is None else weight
    w = np.zeros(x.shape[1])
    ridge = decay * weight.sum() * np.eye(x.shape[1])
    ridge[-1, -1] = 1e-9
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + ridge @ w
        step = np.linalg.solve((x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def applied(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))


def _flat(lists: pa.Array, width: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(float)


def scored(rows: DataFrame, wa: np.ndarray, wb: np.ndarray, calibration: tuple | None = None) -> DataFrame:
    """(id, a, b, pa, pb[, score]) of all rows."""

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = _flat(column(batch, "a"), TEXT_WIDTH), _flat(column(batch, "b"), META_WIDTH)
            p, q = applied(a, wa), applied(b, wb)
            extra = [combined(p, q, calibration)] if calibration else []
            yield pa.RecordBatch.from_arrays([column(batch, c) for c in ("id", "a", "b")] + [pa.array(v) for v in (p, q, *extra)], names=["id", "a", "b", "pa", "pb", *["score"] * len(extra)])

    return rows.mapInArrow(scores, "id long, a array<float>, b array<float>, pa double, pb double" + ", score double" * bool(calibration))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def combined(p: np.ndarray, q: np.ndarray, calibration: tuple) -> np.ndarray:
    ca, cb, both = calibration
    views = [logit(applied(logit(v)[:, None], c)) for v, c in ((p, ca), (q, cb))]
    return applied(np.stack(views, 1), both)


def co_train(rows: DataFrame, labels: DataFrame, labelled: int = LABELLED, exchanged: int = EXCHANGED, rounds: int = ROUNDS) -> tuple | None:
    """(text weights, metadata weights, calibration) from measured rows and (id, label); None without two classes."""
    picked = labels.groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("id", F.lit(SEED)), "id").limit(labelled)
    known = stored(rows.dropDuplicates(["id"]).join(F.broadcast(picked), "id"), "quality-labelled").toPandas()  # bounded by the sample
    if known["label"].nunique() < 2:
        return None
    known = known.sort_values("id")
    y = known["label"].to_numpy(dtype=float)
    views = [np.stack(known[c].to_numpy()).astype(float) for c in ("a", "b")]
    aside = np.arange(len(y)) % 4 == 3  # calibrates, is not fitted on
    if len(set(y[aside])) < 2 or len(set(y[~aside])) < 2:
        aside = np.zeros(len(y), dtype=bool)
    extra: list[list[tuple[np.ndarray, float]]] = [[], []]
    unlabelled = rows.join(F.broadcast(picked.select("id")), "id", "left_anti").filter("id is not null")
    for r in range(rounds + 1):
        w = []
        for v in (0, 1):
            x = np.concatenate([views[v][~aside], *[e[0][None, :] for e in extra[v]]])
            t = np.concatenate([y[~aside], [e[1] for e in extra[v]]])
            w.append(logistic(x, t))
        if r == rounds:
            break
        pool = stored(scored(unlabelled, *w), "quality-pool")
        extra = [[], []]  # chosen anew by the better classifiers
        for mine, other, view in (("pa", "b", 1), ("pb", "a", 0)):
            for good in (1.0, 0.0):
                sure = pool.filter(F.col(mine) >= CONFIDENT if good else F.col(mine) <= 1 - CONFIDENT)
                best = sure.orderBy(F.col(mine).desc() if good else F.col(mine).asc(), F.xxhash64("id", F.lit(SEED))).select(other).limit(exchanged)
                extra[view] += [(np.array(row[0], dtype=float), good) for row in best.collect()]  # at most ``exchanged`` rows
    use = aside if aside.any() else ~aside
    p, q = applied(views[0][use], w[0]), applied(views[1][use], w[1])
    ca, cb = logistic(logit(p)[:, None], y[use]), logistic(logit(q)[:, None], y[use])
    both = np.stack([logit(applied(logit(v)[:, None], c)) for v, c in ((p, ca), (q, cb))], 1)
    return w[0], w[1], (ca, cb, logistic(both, y[use]))


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang", length: str = "n_chars", label: str = "quality", **sizes) -> DataFrame:
    """(key, held_out, text_score, metadata_score, score, kept) for every row."""
    ship(docs.sparkSession)
    rows = stored(measured(docs, key, text, source, lang, length), "quality-views")
    known = labels.select(F.col(key).cast("long").alias("id"), F.col(label).cast("int").alias("label")).filter("id is not null and label is not null")
    known = known.filter(~held_out(F.col("id")))
    model = co_train(rows, known, **sizes)
    apart = F.coalesce(held_out(F.col("id")), F.lit(False)).alias("held_out")
    if model is None:
        share = known.agg(F.avg("label")).first()[0]
        value = F.lit(1.0 if share is None else float(share))
        out = rows.select(F.col("id").alias(key), apart, value.alias("text_score"), value.alias("metadata_score"), value.alias("score"))
    else:
        out = scored(rows, *model).select(F.col("id").alias(key), apart, F.col("pa").alias("text_score"), F.col("pb").alias("metadata_score"), "score")
    return out.withColumn("kept", F.col("score") >= 0.5)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every row of ``documents``."""
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
