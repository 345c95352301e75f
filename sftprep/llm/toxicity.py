"""Operator 3: toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; all training rows with their labels
hidden are the unlabelled mixture.  With class prior p (the share of toxic rows
among all training labels), the risk of a linear logistic model is

    p * E_P[l(+)] + max(0, E_U[l(-)] - p * E_P[l(-)])

where a negative second part is climbed back instead of followed, so the model
cannot overfit the positives.  Features are the presence of words and of word beginnings; Spark counts
in how many positives and unlabelled rows each word occurs and the words most
typical of positives become the model's vocabulary.  Up to MODELS models are trained
in numpy, one task each, on separate parts of the sample, and their scores
averaged; every whole text is scored.

The sample is bounded: at most ``positives`` toxic and ``unlabelled`` training
rows, the first by a hash of their id.  Only the second draw is the mixture: toxic
rows beyond it are positives alone, so that the mixture keeps its share of toxic
rows whatever the input's size.  Prior and scores cover all rows.

Defined results: a null or empty text has no words and scores the models' bias;
without any positive training row every score is the prior, without training
rows 0; null labels are no labels, null ids are never trained on; repeated rows
each give a row; an empty table gives no rows; only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from sftprep.llm.common import WordHashes, column, list_array, ship, stored, table, utf8_values

MODELS = 4
POSITIVES, UNLABELLED = 8_000, 24_000
VOCABULARY = 1_000
#: a word of the vocabulary is in at least this share of the sampled positives (and this many), and so many deviations more often than in the mixture
MIN_SHARE, MIN_POSITIVES, MIN_DEVIATIONS = 0.01, 4, 5.0
#: positives that each model has at least, so a small sample trains fewer models
PER_MODEL = 500
ROUNDS, RATE, DECAY = 600, 0.05, 1e-4
PUNCTUATION = b".,;:!?\"'()[]{}<>|#*$%&=+-_/\\@~`^"
SPACED = bytes.maketrans(PUNCTUATION, b" " * len(PUNCTUATION))
#: bytes of a word's beginning that count as a feature: one stem has many endings
BEGINNINGS = (5, 6, 7, 8)
SEED = 17


def held_out(key: Column) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % 5 == 0


def words_of(text: bytes) -> set[bytes]:
    """Distinct words of a text, ASCII lower case and without punctuation, and the beginnings of the longer ones."""
    words = set(text.lower().translate(SPACED).split())
    return words.union(*({b"^" + w[:n] for w in words if len(w) > n} for n in BEGINNINGS))


def word_ids(text: bytes, hashes: WordHashes) -> np.ndarray:
    return np.unique(hashes.of(list(words_of(text))).view(np.int64))


def presence(rows: DataFrame) -> DataFrame:
    """(id, label, mixed, words) of rows (id, label, mixed, text)."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for i in range(0, len(batch), 200):
                lists = [word_ids(t, hashes) for t in utf8_values(column(batch, "text").slice(i, 200))]
                yield pa.RecordBatch.from_arrays([column(batch, c).slice(i, 200) for c in ("id", "label", "mixed")] + [list_array(lists, pa.int64())], names=["id", "label", "mixed", "words"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "label", "mixed", "text").mapInArrow(words, f"id {kind}, label int, mixed boolean, words array<long>")


def sample(labels: DataFrame, positives: int, unlabelled: int) -> DataFrame:
    """(id, label, mixed): the bounded training sample, the first rows of each kind by a hash of their id; ``mixed`` rows are the unlabelled draw."""
    order = [F.xxhash64("id", F.lit(SEED)), "id"]
    rows = labels.select("id", "label").groupBy("id").agg(F.max("label").alias("label"))
    draws = (rows.filter("label = 1").orderBy(*order).limit(positives), False), (rows.orderBy(*order).limit(unlabelled), True)
    both = [draw.withColumn("mixed", F.lit(mixed)) for draw, mixed in draws]
    return both[0].union(both[1]).groupBy("id", "label").agg(F.max("mixed").alias("mixed"))


def trained(x: np.ndarray, positive: np.ndarray, prior: float, mixed: np.ndarray | None = None) -> np.ndarray:
    """Weights of the non-negative risk's minimum, the bias last; the ``mixed`` rows (all if None) are the unlabelled mixture."""
    width = x.shape[1]
    x = np.concatenate([x, np.ones((len(x), 1))], 1)  # doubles as the weights, or each product converts it anew
    w = np.zeros(width + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    p, u = x[positive], x if mixed is None else x[mixed]
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for t in range(1, ROUNDS + 1):
        sp, su = sigmoid(p @ w), sigmoid(u @ w)
        loss_u = -np.log(np.maximum(1 - su, 1e-12)).mean()
        loss_p = -np.log(np.maximum(1 - sp, 1e-12)).mean()
        grad_negative = u.T @ su / len(u) - prior * (p.T @ sp) / len(p)
        if loss_u - prior * loss_p >= 0:
            grad = prior * (p.T @ (sp - 1)) / len(p) + grad_negative
        else:  # the estimate went below zero: climb back
            grad = -grad_negative
        grad += DECAY * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def fit(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> tuple[dict[int, int], np.ndarray]:
    """Vocabulary (word hash to place) and one weight row per model, from (id, text) and (id, label)."""
    prior = labels.agg(F.avg(F.col("label").cast("double"))).first()[0]
    if not prior:
        return {}, np.array([[-30.0]])
    prior = min(max(prior, 1e-4), 0.9)
    picked = stored(sample(labels, positives, unlabelled), "toxic-sample")
    rows = stored(presence(docs.join(F.broadcast(picked), "id").dropDuplicates(["id"])), "toxic-words")  # bounded by the sample
    counts = F.count_if(F.col("label") == 1).alias("p"), F.count_if("mixed").alias("u")
    n = rows.agg(*counts).first()
    if not n.p or not n.u:
        return {}, np.array([[float(np.log(prior / (1 - prior)))]])
    each = rows.select("label", "mixed", F.explode("words").alias("w")).groupBy("w").agg(*counts)
    share = F.greatest(F.col("u") / n.u, prior * F.col("p") / n.p)  # the mixture holds the positives, also of a word that its draw missed
    gain = F.col("p") / n.p - share
    spread = F.sqrt(share * (1 - share) / n.p + F.lit(1e-9))
    often = (F.col("p") >= max(MIN_POSITIVES, MIN_SHARE * n.p)) & (gain / spread >= MIN_DEVIATIONS)
    typical = each.filter(often).orderBy((gain / spread).desc(), "w").limit(VOCABULARY)
    at = {r.w: k for k, r in enumerate(typical.select("w").collect())}  # at most VOCABULARY rows
    width = len(at)

    def model(part: pd.DataFrame) -> pd.DataFrame:
        x = np.zeros((len(part), width), dtype=np.float32)
        for r, words in enumerate(part["words"]):
            x[r, [at[w] for w in words if w in at]] = 1
        positive, mixed = part["label"].to_numpy() == 1, part["mixed"].to_numpy(dtype=bool)
        if not positive.any() or not mixed.any():
            return pd.DataFrame({"weights": []})
        return pd.DataFrame({"weights": [trained(x, positive, prior, mixed).tolist()]})

    models = max(1, min(MODELS, n.p // PER_MODEL))
    parts = rows.withColumn("part", F.pmod(F.xxhash64("id", F.lit(SEED + 1)), F.lit(models)))
    weights = parts.groupBy("part").applyInPandas(model, "weights array<double>").collect()
    if not weights:
        return {}, np.array([[float(np.log(prior / (1 - prior)))]])
    return at, np.array([r.weights for r in weights])


def score(text: Column, at: dict[int, int], weights: np.ndarray) -> Column:
    """The mean probability of the models."""

    at = {h % (1 << 64): k for h, k in at.items()}

    @arrow_udf("double")
    def probability(texts: pa.Array) -> pa.Array:
        hashes, out = WordHashes(), []
        linear, bias = weights[:, :-1], weights[:, -1]
        for t in utf8_values(texts):
            held = [k for w in words_of(t) if (k := at.get(hashes[w])) is not None]
            z = linear[:, held].sum(1) + bias
            out.append(float((1 / (1 + np.exp(-np.clip(z, -30, 30)))).mean()))
        return pa.array(out, pa.float64())

    return probability(text)


def score_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", **sizes) -> DataFrame:
    """(key, held_out, score, predicted) for every row; rows that ``held_out`` names are never trained on."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    known = labels.select(F.col(key).alias("id"), F.col(label).cast("int").alias("label")).filter("id is not null and label is not null")
    at, weights = fit(rows.filter("id is not null"), known.filter(~held_out(F.col("id"))), **sizes)
    scored = rows.select(F.col("id").alias(key), F.coalesce(held_out(F.col("id")), F.lit(False)).alias("held_out"), score(F.col("text"), at, weights).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every row of ``documents``."""
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
