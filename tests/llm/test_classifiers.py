import numpy as np

from pyspark.sql import functions as F

from llm_helpers import edge_documents, labels, no_documents
from sftprep.llm import quality_model as QM
from sftprep.llm import toxicity as TX

SF01 = "/root/testdata/sf0.01"


def held(spark, out, column, label):
    known = spark.read.parquet(f"{SF01}/labels.parquet").select("doc_id", label)
    rows = out.join(known, "doc_id").filter("held_out").collect()
    return np.array([r[label] for r in rows]), np.array([float(r[column]) for r in rows])


def test_toxicity_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    out = TX.op3_toxicity(spark, SF01)
    rows = out.collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    y, s = held(spark, out, "score", "toxic")
    assert ((s >= 0.5) == y).mean() >= 0.95 and s[y == 1].mean() > s[y == 0].mean() + 0.4


def test_toxicity_reads_only_id_text_and_training_labels(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    known = spark.read.parquet(f"{SF01}/labels.parquet")
    other = known.withColumn("toxic", TX.F.when(TX.held_out(TX.F.col("doc_id")), 1 - TX.F.col("toxic")).otherwise(TX.F.col("toxic")))
    a, b = (sorted(map(tuple, TX.score_documents(docs.select("doc_id", "text"), k).select("doc_id", "score").collect())) for k in (known, other))
    assert a == b


def test_risk_estimator_finds_the_positive_word():
    rng = np.random.default_rng(0)
    x = (rng.random((600, 20)) < 0.2).astype(np.float32)
    toxic = rng.random(600) < 0.2
    x[:, 0] = toxic
    positive = toxic & (rng.random(600) < 0.5)  # half of them confirmed, the rest unlabelled
    w = TX.trained(x, positive, 0.2)
    score = 1 / (1 + np.exp(-(x @ w[:-1] + w[-1])))
    assert ((score >= 0.5) == toxic).mean() > 0.97


def test_bounded_toxicity_sample_predicts_like_the_whole(spark):
    """Positives beyond the unlabelled draw leave the mixture's share of toxic rows as it is."""
    rng = np.random.default_rng(3)
    toxic = rng.random(4000) < 0.12
    words = [[f"w{k}" for k in rng.integers(0, 60, 12)] + [f"bad{k}" for k in rng.integers(0, 12, 5 if t else 0)] for t in toxic]
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(words)], "doc_id long, text string")
    known = labels(spark, [(k, 1, int(t)) for k, t in enumerate(toxic)])
    picked = TX.sample(known.selectExpr("doc_id AS id", "toxic AS label"), 100, 300)
    assert picked.filter("mixed").count() == 300 and picked.filter("label = 1").count() == 100
    for sizes in ({}, {"positives": 100, "unlabelled": 300}):
        rows = TX.score_documents(docs, known, **sizes).collect()
        right = np.array([r.predicted == toxic[r.doc_id] for r in rows])
        assert right[toxic[[r.doc_id for r in rows]]].mean() > 0.95 and right.mean() > 0.97, sizes


def test_toxicity_edges(spark):
    df = edge_documents(spark)
    assert TX.score_documents(no_documents(spark), labels(spark)).count() == 0
    for known in (labels(spark), labels(spark, [(0, None, None), (None, 1, 1)]), labels(spark, [(k, 1, 0) for k in range(8)]), labels(spark, [(k, 1, k % 2) for k in range(8)] * 2)):
        rows = TX.score_documents(df, known).collect()
        assert len(rows) == 9 and all(r.score is not None and r.held_out is not None for r in rows)


def test_quality_on_held_out_rows(spark):
    out = QM.op5_quality(spark, SF01)
    assert out.count() == 1000
    y, s = held(spark, out, "score", "quality")
    assert ((s >= 0.5) == y).mean() >= 0.95
    rows = out.collect()
    assert all(0 <= r.score <= 1 and r.kept == (r.score >= 0.5) for r in rows)


def test_quality_edges(spark):
    df = edge_documents(spark)
    assert QM.classify(no_documents(spark), labels(spark)).count() == 0
    assert all(r.kept for r in QM.classify(df, labels(spark)).collect())
    for known in (labels(spark, [(0, None, None), (None, 1, 1)]), labels(spark, [(k, 1, 0) for k in range(8)]), labels(spark, [(k, k % 2, 0) for k in range(8)] * 2)):
        rows = QM.classify(df, known).collect()
        assert len(rows) == 9 and all(r.score is not None for r in rows)


def test_toxicity_with_string_ids(spark):
    docs = spark.read.parquet(f"/root/testdata/sf0.001/documents.parquet").select(F.concat(F.lit("d"), "doc_id").alias("doc_id"), "text")
    marks = spark.read.parquet(f"/root/testdata/sf0.001/labels.parquet").select(F.concat(F.lit("d"), "doc_id").alias("doc_id"), "toxic")
    out = TX.score_documents(docs, marks)
    assert out.filter("score between 0 and 1").count() == docs.count() and out.schema["doc_id"].dataType.simpleString() == "string"
