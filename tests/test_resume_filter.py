"""J1 beyond the broadcast budget: a Bloom filter keeps chunk rows where they were scanned."""

import pytest
from pyspark.sql import functions as F

from sftprep.operators import resume as R


def chunks(spark, n=4000):
    rows = spark.range(n, numPartitions=6)
    source = F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("s"), F.col("id") % 50))
    return rows.select(source.alias("source"), F.col("id").cast("int").alias("chunk_id"), F.concat(F.lit("text of "), "id").alias("chunk"))


def pairs(spark, df):
    some = df.filter("chunk_id % 3 = 0")
    return some.union(some).union(df.filter("chunk_id % 5 = 0"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exact(df, done):
    return sorted((r.chunk_id, r.chunk) for r in df.join(R.done_chunks(done, 2), ["source", "chunk_id"], "left_anti").collect())


@pytest.mark.parametrize("budget, size", [(2_000, None), (1, None), (2_000, 64)])
def test_equal_to_the_plain_join(spark, monkeypatch, budget, size):
    if size:  # a filter far too small says "maybe" to nearly all
        monkeypatch.setattr(R, "FILTER_BYTES", size)
        monkeypatch.setattr(R.bloom_filter, "__defaults__", (size,))
    df = chunks(spark)
    done = pairs(spark, df)
    got = R.skip_done_chunks(df, done, 2, broadcast_bytes=budget)
    assert got.columns == df.columns
    assert sorted((r.chunk_id, r.chunk) for r in got.collect()) == exact(df, done)


def test_chunk_rows_are_not_shuffled(spark):
    df = chunks(spark)
    out = R.skip_done_chunks(df, pairs(spark, df), 2, broadcast_bytes=8_000)
    text = plan(out)
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text


def test_the_filter_misses_nothing(spark):
    df = chunks(spark).filter("source is not null")
    half = df.filter("chunk_id % 2 = 0")
    maybe = R.bloom_filter(half, half.count(), ["source", "chunk_id"])
    tagged = df.withColumn("m", maybe(F.col("source"), F.col("chunk_id")))
    assert tagged.filter("chunk_id % 2 = 0 and not m").count() == 0
    assert tagged.filter("chunk_id % 2 = 1 and m").count() < 0.05 * df.count()
    empty = R.bloom_filter(half.limit(0), 0, ["source", "chunk_id"])
    assert df.filter(empty(F.col("source"), F.col("chunk_id"))).count() == 0
