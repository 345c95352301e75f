"""S8 in buckets: few files for many sources, compaction, recovery, both layouts read together."""

import os

import pytest
from pyspark.sql import functions as F

from sftprep.sources import sinks as K
from sftprep.sources.files import QA_PAIR_SCHEMA, SEGMENTS, read_pairs_or_empty


def rows(spark, n, sources):
    return spark.range(n).select(
        F.concat(F.lit("q"), "id").alias("question"), F.lit("a").alias("answer"), F.concat(F.lit("s/%="), F.col("id") % sources).alias("source"),
        F.col("id").cast("int").alias("chunk_id"), F.lit("c").alias("chunk"),
    )


def data_files(path):
    return [f for _, _, names in os.walk(path) for f in names if f.startswith("part-")]


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_files_do_not_follow_the_sources(spark, tmp_path, fmt):
    path = str(tmp_path / "pairs")
    for _ in range(2):
        K.append_pairs(rows(spark, 4000, 2000), path, fmt, buckets=5)
    assert len(data_files(path)) <= 10
    assert read_pairs_or_empty(spark, path, fmt).count() == 8000
    K.compact_pairs(spark, path, fmt, buckets=3)
    assert len(data_files(path)) <= 3 and os.listdir(path) == [SEGMENTS]
    back = read_pairs_or_empty(spark, path, fmt)
    assert back.schema == QA_PAIR_SCHEMA and back.count() == 8000 and back.select("source").distinct().count() == 2000


def test_one_hot_source_fills_all_buckets(spark, tmp_path):
    path = str(tmp_path / "pairs")
    K.append_pairs(rows(spark, 4000, 1), path, "parquet", buckets=4)
    sizes = [r["count"] for r in spark.read.parquet(f"{path}/{SEGMENTS}").groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 1400


def test_both_layouts(spark, tmp_path):
    path = str(tmp_path / "pairs")
    df = rows(spark, 30, 3)
    K.append_pairs(df.filter("chunk_id < 10"), path)
    K.append_pairs(df.filter("chunk_id >= 10"), path, buckets=2)
    assert sorted(map(tuple, read_pairs_or_empty(spark, path).collect())) == sorted(map(tuple, df.collect()))
    K.compact_pairs(spark, path)
    assert read_pairs_or_empty(spark, path).count() == 30


def test_a_compaction_stopped_between_its_renames(spark, tmp_path, monkeypatch):
    path, real, calls = str(tmp_path / "pairs"), K._rename, []

    def once(fs, old, new):
        if calls:
            raise KeyboardInterrupt
        calls.append(1)
        real(fs, old, new)

    K.append_pairs(rows(spark, 50, 5), path, buckets=2)
    monkeypatch.setattr(K, "_rename", once)
    with pytest.raises(KeyboardInterrupt):
        K.compact_pairs(spark, path)
    monkeypatch.setattr(K, "_rename", real)
    K.recover_pairs(spark, path)
    assert read_pairs_or_empty(spark, path).count() == 50
    K.recover_pairs(spark, str(tmp_path / "absent"))
    K.compact_pairs(spark, str(tmp_path / "absent"))
