"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it
as Parquet below ``spark.checkpoint.dir`` and rereads it as the next one's docs.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sftprep.llm import bpe, decontaminate, line_dedup, near_dups, quality_rules
from sftprep.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(docs, length="n_chars")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dups.drop_near_duplicates(docs, shingle=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.encode_documents(docs, public_tokenizers.path(bpe.VOCABULARY))


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("bpe", tokens),
]

#: the verdicts of several stages are no SQL; tests compare them with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
