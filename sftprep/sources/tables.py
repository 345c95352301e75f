"""Table-backed corpora: the driver's parquet tables and any catalog table."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """``<base>/<name>.parquet`` (a file or a directory of parts)."""
    return spark.read.parquet(os.path.join(base, f"{name}.parquet"))
