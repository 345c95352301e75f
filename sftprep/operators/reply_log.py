"""Durable replies, an append-only log keyed by ``request_id``, and bounded waves of calls.

A long generation run is cut into waves.  Every wave's usable replies are
appended to the log as soon as the wave's calls end, so a run that stops
loses at most the calls of the waves then in flight; the next run looks its
requests up first and calls the model only for the rest.

The chunks to do are written once, where they were computed, without a shuffle:
a task's rows are dealt to slices of ``rows_per_task`` rows, and ``tasks_per_wave``
neighbouring tasks share a wave.  So a wave has at most ``rows_per_task *
tasks_per_wave`` chunks whatever the corpus, and as many files as tasks.  Only a
wave with few files (the later slices of very long documents) is spread over
more tasks when it is read.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sftprep.session import scratch_path

LOG_SCHEMA = "request_id string, source string, chunk_id int, response string, kind string, run string, wave int"
WAVE = ["grp", "slice"]
_LOW_BITS = (1 << 33) - 1  # monotonically_increasing_id: partition << 33 | position


class ReplyLog:
    """Replies below ``path``: one folder per (kind, run, wave), never rewritten."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.run = uuid.uuid4().hex

    def read(self) -> DataFrame:
        """All logged replies (``LOG_SCHEMA``); none if the log is new."""
        try:
            return self.spark.read.schema(LOG_SCHEMA).parquet(self.path)
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], LOG_SCHEMA)

    def is_new(self) -> bool:
        return self.read().isEmpty()

    def append(self, replies: DataFrame, kind: str, wave: int) -> None:
        """Add the usable replies of one wave (``request_id, source, chunk_id, response``)."""
        usable = replies.filter(F.col("response").isNotNull())
        rows = usable.select("request_id", F.col("source").cast("string"), F.col("chunk_id").cast("int"), "response")
        rows.write.mode("overwrite").parquet(f"{self.path}/kind={kind}/run={self.run}/wave={wave}")

    def known(self, todo: DataFrame) -> DataFrame | None:
        """Logged replies of the chunks still to do, by wave: ``kind, request_id, response, grp, slice``.

        Only chunk keys and the replies of unfinished chunks are shuffled.  A
        request answered more than once (another run, a retried wave) keeps its
        smallest reply.
        """
        if self.is_new():
            return None
        keys = todo.select("source", "chunk_id", *WAVE)
        mine = self.read().join(keys, ["source", "chunk_id"])
        once = mine.groupBy("kind", "request_id", *WAVE).agg(F.min("response").alias("response"))
        return by_wave(once, "known-replies")


def by_wave(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` saved with one folder per wave, so a wave reads its own rows only."""
    path = scratch_path(rows.sparkSession, name)
    rows.repartition(*WAVE).write.partitionBy(*WAVE).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def of_wave(rows: DataFrame, wave: tuple[int, int]) -> DataFrame:
    return rows.filter((F.col("grp") == wave[0]) & (F.col("slice") == wave[1])).drop(*WAVE)


class Waves:
    """The chunks to do, saved and dealt to waves; no row is shuffled."""

    def __init__(self, todo: DataFrame, wave_chunks: int, tasks_per_wave: int):
        if wave_chunks < 1 or tasks_per_wave < 1:
            raise ValueError("wave_chunks and tasks_per_wave must be positive")
        spark = todo.sparkSession
        per_task = max(1, wave_chunks // tasks_per_wave)
        place = F.monotonically_increasing_id()
        dealt = todo.withColumn("_place", place).select(
            *todo.columns,
            F.floor(F.shiftright("_place", 33) / F.lit(tasks_per_wave)).cast("int").alias("grp"),
            F.floor(F.col("_place").bitwiseAND(F.lit(_LOW_BITS)) / F.lit(per_task)).cast("int").alias("slice"),
        )
        path = scratch_path(spark, "todo-chunks")
        dealt.write.partitionBy(*WAVE).parquet(path)
        self.tasks_per_wave = tasks_per_wave
        self.rows = spark.read.schema(dealt.schema).parquet(path)
        files = self.rows.select(*WAVE, F.input_file_name().alias("f")).groupBy(*WAVE, "f").agg(F.count(F.lit(1)).alias("n"))
        sizes = files.groupBy(*WAVE).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("files"))
        # one row per wave: bounded by the chunks divided by the wave size
        self.sizes = {(r["grp"], r["slice"]): (r["n"], r["files"]) for r in sizes.collect()}

    def __iter__(self):
        return iter(sorted(self.sizes))

    def in_flight(self) -> int:
        """Waves to run at once: as many as have twice the cluster's slots in tasks."""
        try:
            slots = self.rows.sparkSession.sparkContext.defaultParallelism
        except Exception:  # noqa: BLE001 - no SparkContext view (Connect)
            return 1
        return max(1, -(-2 * slots // self.tasks_per_wave))

    def chunks(self, wave: tuple[int, int]) -> DataFrame:
        """The chunks of one wave, in about ``tasks_per_wave`` tasks."""
        rows = of_wave(self.rows, wave)
        n, files = self.sizes[wave]
        if files < min(n, self.tasks_per_wave):
            return rows.repartition(self.tasks_per_wave, "source", "chunk_id")
        return rows


def with_known(requests: DataFrame, known: DataFrame | None, kind: str) -> DataFrame:
    """``requests`` with ``known_reply`` (NULL: to be asked)."""
    if known is None:
        return requests.withColumn("known_reply", F.lit(None).cast("string"))
    mine = known.filter(F.col("kind") == kind).select("request_id", F.col("response").alias("known_reply"))
    return requests.join(mine, "request_id", "left")
