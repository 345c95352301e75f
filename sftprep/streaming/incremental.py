"""Incremental ingest - new documents are chunked (and prompted) exactly once.

A Structured Streaming file source over the document folder (for document files
our own, ``folder_source``, which also sees hidden names) feeds ``foreachBatch``.  Each micro-batch is chunked, turned into question prompts
and written to its own ``run_id=<query>/batch_id=<epoch>`` folder with
overwrite, so a batch replayed after a failure replaces its own output, nothing
is written twice, and a query under another checkpoint never touches it; no
batch ever re-reads the sink.  The file source's checkpoint (in the
cluster's shared ``spark.checkpoint.dir``) records which files are done.
The work is stateless, so no watermark is needed.  ``skip_existing`` adds
a key-level anti-join against the sink for inputs that may repeat documents
under new file names (costs a read of the sink keys per batch).
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sftprep.functions.prompts import question_prompt
from sftprep.operators.chunking import chunk_documents
from sftprep.operators.resume import skip_done_chunks
from sftprep.session import ensure_library_on_workers, scratch_path
from sftprep.sources.files import TEXT_EXTENSIONS, read_pairs_or_empty, source_id
from sftprep.sources.listing import located_path
from sftprep.streaming.folder_source import folder_source


def _source(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    path, is_dir = located_path(spark, path)
    if not is_dir:  # one file: watch its folder, only that name
        folder, _, name = path.rpartition("/")
        reader = reader.option("pathGlobFilter", name)
        path = folder
    return reader.parquet(path)


def _documents(spark: SparkSession, path: str, checkpoint_path: str, max_files: int | None) -> DataFrame:
    """S1/S2 as a stream: ``source, text`` of the text documents that arrive in a folder, whatever their names."""
    root, is_dir = located_path(spark, path)
    spark.dataSource.register(folder_source())
    files = spark.readStream.format("sftprep_folder").option("path", root).option("log", _files_log(checkpoint_path))
    if is_dir:
        files = files.option("suffixes", ",".join(TEXT_EXTENSIONS))
    if max_files:
        files = files.option("maxfiles", max_files)
    return files.load().select(source_id(F.col("path")).alias("source"), F.make_valid_utf8(F.col("content").cast("string")).alias("text"))


def _files_log(checkpoint_path: str) -> str:
    return checkpoint_path.rstrip("/") + ".files"


def _existing(spark: SparkSession, sink: str) -> DataFrame | None:
    try:
        return spark.read.parquet(sink)
    except AnalysisException:
        return None


def _checkpoint_id(spark: SparkSession, checkpoint_path: str) -> str:
    """The query id kept in the checkpoint: the same after a restart, another for another checkpoint."""
    return spark.read.schema("id string").json(f"{checkpoint_path.rstrip('/')}/metadata").first()["id"]


def run_incremental(
    spark: SparkSession,
    source_path: str,
    schema: T.StructType | None,
    sink_path: str,
    checkpoint_path: str,
    key_col: str = "doc_id",
    text_col: str = "text",
    chunk_size: int = 1024,
    overlap: int = 200,
    generate_num: int | None = None,
    num_partitions: int | None = None,
    max_files_per_trigger: int | None = None,
    skip_existing: bool = False,
    markdown: bool = False,
    resume_from: str | None = None,
    resume_format: str = "json",
    resume_generate_num: int = 2,
) -> None:
    """Process every file present now (``availableNow``) and stop.

    Writes ``key, chunk_id, chunk_start, chunk_end, chunk`` (plus ``prompt``
    when ``generate_num`` is given) to ``sink_path`` as Parquet.  With
    ``resume_from`` (a QA-pair sink, ``source`` = the key as text) chunks that
    already have ``resume_generate_num`` pairs are skipped inside each batch (J1).
    Without a ``schema`` the folder holds document files, keyed by ``source``.
    """
    if schema is None:
        key_col, text_col = "source", "text"
    ensure_library_on_workers(spark)  # foreachBatch runs on another thread
    if schema is None:
        stream = _documents(spark, source_path, checkpoint_path, max_files_per_trigger)
    else:
        stream = _source(spark, source_path, schema, max_files_per_trigger).select(key_col, text_col)

    def batch(df: DataFrame, epoch_id: int) -> None:
        if num_partitions:
            df = df.repartition(num_partitions)
        ch = chunk_documents(df, text_col=text_col, keep=[key_col], chunk_size=chunk_size,
                             overlap=overlap, markdown=markdown, spread=False)
        if resume_from:
            pairs = read_pairs_or_empty(df.sparkSession, resume_from, resume_format)
            keyed = ch.withColumn("source", F.col(key_col).cast("string"))
            ch = skip_done_chunks(keyed, pairs, resume_generate_num)
            ch = ch if key_col == "source" else ch.drop("source")
        if generate_num is not None:
            ch = ch.withColumn("prompt", question_prompt(F.col("chunk"), generate_num))
        run_id = _checkpoint_id(df.sparkSession, checkpoint_path)
        if skip_existing:
            done = _existing(df.sparkSession, sink_path)
            if done is not None:
                own = (F.col("run_id") == run_id) & (F.col("batch_id") == epoch_id)
                prior = done.filter(~own).select(key_col, "chunk_id")
                ch = ch.join(prior, [key_col, "chunk_id"], "left_anti")
        ch.write.mode("overwrite").parquet(f"{sink_path.rstrip('/')}/run_id={run_id}/batch_id={epoch_id}")

    def once() -> int:
        """Everything that is planned now; the number of batches."""
        q = (
            stream.writeStream.foreachBatch(batch)
            .option("checkpointLocation", checkpoint_path)
            .trigger(availableNow=True)
            .start()
        )
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
        return sum(p["numInputRows"] > 0 for p in q.recentProgress)

    # the folder source plans one batch a start, and a start after a failure replays the planned one first
    while once() and schema is None:
        pass


def stream_chunks_once(
    spark: SparkSession,
    source_path: str,
    schema: T.StructType,
    chunk_size: int = 1024,
    overlap: int = 200,
    key_col: str = "doc_id",
) -> DataFrame:
    """Run T1 into fresh sink/checkpoint folders under the checkpoint root; return the sink."""
    base = scratch_path(spark, "incremental")
    sink = os.path.join(base, "sink")
    run_incremental(
        spark, source_path, schema, sink, os.path.join(base, "checkpoint"), key_col=key_col,
        chunk_size=chunk_size, overlap=overlap,
        num_partitions=spark.sparkContext.defaultParallelism,
    )
    return spark.read.parquet(sink).drop("run_id", "batch_id")
