"""QA-pair sink, training JSON, converted dataset, sharded Parquet."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sftprep.operators.ranking import assign_shards, shard_file_name, shard_manifest
from sftprep.session import cut_lineage, ensure_library_on_workers
from sftprep.sources.files import QA_PAIR_SCHEMA, SEGMENTS
from sftprep.sources.listing import file_system


#: files of one append to the bucketed pair log
PAIR_BUCKETS = 64


def append_pairs(pairs: DataFrame, path: str, fmt: str = "json", buckets: int | None = None) -> None:
    """Append pairs (no rewrite of earlier output).

    Without ``buckets`` there is one folder per source: readable by eye, but as many
    folders as documents.  Rows are then range-partitioned on ``(source, chunk_id)``
    first, so each task holds a contiguous run of sources.

    With ``buckets`` the append is one segment of at most that many files below
    ``<path>/layout=buckets``, hashed on ``(source, chunk_id)`` (a source holding a third of
    the rows fills all of them) and sorted, however many sources there are.
    ``read_pairs_or_empty`` reads both layouts; ``compact_pairs`` joins segments.
    """
    if buckets is None:
        (
            pairs.repartitionByRange("source", "chunk_id")
            .sortWithinPartitions("source", "chunk_id")
            .write.mode("append")
            .partitionBy("source")
            .format(fmt)
            .save(path)
        )
        return
    _bucketed(pairs, buckets).write.mode("append").format(fmt).save(f"{path.rstrip('/')}/{SEGMENTS}")


def _bucketed(pairs: DataFrame, buckets: int) -> DataFrame:
    return pairs.repartition(buckets, "source", "chunk_id").sortWithinPartitions("source", "chunk_id")


def compact_pairs(spark: SparkSession, path: str, fmt: str = "json", buckets: int = PAIR_BUCKETS) -> None:
    """Rewrite all segments of a pair log as one of ``buckets`` files.

    The new segment is written beside the old ones and put in place by two renames.
    A run that stops between them leaves the new segment under its own name, complete;
    the next call (of this or of ``recover_pairs``) finishes the exchange.  Not to be
    run while another job appends.
    """
    recover_pairs(spark, path)
    root = path.rstrip("/")
    fs, at = _file_system(spark, root)
    if not fs.exists(at(f"{root}/{SEGMENTS}")):
        return
    old = f"{root}/_old-{uuid.uuid4().hex}"
    new = f"{root}/_next-{uuid.uuid4().hex}"
    held = spark.read.schema(QA_PAIR_SCHEMA).format(fmt).load(f"{root}/{SEGMENTS}")
    _bucketed(held, buckets).write.format(fmt).save(new)
    _rename(fs, at(f"{root}/{SEGMENTS}"), at(old))
    _rename(fs, at(new), at(f"{root}/{SEGMENTS}"))
    fs.delete(at(old), True)


def recover_pairs(spark: SparkSession, path: str) -> None:
    """Finish the exchange of a compaction that was stopped between its renames."""
    root = path.rstrip("/")
    fs, at = _file_system(spark, root)
    if not fs.exists(at(root)) or fs.exists(at(f"{root}/{SEGMENTS}")):
        return
    ready = [s.getPath() for s in fs.listStatus(at(root)) if s.getPath().getName().startswith("_next-")]
    ready = [p for p in ready if fs.exists(at(f"{p.toString()}/_SUCCESS"))]
    if ready:
        _rename(fs, ready[0], at(f"{root}/{SEGMENTS}"))


def _file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and its path factory."""
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path
    return at(path).getFileSystem(sc._jsc.hadoopConfiguration()), at


def _rename(fs, old, new) -> None:
    if not fs.rename(old, new):
        raise OSError(f"cannot rename {old.toString()} to {new.toString()}")


def write_training_json(records: DataFrame, path: str) -> None:
    """Replace the training set with JSON lines (non-ASCII kept as is)."""
    records.write.mode("overwrite").json(path)


def save_and_reload(df: DataFrame, path: str) -> DataFrame:
    """Write the converted dataset as Parquet and continue from the saved copy."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_sharded_parquet(
    df: DataFrame, out_dir: str, name: str, num_shards: int, order: list, drop: tuple = ()
) -> DataFrame:
    """S12 with A3: contiguous shards written under ``shard_file=<name>-0000i-of-0000n.parquet``.

    The ranked rows are already range-partitioned and sorted in position
    order (A3 ranks through a global sort), so every task writes a contiguous
    slice of one or two shards with no further shuffle and no shard is
    funnelled through one task.  A local sort on (shard file, position) keeps
    row order inside each file and satisfies the writer's partition ordering.
    Every column of ``df`` but those in ``drop`` is written, and no other.
    Returns the manifest of all shards with row counts (empty shards included).
    """
    spark = df.sparkSession
    row = F.struct(*[F.col(c) for c in df.columns if c not in drop])
    keyed = df.select(row.alias("_row"), *[F.col(c).alias(f"_order{i}") for i, c in enumerate(order)])
    sharded, _ = assign_shards(keyed, [f"_order{i}" for i in range(len(order))], num_shards)
    out = sharded.withColumn("shard_file", shard_file_name(name, F.col("shard"), num_shards))
    rows = out.sortWithinPartitions("shard_file", "row_idx").select("_row.*", "shard_file")
    rows.write.mode("overwrite").partitionBy("shard_file").parquet(out_dir)
    manifest = shard_manifest(spark, sharded, name, num_shards)
    # empty shards get a file too (schema only); at most num_shards names
    empty_schema = rows.drop("shard_file").schema
    for r in manifest.filter(F.col("n_rows") == 0).select("file_name").collect():
        spark.createDataFrame([], empty_schema).coalesce(1).write.mode("overwrite").parquet(
            f"{out_dir.rstrip('/')}/shard_file={r['file_name']}"
        )
    return manifest


def write_shard_files(
    df: DataFrame, out_dir: str, name: str, num_shards: int, order: list, drop: tuple = (), late: Callable | None = None
) -> DataFrame:
    """S12 with A3: exactly ``num_shards`` files ``<name>-0000i-of-0000n.parquet``, contiguous in ``order``.

    Positions are taken on ``df`` as given; ``late`` (record batch -> record batches)
    may add what should not be sorted or shuffled, such as image bytes, in the writing
    task.  A task streams each of its shards, row group by row group, to a staging file
    named by its attempt and renames the finished file into place: a retried task
    writes the same file again, and no reader sees half of one.  Empty shards get
    a file with the schema.  Older files of the same name pattern are removed at the end.
    Returns the manifest of all shards with row counts.
    """
    spark = df.sparkSession
    ensure_library_on_workers(spark)
    row = F.struct(*[F.col(c) for c in df.columns if c not in drop])
    keyed = df.select(row.alias("_row"), *[F.col(c).alias(f"_order{i}") for i, c in enumerate(order)])
    ranked, _ = assign_shards(keyed, [f"_order{i}" for i in range(len(order))], num_shards)
    # one marker row per shard, first in order: every shard reaches a task, also an empty one
    rows = ranked.select("shard", "row_idx", "_row")
    markers = spark.range(num_shards).select(F.col("id").cast("int").alias("shard"), F.lit(-1).cast("long").alias("row_idx"), F.lit(None).cast(rows.schema["_row"].dataType).alias("_row"))
    dealt = rows.unionByName(markers).repartitionById(num_shards, F.col("shard")).sortWithinPartitions("shard", "row_idx")
    staging, final = f"{out_dir.rstrip('/')}/_staging-{uuid.uuid4().hex}", out_dir.rstrip("/")

    def write(batches):
        import pyarrow as pa
        import pyarrow.compute  # noqa: F401
        import pyarrow.parquet as pq
        from pyarrow import fs as pafs
        from pyspark import TaskContext

        attempt = TaskContext.get().taskAttemptId()
        filesystem, staged = file_system(staging)
        _, target = file_system(final)
        filesystem.create_dir(staged, recursive=True)
        writer, shard, n = None, None, 0

        def finished():
            writer.close()
            file = f"{name}-{shard:05d}-of-{num_shards:05d}.parquet"
            if filesystem.get_file_info(f"{target}/{file}").type != pafs.FileType.NotFound:
                filesystem.delete_file(f"{target}/{file}")
            filesystem.move(f"{staged}/{shard}.{attempt}", f"{target}/{file}")
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([file]), pa.array([n], pa.int64())], names=["shard", "file_name", "n_rows"])

        for batch in batches:
            at = batch.column(0).to_numpy()
            cuts = [0, *((at[1:] != at[:-1]).nonzero()[0] + 1).tolist(), len(at)]
            for x, y in zip(cuts, cuts[1:]):
                if x == y:
                    continue
                if at[x] != shard and writer is not None:
                    yield finished()
                    writer = None
                shard = int(at[x])
                part = batch.slice(x, y - x)
                part = part.filter(pa.compute.greater_equal(part.column(1), 0))
                plain = pa.RecordBatch.from_struct_array(part.column(2))
                for piece in late(plain) if late else [plain]:
                    if writer is None:
                        writer, n = pq.ParquetWriter(f"{staged}/{shard}.{attempt}", piece.schema, filesystem=filesystem), 0
                    if len(piece):
                        writer.write_batch(piece)
                        n += len(piece)
        if writer is not None:
            yield finished()

    manifest = cut_lineage(dealt.mapInArrow(write, "shard int, file_name string, n_rows long"))
    fs, at = _file_system(spark, final)
    fs.delete(at(staging), True)
    pattern = re.compile(re.escape(name) + r"-\d{5}-of-(\d{5})\.parquet")
    for status in fs.listStatus(at(final)):
        old = pattern.fullmatch(status.getPath().getName())
        if old and int(old[1]) != num_shards:
            fs.delete(status.getPath(), False)
    return manifest

