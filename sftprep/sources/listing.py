"""Listing files in tasks, level by level.

The folders of one level are the work items of a job; each task lists its
folders and writes the files it finds to a table.  The driver gets the
sub-folders back, never a file.  Names that begin with '_' or '.', and empty
files, are listed like any other.
"""

from __future__ import annotations

import os
import stat
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sftprep.session import ensure_library_on_workers, scratch_path

LISTED = "path string, length long, modified timestamp, is_dir boolean"
#: rows of one record batch of a listing
BATCH = 10_000
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def located_path(spark: SparkSession, path: str) -> tuple[str, bool]:
    """The path as Spark lists it (scheme and authority filled in), and whether it is a folder.

    The path's own Hadoop file system is asked, so ``/docs``, ``file:///docs``
    and ``hdfs:///docs`` are all understood the way the readers do.
    """
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
    p = fs.makeQualified(p)
    if not fs.exists(p):
        raise FileNotFoundError(path)
    return p.toString().rstrip("/"), fs.getFileStatus(p).isDirectory()


def file_system(path: str):
    """pyarrow's file system of a path, and the path in it."""
    from pyarrow import fs as pafs

    # Spark writes local files as file:/abs/path; pyarrow wants a plain path or file:///
    if path.startswith("file:") and not path.startswith("file://"):
        path = path[len("file:") :]
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def _entries(path: str, of_file: bool) -> Iterator[tuple]:
    """(path, length, modified, is_dir) of a folder's entries, or of a file itself."""
    from pyarrow import fs as pafs

    filesystem, inner = file_system(path)
    if isinstance(filesystem, pafs.LocalFileSystem) and not of_file:
        yield from _local_entries(path, inner)
        return
    found = [filesystem.get_file_info(inner)] if of_file else filesystem.get_file_info(pafs.FileSelector(inner))
    for info in found:
        is_dir = info.type == pafs.FileType.Directory
        yield path + info.path[len(inner) :], None if is_dir else info.size, info.mtime, is_dir


def _local_entries(path: str, inner: str) -> Iterator[tuple]:
    """``_entries`` of a local folder, one at a time: pyarrow would hold the whole folder."""
    with os.scandir(inner) as entries:
        for entry in entries:
            name = path.rstrip("/") + "/" + entry.name
            try:
                found = entry.stat()
            except FileNotFoundError:  # a link to nothing, or a file that went away meanwhile
                yield name, None, None, False
                continue
            is_dir = stat.S_ISDIR(found.st_mode)
            size = found.st_size if stat.S_ISREG(found.st_mode) else None
            yield name, size, EPOCH + timedelta(microseconds=found.st_mtime_ns // 1000), is_dir


def _listed(of_file: bool):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = [pa.string(), pa.int64(), pa.timestamp("us", "UTC"), pa.bool_()]
        names = ["path", "length", "modified", "is_dir"]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        held: list[tuple] = []
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                for entry in _entries(folder, of_file):
                    held.append(entry)
                    if len(held) >= BATCH:
                        yield batch_of(held)
                        held = []
        if held:
            yield batch_of(held)

    return run


def list_files(spark: SparkSession, root: str, is_dir: bool = True, recursive: bool = False) -> DataFrame:
    """``path, length, modified`` of a file, or of the files of a folder (and of those below it)."""
    ensure_library_on_workers(spark)
    saved = scratch_path(spark, "listing")
    level, depth = [root], 0
    while level:
        folders = spark.createDataFrame([(f,) for f in level], "path string")
        folders = folders.repartition(min(len(level), 4 * spark.sparkContext.defaultParallelism))
        at = f"{saved}/level={depth}"
        folders.mapInArrow(_listed(not is_dir), LISTED).write.parquet(at)
        found = spark.read.schema(LISTED).parquet(at)
        level = [r.path for r in found.filter("is_dir").toLocalIterator()] if recursive else []
        depth += 1
    return spark.read.schema(LISTED).parquet(f"{saved}/level=*").filter("NOT is_dir").select("path", "length", "modified")
