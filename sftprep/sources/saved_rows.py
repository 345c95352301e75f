"""Rows saved once and read again by place, so that a join moves keys and never the wide rows.

A saved row's place is its file and its position there.  A join of wide saved
rows with narrow ones shuffles the key and the place of the one side and the
narrow rows of the other; the rows found are dealt by place, and a task reads
the wide columns where they lie (``fetch``), file by file from front to back.
"""

from __future__ import annotations

from urllib.parse import unquote, urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sftprep.session import SLICE_BYTES, checkpoint_root, ensure_library_on_workers, scratch_path
from sftprep.sources.listing import file_system, located_path

#: bytes of a row group of a saved file; a file is split between tasks by row groups
GROUP_BYTES = 1024 * 1024
#: neighbouring rows of a file that one task fetches
NEIGHBOURS = 8_192
#: saved rows that a task decodes at once
READ_ROWS = 1_024


def save_rows(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` compressed to a fresh folder below ``spark.checkpoint.dir`` and read it back.

    A lineage cut like ``session.cut_lineage``, in columns: neighbouring rows
    that share text take little more room than one of them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").option("parquet.block.size", GROUP_BYTES).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def can_fetch(spark: SparkSession) -> bool:
    """Whether Python can open the folder that ``save_rows`` writes to (a store may be one that only Spark reads)."""
    from pyarrow import fs as pafs

    try:
        filesystem, inner = file_system(located_path(spark, checkpoint_root(spark))[0])
        return filesystem.get_file_info(inner).type == pafs.FileType.Directory
    except Exception:  # noqa: BLE001 - no such file system in pyarrow, or no SparkContext view (Connect)
        return False


def place() -> Column:
    """The place of a row, asked of what ``save_rows`` returned."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def dealt_by_place(rows: DataFrame, place_col: str, partitions: int | None = None) -> DataFrame:
    """``rows`` with the neighbours of one saved file in one task, in their order there.

    With ``partitions`` a file's neighbourhoods go to them in turn, so that they are about equal.
    """
    file, near = F.col(f"{place_col}.file"), F.floor(F.col(f"{place_col}.row") / F.lit(NEIGHBOURS))
    if partitions:
        dealt = rows.repartitionById(partitions, F.pmod(F.hash(file) + near, F.lit(partitions)).cast("int"))
    else:
        dealt = rows.repartition(file, near)
    return dealt.sortWithinPartitions(place_col)


def _opened(path: str):
    """A file that Spark names in a URI's spelling."""
    if path.startswith("file:"):
        path = unquote(urlsplit(path).path)
    filesystem, inner = file_system(path)
    return filesystem.open_input_file(inner)


class _File:
    """A saved file read forwards, ``READ_ROWS`` rows at a time."""

    def __init__(self, path: str, columns: list[str]):
        import numpy as np
        import pyarrow.parquet as pq

        self.path, self.columns = path, columns
        self.file = pq.ParquetFile(_opened(path))
        groups = [self.file.metadata.row_group(g).num_rows for g in range(self.file.num_row_groups)]
        self.starts = np.cumsum([0, *groups])
        self.rows, self.group, self.start, self.held = None, -1, 0, None

    def at(self, row: int):
        """The rows held that include ``row``, and the position of their first."""
        import numpy as np

        group = int(np.searchsorted(self.starts, row, "right")) - 1
        if group != self.group or row < self.start:
            self.group, self.start, self.held = group, int(self.starts[group]), None
            self.rows = self.file.iter_batches(READ_ROWS, row_groups=[group], columns=self.columns)
        while self.held is None or row >= self.start + len(self.held):
            self.start += len(self.held) if self.held is not None else 0
            self.held = next(self.rows)
        return self.start, self.held

    def close(self) -> None:
        self.file.close(force=True)


def fetch(rows: DataFrame, columns: T.StructType, place_col: str) -> DataFrame:
    """``rows`` with the ``columns`` that the saved rows at ``place_col`` have.

    Any order of ``rows`` is right; in the order of their places each file is
    read once, and neighbours with one place get its columns once from Python.
    """
    ensure_library_on_workers(rows.sparkSession)
    names, kept = columns.names, rows.columns
    src = rows.select(F.col(f"{place_col}.file").alias("_file"), F.col(f"{place_col}.row").alias("_row"), *kept)
    schema = T.StructType([*columns.fields, T.StructField("_kept", T.ArrayType(rows.schema))])

    def read(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        reader = None
        for batch in batches:
            if not len(batch):
                continue
            files = batch.column(0).dictionary_encode()
            codes, at = files.indices.to_numpy(), batch.column(1).to_numpy()
            rest = pa.StructArray.from_arrays(batch.columns[2:], names=kept)
            cuts = [0, *(np.flatnonzero(codes[1:] != codes[:-1]) + 1).tolist(), len(batch)]
            for x, y in zip(cuts, cuts[1:]):
                path = files.dictionary[int(codes[x])].as_py()
                if reader is None or reader.path != path:
                    if reader is not None:
                        reader.close()
                    reader = _File(path, names)
                while x < y:
                    start, held = reader.at(int(at[x]))
                    wide = [held.column(held.schema.get_field_index(n)) for n in names]
                    size = np.zeros(len(held), dtype=np.int64)
                    for column in wide:
                        if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
                            size += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
                    inside = (at[x:y] >= start) & (at[x:y] < start + len(held))
                    n = y - x if inside.all() else int(inside.argmin())
                    mine = at[x : x + n]
                    firsts = np.array([0, *(np.flatnonzero(mine[1:] != mine[:-1]) + 1), n])  # of each place
                    take = mine[firsts[:-1]] - start
                    part = np.cumsum(size[take]) // SLICE_BYTES  # a few MB at once, if places come again and again
                    edges = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(take)]
                    for lo, hi in zip(edges, edges[1:]):
                        of_place = pa.ListArray.from_arrays(pa.array(x + firsts[lo : hi + 1], pa.int32()), rest)
                        yield pa.RecordBatch.from_arrays(
                            [*(c.take(pa.array(take[lo:hi])) for c in wide), of_place], names=[*names, "_kept"])
                    x += n
        if reader is not None:
            reader.close()

    return src.mapInArrow(read, schema).select(*names, F.inline("_kept"))
