"""Program C: image manifest + image files -> VLM training rows.

Image-text path: S6, S7 -> F2 (names) -> F3 (headers) -> bodies -> P17 -> S11 -> P12.
Vendor path:  S6, S7 -> F2 (names) -> P16 -> A3 -> S12, bodies read by the writer.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sftprep.operators import images as I
from sftprep.operators import vlm as V
from sftprep.session import cut_lineage
from sftprep.sources.files import list_images, read_manifest
from sftprep.sources.listing import located_path
from sftprep.sources.sinks import save_and_reload, write_shard_files


def _located(spark: SparkSession, manifest: DataFrame, image_dir: str) -> DataFrame:
    """Manifest rows with the place of their file; saved, as every later step starts from these few columns."""
    root, _ = located_path(spark, image_dir)
    return cut_lineage(I.locate_images(manifest, list_images(spark, image_dir), root=root))


def prepare_vlm_dataset(
    spark: SparkSession,
    manifest_path: str,
    image_dir: str | None = None,
    save_path: str | None = None,
    system_prompt: str = V.DEFAULT_VLM_INSTRUCTION,
) -> tuple[DataFrame, DataFrame]:
    """(conversations, rejected rows: their file exists but is no image).

    ``image_dir`` defaults to the manifest's folder; the converted rows are
    saved to ``save_path`` (default ``<manifest dir>/converted_dataset``) and
    the conversations are built from the saved copy.  The converted rows
    carry no ``instruction`` column, so every row gets ``system_prompt``.
    Of a file that is no image only its first bytes are read; files that the
    manifest does not name are not opened.
    """
    base = os.path.dirname(manifest_path.rstrip("/"))
    located = _located(spark, read_manifest(spark, manifest_path), image_dir or base)
    formats = cut_lineage(I.read_formats(located))
    good, bad = I.split_by_format(located, formats)
    rows = V.image_text_rows(I.with_content(good.select("text", "image_path", "image_length")))
    converted = save_and_reload(rows, save_path or os.path.join(base, "converted_dataset"))
    return V.vlm_conversation(converted, system_prompt), bad


def vlm_dataset_from_table(rows: DataFrame, system_prompt: str = V.DEFAULT_VLM_INSTRUCTION) -> DataFrame:
    """Conversations of a ready table (``image STRUCT<bytes, path>, text``, e.g. a catalog table).

    A table with an ``instruction`` column asks each row's own instruction;
    without one every row gets ``system_prompt``.  All columns are kept.
    """
    missing = [c for c in ("image", "text") if c not in rows.columns]
    if missing:
        raise ValueError(f"the table has no column {', '.join(missing)}")
    return V.vlm_conversation(rows, system_prompt)


def create_vendor_dataset(
    spark: SparkSession,
    dataset_dir: str,
    out_dir: str | None = None,
    name: str = "train",
    num_shards: int = 1,
) -> tuple[DataFrame, DataFrame]:
    """(shard manifest, rows missing text) for ``<dir>/metadata.jsonl`` + ``<dir>/image``.

    Shards are the files ``<name>-0000i-of-0000n.parquet``, contiguous in manifest
    line order: the line position is taken right at the scan (file splits are
    read in offset order) and carried through the join.  Image bytes are read by
    the tasks that write them.
    """
    manifest = read_manifest(spark, os.path.join(dataset_dir, "metadata.jsonl")).withColumn(
        "_line", F.monotonically_increasing_id()
    )
    located = _located(spark, manifest, os.path.join(dataset_dir, "image"))
    # absolute names outside the folder are known to exist once they are looked up
    found = I.read_formats(located.filter("image_length IS NULL")).filter("found").select(F.col("path").alias("image_path"))
    located = located.filter("image_length IS NOT NULL").unionByName(
        located.filter("image_length IS NULL").join(found, "image_path").select(*located.columns)
    )
    good, bad = V.vendor_keys(located, keep=("_line",))
    shards = write_shard_files(good, out_dir or os.path.join(dataset_dir, "data"), name, num_shards, ["_line"], drop=("_line",), late=vendor_images)
    return shards, bad


def vendor_images(batch):
    """The writer's last step: question, answer, image_path and the image itself."""
    import pyarrow as pa

    for part in I.bodies("image_path")(batch):
        path = part.column("image_path")
        image = pa.StructArray.from_arrays([part.column("content"), path], names=["bytes", "path"])
        yield pa.RecordBatch.from_arrays([part.column("question"), part.column("answer"), path, image], names=["question", "answer", "image_path", "image"])
