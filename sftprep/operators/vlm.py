"""image/text manifests joined with image files.

Images are never decoded: F3 is a header (magic-byte) predicate on the
first bytes (``operators.images``, which also holds the keys-first join of files).  The manifest side is broadcast only after measuring it;
otherwise both sides shuffle on the file name.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftprep.functions.chat import image_part, text_part
from sftprep.functions.templates import fill
from sftprep.operators.images import detected_format

# ---------------------------------------------------------------------------
# Fixed values.
DEFAULT_VLM_INSTRUCTION = "Describe the image in detail."
VENDOR_SYSTEM_PROMPT = "This is a chat between a user and an artificial intelligence assistant. The assistant gives helpful, detailed, and polite answers to the user's questions based on the context. The assistant should also indicate when the answer cannot be found in the context."  # noqa: E501
VENDOR_USER_PROMPT = "{question}"
VENDOR_KEYS = {"question": "question", "answer": "answer", "image": "image", "label": "answer"}
# ---------------------------------------------------------------------------


def image_format(content: Column) -> Column:
    """F3 helper: detected format name from the header bytes, NULL if none."""
    return detected_format(content)


def _estimate_bytes(df: DataFrame) -> int:
    parts = [F.coalesce(F.length(F.col(f.name).cast("string")), F.lit(0)) for f in df.schema.fields]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    r = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(total), F.lit(0)).alias("b")).first()
    return int(r["b"]) + 32 * int(r["n"])


def join_images(
    manifest: DataFrame,
    images: DataFrame,
    name_col: str = "file_name",
    broadcast_bytes: int | None = None,
    salt_buckets: int = 16,
) -> DataFrame:
    """manifest rows whose image file exists (inner join; repeats kept).

    ``images`` is ``rel_path, path, content`` (``scan_images``).

    * When the measured manifest fits the broadcast budget, the image side
      is streamed without any shuffle of its bytes.
    * Otherwise both sides shuffle on the file name, and names referenced by
      more rows than one reducer's fair share (``rows / shuffle partitions``)
      are salted.  There are fewer such names than partitions (a proven
      bound), so they are collected.  Their manifest rows spread over
      ``salt_buckets`` salts and only their image rows are replicated that
      many times.
    """
    spark = manifest.sparkSession
    if broadcast_bytes is None:
        raw = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
        try:
            broadcast_bytes = int(str(raw).lower().rstrip("b"))
        except ValueError:
            broadcast_bytes = 10 * 1024 * 1024
    imgs = images.select(F.col("rel_path"), F.col("path").alias("image_path"), "content")
    if broadcast_bytes > 0 and _estimate_bytes(manifest) <= broadcast_bytes:
        m = F.broadcast(manifest)
        return m.join(imgs, m[name_col] == imgs["rel_path"], "inner").drop("rel_path")
    return _salted_join(manifest, imgs, name_col, salt_buckets)


def _salted_join(manifest: DataFrame, imgs: DataFrame, name_col: str, buckets: int) -> DataFrame:
    spark = manifest.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    counts = manifest.groupBy(F.col(name_col).alias("_n")).agg(F.count(F.lit(1)).alias("_c"))
    total = counts.agg(F.coalesce(F.sum("_c"), F.lit(0)).alias("t")).first()["t"]
    share = max(1, int(total) // max(parts, 1))
    hot = [r["_n"] for r in counts.filter(F.col("_c") > share).select("_n").collect()]  # < parts names
    if not hot or buckets <= 1:
        return manifest.join(imgs, manifest[name_col] == imgs["rel_path"], "inner").drop("rel_path")
    is_hot_m = F.col(name_col).isin(hot)
    salt_m = F.when(is_hot_m, F.pmod(F.monotonically_increasing_id(), F.lit(buckets))
                    ).otherwise(F.lit(0))
    m = manifest.withColumn("_salt", salt_m.cast("int"))
    is_hot_i = F.col("rel_path").isin(hot)
    i = imgs.withColumn(
        "_salt",
        F.explode(F.when(is_hot_i, F.sequence(F.lit(0), F.lit(buckets - 1))).otherwise(F.array(F.lit(0)))),
    )
    return (
        m.join(i, (m[name_col] == i["rel_path"]) & (m["_salt"] == i["_salt"]), "inner")
        .drop("rel_path", "_salt")
    )


def _local_or_uri(path: str) -> str:
    # Spark lists local files as file:/abs/path; pyarrow wants a plain path or file:///
    if path.startswith("file:") and not path.startswith("file://"):
        return path[len("file:"):]
    return path


READ_BYTES = 4 * 1024 * 1024


def _read_files(batches):
    """mapInPandas body: add ``content`` bytes for each ``path`` (one read per file).

    Rows are handed on whenever about READ_BYTES are held, however many paths a
    batch has.
    """
    from pyarrow import fs as pafs

    for pdf in batches:
        data, start, size = [], 0, 0
        for i, p in enumerate(pdf["path"]):
            target = _local_or_uri(p)
            filesystem, inner = pafs.FileSystem.from_uri(target) if "://" in target else (
                pafs.LocalFileSystem(), target)
            with filesystem.open_input_stream(inner) as f:
                data.append(f.read())
            size += len(data[-1])
            if size >= READ_BYTES or i + 1 == len(pdf):
                yield pdf.iloc[start : i + 1].assign(content=data)
                data, start, size = [], i + 1, 0


def read_by_path(files: DataFrame) -> DataFrame:
    """``files`` (with a ``path``) plus ``content``, read in tasks."""
    from pyspark.sql import types as T

    from sftprep.session import ensure_library_on_workers

    ensure_library_on_workers(files.sparkSession)
    schema = T.StructType([*files.schema.fields, T.StructField("content", T.BinaryType())])
    return files.mapInPandas(_read_files, schema)


def referenced_images(manifest: DataFrame, listing: DataFrame, name_col: str = "file_name",
                      partitions: int | None = None) -> DataFrame:
    """``rel_path, path, content`` for the listed files the manifest names, read once each.

    The listing is used by name only (no bytes in its scan); referenced
    files are read in Arrow-batched tasks, so a sparse manifest over a large
    image store never reads the files it does not name.
    """
    from sftprep.session import ensure_library_on_workers

    ensure_library_on_workers(manifest.sparkSession)
    names = manifest.select(F.col(name_col).alias("_name")).distinct()
    refs = listing.select("rel_path", "path").join(names, F.col("rel_path") == F.col("_name"), "left_semi")
    if partitions:
        refs = refs.repartition(partitions, "path")
    schema = "rel_path string, path string, content binary"
    return refs.mapInPandas(_read_files, schema)


def rows_with_image(manifest: DataFrame, images: DataFrame, name_col: str = "file_name") -> DataFrame:
    """F2 without bytes: manifest rows whose file exists (left-semi on names only,
    so no image content is read)."""
    names = images.select(F.col("rel_path"))
    return manifest.join(names, manifest[name_col] == names["rel_path"], "left_semi")


def split_valid_images(joined: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose header is a known image format, quarantined rows)."""
    tagged = joined.withColumn("image_format", image_format(F.col("content")))
    return tagged.filter(F.col("image_format").isNotNull()), tagged.filter(
        F.col("image_format").isNull()
    )


def image_struct(content: Column, path: Column) -> Column:
    return F.struct(content.alias("bytes"), path.alias("path"))


def image_text_rows(valid: DataFrame) -> DataFrame:
    """``image STRUCT<bytes, path>, text, image_path``."""
    return valid.select(
        image_struct(F.col("content"), F.col("image_path")).alias("image"),
        F.col("text"),
        F.col("image_path"),
    )


def vlm_conversation(rows: DataFrame, system_prompt: str = DEFAULT_VLM_INSTRUCTION) -> DataFrame:
    """``messages`` = user [text instruction, image], assistant [text].

    The instruction is the row's ``instruction`` when that column exists
    (even if NULL), else ``system_prompt``.
    """
    instr = F.col("instruction") if "instruction" in rows.columns else F.lit(system_prompt)
    if "image" in rows.columns:
        image = F.col("image")
    else:  # joined rows straight from F2/F3
        image = image_struct(F.col("content"), F.col("image_path"))
    user = F.struct(
        F.lit("user").alias("role"),
        F.array(text_part(instr), image_part(image=image)).alias("content"),
    )
    assistant = F.struct(
        F.lit("assistant").alias("role"), F.array(text_part(F.col("text"))).alias("content")
    )
    return rows.select(*rows.columns, F.array(user, assistant).alias("messages"))


def vendor_rows(joined: DataFrame, keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(question, answer, image_path, image) rows; rows without an
    instruction are skipped; rows without text are returned as errors."""
    image = image_struct(F.col("content"), F.col("image_path")).alias("image")
    return _vendor_split(joined, [*keep], [image])


def vendor_keys(located: DataFrame, keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """P16 before the image is read: the same rows without ``image``."""
    return _vendor_split(located, [*keep], [])


def _vendor_split(rows: DataFrame, keep: list, last: list) -> tuple[DataFrame, DataFrame]:
    has_q = F.col("instruction").isNotNull()
    good = rows.filter(has_q & F.col("text").isNotNull()).select(
        *keep, F.col("instruction").alias("question"), F.col("text").alias("answer"), F.col("image_path"), *last
    )
    bad = rows.filter(has_q & F.col("text").isNull()).select(
        "file_name", "image_path", F.lit("missing text").alias("error")
    )
    return good, bad


def keyed_qa(
    df: DataFrame,
    keys: Mapping[str, str] = VENDOR_KEYS,
    system_prompt: str = VENDOR_SYSTEM_PROMPT,
    user_prompt: str = VENDOR_USER_PROMPT,
    exp_type: str = "train",
) -> DataFrame:
    """Render configured question/answer/image/label columns to chat turns.

    ``train`` keeps the assistant turn; ``inference`` drops it and keeps the
    label for scoring.
    """
    if exp_type not in ("train", "inference"):
        raise ValueError("exp_type must be 'train' or 'inference'")
    q, a, img, lab = (F.col(keys[k]) for k in ("question", "answer", "image", "label"))
    cols = [
        F.lit(system_prompt).alias("system"),
        fill(user_prompt, {"question": q}).alias("user"),
        img.alias("image"),
    ]
    if exp_type == "train":
        cols.append(a.alias("assistant"))
    else:
        cols.append(lab.alias("label"))
    return df.select(*cols)
