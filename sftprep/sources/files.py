"""Document, training-JSON, manifest and image scans; resume scan.

Files are listed in tasks (``sources.listing``) and filtered by name; the bodies
of those that stay are read by path, dealt to tasks by their listed lengths.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sftprep.operators.chunking import chunk_documents
from sftprep.operators.images import with_content
from sftprep.session import scratch_path
from sftprep.sources.json_array import BLOCK_BYTES, json_array_records
from sftprep.sources.listing import list_files, located_path

# ---------------------------------------------------------------------------
# Fixed values.
DOCUMENT_EXTENSIONS = ("docx", "pdf", "txt", "md", "xlsx", "csv", "pptx")
TEXT_EXTENSIONS = ("txt", "md", "csv")  # decoded as UTF-8 text; the rest need a codec
# ---------------------------------------------------------------------------

TRAINING_SCHEMA = T.StructType(
    [
        T.StructField("instruction", T.StringType()),
        T.StructField("input", T.StringType()),
        T.StructField("output", T.StringType()),
    ]
)
MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("file_name", T.StringType()),
        T.StructField("instruction", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)
QA_PAIR_SCHEMA = T.StructType(
    [
        T.StructField("question", T.StringType()),
        T.StructField("answer", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("chunk_id", T.IntegerType()),
        T.StructField("chunk", T.StringType()),
    ]
)

#: folder of the bucketed segments of a pair sink; named like a partition, so that plain readers of the sink find it
SEGMENTS = "layout=buckets"


def base_name(path: Column) -> Column:
    """Last path segment."""
    return F.element_at(F.split(path, "/"), -1)


def extension(name: Column) -> Column:
    """Lower-cased text after the last '.'; a name without '.' is its own extension."""
    return F.lower(F.element_at(F.split(name, "\\."), -1))


def has_document_extension(name: Column, extensions: Sequence[str] = DOCUMENT_EXTENSIONS) -> Column:
    """extension test of S1 (case-insensitive)."""
    return extension(name).isin(*extensions)


def source_id(name: Column) -> Column:
    """S3: base name with every '.' replaced by '_'."""
    return F.replace(base_name(name), F.lit("."), F.lit("_"))


def source_collisions(docs: DataFrame, name_col: str = "name") -> DataFrame:
    """Source ids shared by more than one file name (a.b.txt vs a_b.txt)."""
    return (
        docs.groupBy(source_id(F.col(name_col)).alias("source"))
        .agg(F.count_distinct(name_col).alias("n_names"))
        .filter(F.col("n_names") > 1)
    )


def scan_documents(spark: SparkSession, path: str, extensions: Sequence[str] = DOCUMENT_EXTENSIONS) -> DataFrame:
    """S1 + S2: ``path, name, ext, source, text, valid_utf8`` for the files of a directory.

    A directory keeps its direct files whose extension is listed; a single
    file is taken whatever its extension.  Text formats are read as UTF-8;
    invalid byte sequences become U+FFFD (one bad file must not fail a corpus
    job) and ``valid_utf8`` flags such files.  Office/PDF formats need a codec
    and get a NULL ``text``; ``unreadable_documents`` lists them.  Names that
    begin with '_' or '.' are documents like any other.  No matching file is an
    error.
    """
    root, is_dir = located_path(spark, path)
    listing = list_files(spark, root, is_dir).select("path", "length")
    if is_dir:
        listing = listing.filter(has_document_extension(base_name(F.col("path")), extensions))
    if listing.isEmpty():
        raise ValueError(f"No valid documents found in input path: ({path})")
    is_text = extension(base_name(F.col("path"))).isin(*TEXT_EXTENSIONS)
    full = with_content(listing.filter(is_text), "path", "length").unionByName(
        listing.filter(~is_text).withColumn("content", F.lit(None).cast("binary"))
    )
    name = base_name(F.col("path"))
    raw = F.col("content").cast("string")  # bytes as-is; repaired below, never an error
    return full.select(
        "path",
        name.alias("name"),
        extension(name).alias("ext"),
        source_id(F.col("path")).alias("source"),
        F.make_valid_utf8(raw).alias("text"),
        F.is_valid_utf8(raw).alias("valid_utf8"),
    )


def unreadable_documents(docs: DataFrame) -> DataFrame:
    """Rows of ``scan_documents`` whose format has no text reader here (NULL ``text``)."""
    return docs.filter(F.col("text").isNull()).drop("text")


def load_chunks(
    spark: SparkSession, path: str, chunk_size: int = 1000, overlap: int = 200
) -> DataFrame:
    """Scan then the plain chunker (never the markdown one)."""
    docs = scan_documents(spark, path)
    return chunk_documents(docs, keep=["source"], chunk_size=chunk_size, overlap=overlap)


def read_training_json(
    spark: SparkSession, path: str, schema: T.StructType | None = TRAINING_SCHEMA, multiline: bool | None = None, block: int = BLOCK_BYTES
) -> DataFrame:
    """A JSON array file or JSON lines.

    With ``multiline`` None the first non-blank character decides: '[' means
    a JSON array.  A single array file beyond ``block`` bytes is read by several
    tasks (``sources.json_array``).  ``schema`` None keeps every field of the
    records: the three training fields as strings, the others as Spark infers them.
    """
    if multiline is None:
        first = (
            spark.read.text(path)
            .select(F.ltrim(F.col("value")).alias("v"))
            .filter(F.length("v") > 0)
            .limit(1)
            .collect()
        )
        if not first:
            raise ValueError(f"no records in {path}")
        multiline = first[0]["v"].startswith("[")
    if multiline:
        root, is_dir = located_path(spark, path)
        length = 0 if is_dir else list_files(spark, root, False).first()["length"]
        if length > block:
            # saved as JSON lines: line ends inside a record are white space
            path, multiline = scratch_path(spark, "records"), False
            json_array_records(spark, root, length, block).select(F.translate("value", "\r\n", "  ").alias("value")).write.text(path)
    reader = spark.read.option("multiLine", multiline).option("mode", "FAILFAST")
    if schema is None:
        try:
            schema = _training_fields(reader.json(path).schema)
        except AnalysisException as exc:  # files without any record show no fields
            if exc.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            schema = TRAINING_SCHEMA
    return reader.schema(schema).json(path)


def _training_fields(found: T.StructType) -> T.StructType:
    """The training fields as strings, then the other fields of the records."""
    other = [f for f in found.fields if f.name not in TRAINING_SCHEMA.names]
    return T.StructType([*TRAINING_SCHEMA.fields, *other])


def load_training_dataset(
    spark: SparkSession, dataset_name: str | None = None, dataset_path: str | None = None
) -> DataFrame:
    """S5 entry: a catalog table by name (stands in for a named dataset's train
    split), else a JSON array / JSON-lines path; neither is an error."""
    if dataset_name:
        return spark.table(dataset_name)
    if dataset_path:
        return read_training_json(spark, dataset_path, schema=None)
    raise ValueError("dataset_name or dataset_path is required")


def read_manifest(
    spark: SparkSession, path: str, schema: T.StructType = MANIFEST_SCHEMA, quarantine: bool = False
) -> DataFrame:
    """JSON lines manifest with an explicit schema.

    By default a malformed line fails the job (as in the reference).  With
    ``quarantine`` every line is kept and a malformed one carries its text in
    ``_corrupt_record`` (other fields NULL), to be routed to a reject output.
    """
    if not quarantine:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    with_bad = T.StructType(schema.fields + [T.StructField("_corrupt_record", T.StringType())])
    return (
        spark.read.schema(with_bad)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .json(path)
    )


def list_images(spark: SparkSession, image_dir: str) -> DataFrame:
    """S7 without bytes: ``rel_path, path, length`` of every file under ``image_dir``.

    ``rel_path`` (the join key with manifest ``file_name``) is the path
    relative to the directory.
    """
    root, is_dir = located_path(spark, image_dir)
    listing = list_files(spark, root, is_dir, recursive=True)
    # a listed path outside the folder is an error, not an empty name
    inside = F.startswith(F.col("path"), F.lit(root + "/"))
    rel = F.when(inside, F.substring(F.col("path"), len(root) + 2, 1 << 30)).otherwise(
        F.raise_error(F.concat(F.lit(f"not below {root}: "), F.col("path")))
    )
    return listing.select(rel.alias("rel_path"), "path", "length")


def scan_images(spark: SparkSession, image_dir: str) -> DataFrame:
    """``list_images`` with every file's ``content``, read only if a later step selects it.

    Spark's ``binaryFile`` source prunes the column; the files that it leaves out
    (hidden names, empty files) are read by path.  Where no bytes are wanted, or only
    those of few files, ``list_images`` also spares the driver the file index.
    """
    listing = list_images(spark, image_dir)
    root, _ = located_path(spark, image_dir)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    rel = F.substring(F.col("path"), len(root) + 2, 1 << 30)
    seen = reader.select(rel.alias("rel_path"), "path", "length", "content")
    rest = listing.join(seen.select("path"), "path", "left_anti").select("rel_path", "path", "length")
    return seen if rest.isEmpty() else seen.unionByName(with_content(rest, "path", "length"))


def read_pairs_or_empty(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Pairs written by earlier runs, or an empty table with the pair schema.

    Both layouts of the pair sink are read, also beside each other: one folder
    per source, and bucketed segments.
    """
    root = path.rstrip("/")
    found = [_pairs_in(spark, f"{root}/{SEGMENTS}", fmt)]
    if found[0] is None:
        found = [_pairs_in(spark, root, fmt)]
    else:  # folders per source, and files without a folder, of runs before the segments
        found += [_pairs_in(spark, f"{root}/source=*", fmt, root), _pairs_in(spark, f"{root}/part-*", fmt)]
    found = [p for p in found if p is not None]
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], QA_PAIR_SCHEMA)


def _pairs_in(spark: SparkSession, path: str, fmt: str, base: str | None = None) -> DataFrame | None:
    reader = spark.read.schema(QA_PAIR_SCHEMA).format(fmt)
    if base:
        reader = reader.option("basePath", base)
    if fmt == "json":
        reader = reader.option("mode", "FAILFAST")  # a broken line is an error, not an empty pair
    try:
        return reader.load(path).select(*QA_PAIR_SCHEMA.names)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
