"""F2 and F3 on files, keys first: names are joined, headers are read by range, bodies come last.

Nothing that is shuffled, sorted or checkpointed holds image bytes.  The
manifest meets the listing by name; the first bytes of each named file are read
once in tasks and compared with a signature table; the bodies of the rows that
stay are read by the stage that writes them.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sftprep.session import ensure_library_on_workers

#: bytes of a file's first range read, and boxes of a container that are looked at
HEAD, MAX_BOXES = 64, 8
#: file bytes that one task holds at once (or one file), and the bytes and files that one task should read in all
READ_BYTES, TASK_BYTES, TASK_FILES = 4 * 1024 * 1024, 64 * 1024 * 1024, 5_000


class Signature(NamedTuple):
    """A format and the (offset, hex bytes) that its files have."""

    format: str
    parts: tuple[tuple[int, str], ...]


def _at_start(name: str, *sigs: str) -> list[Signature]:
    return [Signature(name, ((0, s),)) for s in sigs]


# Public file-format constants, as upper-case hex.
SIGNATURES: tuple[Signature, ...] = (
    *_at_start("png", "89504E470D0A1A0A"),
    *_at_start("jpeg", "FFD8FF"),
    *_at_start("gif", "474946383761", "474946383961"),
    *_at_start("bmp", "424D"),
    *_at_start("tiff", "49492A00", "4D4D002A", "49492B00", "4D4D002B"),
    Signature("webp", ((0, "52494646"), (8, "57454250"))),
    *_at_start("jpeg2000", "0000000C6A5020200D0A870A", "FF4FFF51"),
    *_at_start("jpegxl", "FF0A", "0000000C4A584C200D0A870A"),
    *_at_start("ico", "00000100"),
    *_at_start("cur", "00000200"),
    *_at_start("icns", "69636E73"),
    *_at_start("psd", "38425053"),
    *_at_start("dds", "44445320"),
    *_at_start("qoi", "716F6966"),
    *_at_start("exr", "762F3101"),
    *_at_start("hdr", "233F52414449414E4345"),
    *_at_start("sgi", "01DA"),
    *_at_start("sun", "59A66A95"),
    *_at_start("pcx", "0A0001", "0A0201", "0A0301", "0A0501"),
    *_at_start("fits", "53494D504C452020"),
    *_at_start("xpm", "2F2A2058504D202A2F"),
    *_at_start("xbm", "23646566696E6520"),
    *_at_start("eps", "25215053", "C5D0D3C6"),
    *_at_start("wmf", "D7CDC69A"),
    Signature("emf", ((0, "01000000"), (40, "20454D46"))),
    *(s for kind in range(0x31, 0x38) for space in ("0A", "0D", "20", "09") for s in _at_start("pnm", f"50{kind:02X}{space}")),
)
#: brands of the ISO base media container, by format
BRANDS: dict[str, tuple[str, ...]] = {
    "avif": ("avif", "avis"),
    "heif": ("heic", "heix", "hevc", "hevx", "heim", "heis", "mif1", "msf1"),
}


def detected_format(content: Column, signatures: Sequence[Signature] = SIGNATURES, brands: Mapping[str, Sequence[str]] = BRANDS) -> Column:
    """F3 on a bytes column: the format its first HEAD bytes show, NULL if none (first signature wins)."""
    head = F.hex(F.substring(content, 1, HEAD))
    size = F.conv(F.substring(head, 1, 8), 16, 10).cast("long")
    stop = F.least(F.coalesce(size, F.lit(0)), F.lit(HEAD)) - 4
    places = F.concat(F.array(F.lit(8).cast("long")), F.sequence(F.lit(16).cast("long"), F.greatest(stop, F.lit(16).cast("long")), F.lit(4).cast("long")))
    named = F.transform(places, lambda i: F.substr(head, (2 * i + 1).cast("int"), F.lit(8)))
    fmt = F.lit(None).cast("string")
    for name, codes in reversed(brands.items()):
        hit = F.arrays_overlap(named, F.array(*[F.lit(c.encode().hex().upper()) for c in codes]))
        fmt = F.when((F.substring(head, 9, 8) == "66747970") & hit, F.lit(name)).otherwise(fmt)
    for name, parts in reversed(signatures):
        hits = [F.substring(head, 2 * at + 1, len(sig)) == F.lit(sig) for at, sig in parts]
        both = hits[0]
        for h in hits[1:]:
            both = both & h
        fmt = F.when(both, F.lit(name)).otherwise(fmt)
    return fmt


def sniff(read: Callable[[int, int], bytes], signatures: Sequence[Signature] = SIGNATURES, brands: Mapping[str, Sequence[str]] = BRANDS) -> str | None:
    """F3 on a file through ``read(offset, size)``: HEAD bytes, and a few more only for containers.

    A container's boxes are walked by their sizes until the one that names its brands.
    """
    head = read(0, HEAD)
    for name, parts in signatures:
        if all(head[at : at + len(sig) // 2] == bytes.fromhex(sig) for at, sig in parts):
            return name
    at = 0
    for _ in range(MAX_BOXES):
        box = head if at == 0 else read(at, HEAD)
        size, kind = int.from_bytes(box[:4], "big"), box[4:8]
        if len(box) < 16 or size < 8 or not kind.isalnum():
            return None
        if kind == b"ftyp":
            whole = box[:size] if size <= len(box) else box + read(at + len(box), min(size, 4096) - len(box))
            named = {whole[8:12], *(whole[i : i + 4] for i in range(16, len(whole) - 3, 4))}
            return next((f for f, codes in brands.items() if named & {c.encode() for c in codes}), None)
        at += size
    return None


def _opened(path: str):
    from sftprep.sources.listing import file_system

    filesystem, inner = file_system(path)
    return filesystem.open_input_file(inner)


def normal_name(name: Column, root: str | None = None) -> Column:
    """A manifest name as the listing spells it: ``./``, ``//`` and ``..`` resolved, ``root`` taken off.

    A name that is absolute and not below ``root`` stays absolute.
    """
    def step(done: Column, part: Column) -> Column:
        up = F.when(F.size(done) > 0, F.slice(done, F.lit(1), F.size(done) - 1)).otherwise(done)
        return F.when(part.isin("", "."), done).when(part == "..", up).otherwise(F.concat(done, F.array(part)))

    scheme = F.regexp_extract(name, "^([A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?)", 1)
    rest = F.substr(name, F.length(scheme) + 1)
    scheme = F.regexp_replace(scheme, "://$", ":")  # file:///x is file:/x
    plain = F.array_join(F.aggregate(F.split(rest, "/"), F.array().cast("array<string>"), step), "/")
    full = F.when(F.startswith(rest, F.lit("/")), F.concat(scheme, F.lit("/"), plain)).otherwise(plain)
    if not root:
        return full
    own = re.match("([A-Za-z][A-Za-z0-9+.-]*:)?(//[^/]*)?", root)
    prefix, base = own[0], root[len(own[0]) :].rstrip("/") + "/"
    # the root's own scheme may be left out, or its authority
    same = scheme.isin("", prefix, own[1] or "") & F.startswith(F.concat(F.lit("/"), plain), F.lit(base))
    return F.when(same & F.startswith(rest, F.lit("/")), F.substr(F.concat(F.lit("/"), plain), F.lit(len(base) + 1))).otherwise(full)


def locate_images(manifest: DataFrame, listing: DataFrame, name_col: str = "file_name", root: str | None = None) -> DataFrame:
    """F2 on names only: manifest rows with ``image_path`` and ``image_length`` of their file.

    ``listing`` is ``rel_path, path, length``; no bytes are read.  Rows whose name is an
    absolute path outside ``root`` keep it as ``image_path`` (length NULL): whether
    that file exists is known when its header is read.
    """
    named = manifest.withColumn("_name", normal_name(F.col(name_col), root))
    files = listing.select(F.col("rel_path").alias("_rel"), F.col("path").alias("image_path"), F.col("length").alias("image_length"))
    inside = named.join(files, named["_name"] == files["_rel"]).drop("_rel", "_name")
    outside = named.filter(F.col("_name").rlike("^([A-Za-z][A-Za-z0-9+.-]*:)?/"))
    return inside.unionByName(outside.select(*manifest.columns, F.col("_name").alias("image_path"), F.lit(None).cast("long").alias("image_length")))


def read_formats(paths: DataFrame, path_col: str = "image_path", partitions: int | None = None,
                 signatures: Sequence[Signature] = SIGNATURES, brands: Mapping[str, Sequence[str]] = BRANDS) -> DataFrame:
    """F3 by range reads: ``path, image_format, found`` for each distinct path, one small read a file."""
    spark = paths.sparkSession
    ensure_library_on_workers(spark)
    signatures, brands = tuple(signatures), dict(brands)

    def sniffed(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            formats, found = [], []
            for path in batch.column(0).to_pylist():
                try:
                    with _opened(path) as f:
                        size = f.size()
                        formats.append(sniff(lambda at, n: f.read_at(max(0, min(n, size - at)), at) if at < size else b"", signatures, brands))
                    found.append(True)
                except FileNotFoundError:
                    formats.append(None)
                    found.append(False)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(formats, pa.string()), pa.array(found, pa.bool_())], names=["path", "image_format", "found"])

    names = paths.select(F.col(path_col).alias("path")).distinct()
    names = names.repartition(partitions or 4 * spark.sparkContext.defaultParallelism, "path")
    return names.mapInArrow(sniffed, "path string, image_format string, found boolean")


def split_by_format(located: DataFrame, formats: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose file is an image, with ``image_format``; rows whose file is none). Missing files are in neither."""
    seen = formats.filter("found").select(F.col("path").alias("_path"), "image_format")
    both = located.join(seen, located["image_path"] == seen["_path"]).drop("_path")
    return both.filter(F.col("image_format").isNotNull()), both.filter(F.col("image_format").isNull())


def bodies(path_col: str, out_col: str = "content") -> Callable:
    """A batch function: record batches with ``out_col``, the bytes of each row's file, READ_BYTES at a time."""

    def read(batch) -> Iterator:
        import pyarrow as pa

        paths, data, start, size = batch.column(batch.schema.get_field_index(path_col)).to_pylist(), [], 0, 0
        for i, path in enumerate(paths):
            with _opened(path) as f:
                data.append(f.read())
            size += len(data[-1])
            if size >= READ_BYTES or i + 1 == len(paths):
                part = batch.slice(start, i + 1 - start)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(data, pa.binary())], names=[*batch.schema.names, out_col])
                data, start, size = [], i + 1, 0
        if not paths:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([], pa.binary())], names=[*batch.schema.names, out_col])

    return read


def with_content(rows: DataFrame, path_col: str = "image_path", length_col: str = "image_length") -> DataFrame:
    """``rows`` with ``content``, read last: rows (without bytes) are first dealt to tasks by count.

    The number of tasks follows the listed lengths and the number of files, about
    TASK_BYTES or TASK_FILES each.
    """
    spark = rows.sparkSession
    ensure_library_on_workers(spark)
    total, n = rows.agg(F.sum(F.coalesce(F.col(length_col), F.lit(1 << 20))), F.count(F.lit(1))).first()
    read = bodies(path_col)

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            yield from read(batch)

    schema = T.StructType([*rows.schema.fields, T.StructField("content", T.BinaryType())])
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil((total or 0) / TASK_BYTES), math.ceil(n / TASK_FILES))
    return rows.repartition(tasks).mapInArrow(run, schema)

