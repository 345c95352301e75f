"""Images keys first: paths as a manifest spells them, headers by range, bodies last, exact shard files."""

import os
import struct

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sftprep.operators import images as I
from sftprep.plans.vlm_dataset import prepare_vlm_dataset
from sftprep.sources import sinks as K
from sftprep.sources.files import list_images
from sftprep.sources.listing import located_path

PNG = bytes.fromhex("89504E470D0A1A0A") + b"p" * 500


def box(kind, body):
    return struct.pack(">I", 8 + len(body)) + kind + body


SAMPLES = {
    "a.png": (PNG, "png"), "b.webp": (b"RIFF\x10\0\0\0WEBPVP8 " + b"x" * 20, "webp"), "c.wav": (b"RIFF\x10\0\0\0WAVEfmt " + b"x" * 20, None),
    "d.avif": (box(b"ftyp", b"avif\0\0\0\0mif1avifmiaf") + b"y" * 99, "avif"), "e.heic": (box(b"ftyp", b"xxxx\0\0\0\0heic") + b"y" * 99, "heif"),
    "f.mp4": (box(b"ftyp", b"isom\0\0\0\0mp42") + b"y" * 99, None), "g.heic": (box(b"free", b"\0" * 300) + box(b"ftyp", b"heix\0\0\0\0mif1") + b"z" * 99, "heif"),
    "h.ppm": (b"P6\n1 1\n255\nabc", "pnm"), "i.txt": (b"P6 is no picture"[:2], None), "j.jpg": (b"\xff\xd8\xff\xe0" + b"j" * 50, "jpeg"),
    "k.ico": (b"\0\0\1\0" + b"i" * 40, "ico"), "l.emf": (b"\1\0\0\0" + b"e" * 36 + b" EMF", "emf"), "m.empty": (b"", None), "n.jp2": (bytes.fromhex("0000000C6A5020200D0A870A") + b"q" * 9, "jpeg2000"),
    "o.tif": (b"MM\0\x2b" + b"t" * 30, "tiff"), "p.junk": (b"\0\0\0\x09free\0" + b"\0" * 40, None), "q.avif": (box(b"ftyp", b"isom\0\0\0\0" + b"none" * 30 + b"avis"), "avif"),
}


def test_formats(spark):
    for name, (content, want) in SAMPLES.items():
        reads = []

        def read(at, n, content=content, reads=reads):
            reads.append(n)
            return content[at : at + n]

        assert I.sniff(read) == want, name
        assert reads[0] == I.HEAD and sum(reads) <= I.HEAD * I.MAX_BOXES + 4096
    df = spark.createDataFrame([(n, c, w) for n, (c, w) in SAMPLES.items()], "name string, content binary, want string")
    got = {r.name: r.f for r in df.select("name", I.detected_format(F.col("content")).alias("f")).collect()}
    later = {"g.heic", "q.avif"}  # a column sees the first HEAD bytes only
    assert {n: f for n, f in got.items() if n not in later} == {n: w for n, (_, w) in SAMPLES.items() if n not in later}


def test_own_signatures():
    table = (I.Signature("mine", ((2, "4142"),)),)
    assert I.sniff(lambda at, n: b"..AB"[at : at + n], table, {}) == "mine" and I.sniff(lambda at, n: PNG[at : at + n], table, {}) is None


@pytest.mark.parametrize(
    "name, want",
    [("./x.png", "x.png"), ("a//b/../x.png", "a/x.png"), ("/root/img/a/x.png", "a/x.png"), ("file:///root/img/x.png", "x.png"), ("file:/root/img/./x.png", "x.png"),
     ("../../x.png", "x.png"), ("/else/x.png", "/else/x.png"), ("s3://b/k/../x.png", "s3://b/x.png"), ("/root/image/x.png", "/root/image/x.png"), (None, None), ("", "")],
)
def test_names(spark, name, want):
    df = spark.createDataFrame([(name,)], "n string").select(I.normal_name(F.col("n"), "file:/root/img").alias("n"))
    assert df.first().n == want


@pytest.fixture()
def folder(tmp_path):
    images = tmp_path / "images"
    (images / "sub").mkdir(parents=True)
    for name, (content, _) in SAMPLES.items():
        (images / "sub" / name).write_bytes(content)
    (tmp_path / "outside.png").write_bytes(PNG)
    return images


def test_only_headers_of_rejected_files_are_read(spark, folder, monkeypatch):
    root, _ = located_path(spark, str(folder))
    rows = [(i, f"./sub/{n}", "t") for i, n in enumerate(SAMPLES)] + [(90, f"{folder}/sub/a.png", "t"), (91, f"{folder.parent}/outside.png", "t"), (92, f"{folder.parent}/absent.png", "t"), (93, "sub/absent.png", "t"), (94, None, "t")]
    manifest = spark.createDataFrame(rows, "id int, file_name string, text string")
    listing = list_images(spark, str(folder))
    located = I.locate_images(manifest, listing, root=root)
    assert "content" not in located._jdf.queryExecution().executedPlan().toString()
    good, bad = I.split_by_format(located, I.read_formats(located, partitions=2))
    want = {i for i, (_, f) in enumerate(SAMPLES.values()) if f} | {90, 91}
    assert {r.id for r in good.collect()} == want
    assert {r.id for r in bad.collect()} == {i for i, (_, f) in enumerate(SAMPLES.values()) if not f}
    full = I.with_content(good)
    plan = full._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("MapInArrow") + 1 :]
    assert "content" not in below.split("\n", 1)[1]  # what is joined and dealt holds no bytes
    held = {r.id: bytes(r.content) for r in full.collect()}
    assert held[0] == held[90] == held[91] == PNG and held[9] == SAMPLES["j.jpg"][0]


def test_dataset_with_rejects(spark, folder, tmp_path):
    lines = [f'{{"file_name": "sub/{n}", "text": "about {n}"}}' for n in SAMPLES] + ['{"file_name": "sub/none.png", "text": "x"}']
    (folder / "train_data.jsonl").write_text("\n".join(lines))
    conv, bad = prepare_vlm_dataset(spark, str(folder / "train_data.jsonl"), save_path=str(tmp_path / "converted"))
    assert {r.text for r in conv.collect()} == {f"about {n}" for n, (_, f) in SAMPLES.items() if f}
    assert {r.file_name for r in bad.collect()} == {f"sub/{n}" for n, (_, f) in SAMPLES.items() if not f}
    assert "content" not in bad.columns


@pytest.mark.parametrize("n, shards", [(10, 4), (3, 5), (0, 2), (1000, 3)])
def test_exact_shard_files(spark, tmp_path, n, shards):
    out = tmp_path / "data"
    df = spark.range(n).select((n - F.col("id")).alias("k"), F.col("id").alias("_label"), F.col("id").alias("drop_me"), F.col("id").alias("shard"))
    K.write_shard_files(df, str(out), "train", shards + 1, ["k"])
    manifest = K.write_shard_files(df, str(out), "train", shards, ["k"], drop=("drop_me",))
    names = [f"train-{i:05d}-of-{shards:05d}.parquet" for i in range(shards)]
    assert sorted(os.listdir(out)) == names  # no staging folder and no older file is left
    held = [pq.read_table(out / f) for f in names]
    assert {r.file_name: r.n_rows for r in manifest.collect()} == {f: t.num_rows for f, t in zip(names, held)}
    assert all(t.column_names == ["k", "_label", "shard"] for t in held)
    size = -(-n // shards)
    assert [t.num_rows for t in held] == [max(0, min(size, n - i * size)) for i in range(shards)]
    assert [k for t in held for k in t["k"].to_pylist()] == list(range(1, n + 1))


def test_a_retried_task_leaves_one_file(spark, tmp_path):
    mark = str(tmp_path / "mark")

    def fails_once(batch):
        if len(batch):
            try:
                os.close(os.open(mark, os.O_CREAT | os.O_EXCL))
            except FileExistsError:
                yield batch
                return
            yield batch.slice(0, 1)
            raise RuntimeError("worker lost")
        yield batch

    df = spark.range(40).withColumnRenamed("id", "k")
    try:  # local mode does not retry: the whole write is run again, over what the first one left
        K.write_shard_files(df, str(tmp_path / "o"), "s", 2, ["k"], late=fails_once)
    except Exception:
        pass
    K.write_shard_files(df, str(tmp_path / "o"), "s", 2, ["k"], late=fails_once)
    parquet = sorted(f for f in os.listdir(tmp_path / "o") if f.endswith(".parquet"))
    assert parquet == ["s-00000-of-00002.parquet", "s-00001-of-00002.parquet"]
    assert sorted(k for f in parquet for k in pq.read_table(tmp_path / "o" / f)["k"].to_pylist()) == list(range(40))


def test_bodies_come_a_few_megabytes_at_a_time(tmp_path):
    """a task holds about READ_BYTES of file bodies, however many files a batch names."""
    import pyarrow as pa

    for i in range(30):
        (tmp_path / f"{i}.png").write_bytes(bytes([i]) * 1_000_000)
    batch = pa.RecordBatch.from_arrays([pa.array([f"{tmp_path}/{i}.png" for i in range(30)])], names=["p"])
    parts = list(I.bodies("p")(batch))
    assert max(p.nbytes for p in parts) < 6_000_000
    assert [c[0] for p in parts for c in p.column(1).to_pylist()] == list(range(30))


def test_many_small_files_are_dealt_to_more_tasks(spark):
    """tasks follow the number of files, not only their bytes."""
    listing = spark.range(40_001).select(F.concat(F.lit("/none/"), "id").alias("image_path"), F.lit(10).cast("long").alias("image_length"))
    assert I.with_content(listing).rdd.getNumPartitions() >= 9


def test_local_entries_equal_the_file_system(tmp_path):
    """a local folder is listed one entry at a time, with what pyarrow says of it."""
    from pyarrow import fs as pafs

    from sftprep.sources.listing import _entries

    for name in (".hidden", "_low", "empty", "sp ace+é.txt"):
        (tmp_path / name).write_bytes(b"x" * len(name) if name != "empty" else b"")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "deep").write_text("x")
    (tmp_path / "link").symlink_to(tmp_path / "_low")
    (tmp_path / "gone").symlink_to(tmp_path / "nothing")
    micro = lambda t: t and t.replace(microsecond=t.microsecond)
    want = {}
    for i in pafs.LocalFileSystem().get_file_info(pafs.FileSelector(str(tmp_path))):
        folder = i.type == pafs.FileType.Directory
        want["file:" + i.path] = (None if folder else i.size, micro(i.mtime), folder)
    found = _entries(f"file:{tmp_path}", False)
    got = {path: (size, modified, folder) for path, size, modified, folder in found}
    got.pop(f"file:{tmp_path}/gone", None), want.pop(f"file:{tmp_path}/gone", None)
    assert {k: (v[0], v[2]) for k, v in got.items()} == {k: (v[0], v[2]) for k, v in want.items()}
    assert all(abs((got[k][1] - want[k][1]).total_seconds()) < 1e-5 for k in got)


def test_files_written_by_many_tasks(spark, tmp_path, monkeypatch):
    """the files of a table are dealt to tasks by their number; every file is written whole."""
    from sftprep_checks import queries as Q

    monkeypatch.setattr(Q, "TASK_FILES", 7, raising=False)
    rows = spark.range(0, 100, 1, 1).select(F.concat(F.lit("s"), F.col("id") % 3, F.lit("/"), F.lit("d"), "id").alias("name"), F.repeat(F.lit("x"), F.col("id").cast("int")).cast("binary").alias("content"))
    Q.write_files(rows, f"file:{tmp_path}/out")
    assert {p.name: p.stat().st_size for p in (tmp_path / "out").rglob("d*")} == {f"d{i}": i for i in range(100)}
