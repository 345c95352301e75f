"""S1–S12 on real files: scans, filters, image join/validation, sinks, shards."""

import json
import os

import pytest
from pyspark.sql import functions as F

from sftprep.operators import vlm as V
from sftprep.operators.ranking import assign_shards
from sftprep.sources import files as S
from sftprep.sources import sinks as K


def test_source_id_and_extension(spark):
    df = spark.createDataFrame([("a.b.txt",), ("X.PDF",), ("note.TXT",), ("x.html",), ("pdf",), ("noext",)], "n string")
    rows = df.select("n", S.source_id(F.col("n")).alias("s"), S.has_document_extension(F.col("n")).alias("k")).collect()
    got = {r.n: (r.s, r.k) for r in rows}
    assert got["a.b.txt"] == ("a_b_txt", True)
    assert [got[n][1] for n in ("X.PDF", "note.TXT", "x.html", "pdf", "noext")] == [True, True, False, True, False]


def test_source_collisions(spark):
    df = spark.createDataFrame([("a.b.txt",), ("a_b.txt",), ("c.txt",)], "name string")
    assert [r.source for r in S.source_collisions(df).collect()] == ["a_b_txt"]


def test_scan_documents_directory(spark, tmp_path):
    (tmp_path / "a.txt").write_text("héllo", encoding="utf-8")
    (tmp_path / "B.MD").write_text("# title", encoding="utf-8")
    (tmp_path / "c.html").write_text("<p>", encoding="utf-8")
    (tmp_path / "noext").write_text("x", encoding="utf-8")
    (tmp_path / "d.pdf").write_bytes(b"%PDF-1.4")
    (tmp_path / "sp ace+plus.txt").write_text("ok", encoding="utf-8")
    sub = tmp_path / "sub"
    sub.mkdir()
    (sub / "e.txt").write_text("nested", encoding="utf-8")
    rows = {r.name: r for r in S.scan_documents(spark, str(tmp_path)).collect()}
    assert set(rows) == {"a.txt", "B.MD", "d.pdf", "sp ace+plus.txt"}
    assert rows["sp ace+plus.txt"].source == "sp ace+plus_txt"  # names are not URL-encoded
    assert rows["a.txt"].text == "héllo" and rows["a.txt"].source == "a_txt"
    assert rows["d.pdf"].text is None  # needs a codec
    single = S.scan_documents(spark, str(tmp_path / "c.html")).collect()
    assert [r.name for r in single] == ["c.html"]


def test_scan_documents_empty_is_error(spark, tmp_path):
    (tmp_path / "x.html").write_text("no", encoding="utf-8")
    with pytest.raises(ValueError, match="No valid documents"):
        S.scan_documents(spark, str(tmp_path))


def test_load_chunks(spark, tmp_path):
    (tmp_path / "t.txt").write_text("abcdefghij", encoding="utf-8")
    rows = S.load_chunks(spark, str(tmp_path), chunk_size=4, overlap=1).orderBy("chunk_id").collect()
    assert [r.chunk for r in rows] == ["abcd", "defg", "ghij", "j"]


def test_training_json_array_and_lines(spark, tmp_path):
    recs = [{"instruction": "i1", "input": "", "output": "o1"}, {"instruction": "i2", "input": "x", "output": "o2"}]
    arr = tmp_path / "a.json"
    arr.write_text(json.dumps(recs, ensure_ascii=False, indent=4), encoding="utf-8")
    lines = tmp_path / "l.jsonl"
    lines.write_text("\n".join(json.dumps(r) for r in recs), encoding="utf-8")
    for p in (arr, lines):
        got = sorted(tuple(r) for r in S.read_training_json(spark, str(p)).collect())
        assert got == [("i1", "", "o1"), ("i2", "x", "o2")]


def test_manifest_malformed_line_fails(spark, tmp_path):
    p = tmp_path / "m.jsonl"
    p.write_text('{"file_name": "a.png", "text": "t"}\n{not json\n', encoding="utf-8")
    with pytest.raises(Exception):
        S.read_manifest(spark, str(p)).collect()


PNG = bytes.fromhex("89504E470D0A1A0A") + b"rest"
JPG = bytes.fromhex("FFD8FFE0") + b"rest"


def test_images_join_validate_and_project(spark, tmp_path):
    img = tmp_path / "image"
    img.mkdir()
    (img / "a.png").write_bytes(PNG)
    (img / "b.jpg").write_bytes(JPG)
    (img / "c.png").write_bytes(b"not an image")
    man = tmp_path / "metadata.jsonl"
    rows = [{"file_name": "a.png", "instruction": "Q?", "text": "A"},
            {"file_name": "a.png", "instruction": "Q?", "text": "A"},
            {"file_name": "b.jpg", "text": "B"},
            {"file_name": "c.png", "instruction": "Q3", "text": "C"},
            {"file_name": "missing.png", "instruction": "Q", "text": "M"}]
    man.write_text("\n".join(json.dumps(r) for r in rows), encoding="utf-8")
    manifest = S.read_manifest(spark, str(man))
    images = S.scan_images(spark, str(img))
    joined = V.join_images(manifest, images)
    assert joined.count() == 4  # repeats kept, missing dropped
    good, bad = V.split_valid_images(joined)
    assert sorted(r.file_name for r in good.collect()) == ["a.png", "a.png", "b.jpg"]
    assert [r.file_name for r in bad.collect()] == ["c.png"]
    assert {r.image_format for r in good.collect()} == {"png", "jpeg"}
    uns = V.image_text_rows(good).first()
    assert uns.image.bytes[:4] == PNG[:4] or uns.image.bytes[:3] == JPG[:3]
    conv = V.vlm_conversation(good).filter(F.col("file_name") == "b.jpg").first().messages
    assert conv[0].content[0].type == "text" and conv[0].content[0].text is None  # column exists, value null
    assert conv[0].content[1].type == "image" and conv[1].content[0].text == "B"
    no_col = V.vlm_conversation(V.image_text_rows(good)).first().messages
    assert no_col[0].content[0].text == V.DEFAULT_VLM_INSTRUCTION
    vend, errs = V.vendor_rows(joined)
    assert sorted(r.question for r in vend.collect()) == ["Q3", "Q?", "Q?"]
    assert errs.count() == 0
    keyed = V.keyed_qa(vend, exp_type="inference")
    assert "assistant" not in keyed.columns and "label" in keyed.columns


def test_image_format_signatures(spark):
    sigs = {"png": PNG, "jpeg": JPG, "gif": b"GIF89a..", "bmp": b"BM....", "tiff": b"II*\x00..",
            "webp": b"RIFF\x00\x00\x00\x00WEBPVP8 ", None: b"RIFF\x00\x00\x00\x00AVI "}
    df = spark.createDataFrame([(k, v) for k, v in sigs.items()], "k string, b binary")
    for r in df.select("k", V.image_format(F.col("b")).alias("f")).collect():
        assert r.k == r.f


def test_pairs_sink_and_resume_scan(spark, tmp_path):
    out = str(tmp_path / "pairs")
    empty = S.read_pairs_or_empty(spark, out)
    assert empty.count() == 0 and empty.columns == ["question", "answer", "source", "chunk_id", "chunk"]
    df = spark.createDataFrame([("q", "a", "s1", 0, "c"), ("q2", "a2", "s2", 1, "c2")], S.QA_PAIR_SCHEMA)
    K.append_pairs(df, out)
    K.append_pairs(df.limit(1), out)
    back = S.read_pairs_or_empty(spark, out)
    assert back.count() == 3 and {"source=s1", "source=s2"} <= set(os.listdir(out))


def test_training_json_sink_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([("问", "", "答")], "instruction string, input string, output string")
    p = str(tmp_path / "train")
    K.write_training_json(df, p)
    txt = "".join(open(os.path.join(p, f), encoding="utf-8").read() for f in os.listdir(p) if f.endswith(".json"))
    assert "问" in txt
    assert [tuple(r) for r in S.read_training_json(spark, p).collect()] == [("问", "", "答")]


def test_save_and_reload(spark, tmp_path):
    df = spark.range(5)
    assert K.save_and_reload(df, str(tmp_path / "conv")).count() == 5


@pytest.mark.parametrize("n,num,sizes", [(5, 4, [2, 2, 1, 0]), (4, 3, [2, 2, 0]), (0, 2, [0, 0])])
def test_shard_sizes(spark, tmp_path, n, num, sizes):
    df = spark.range(n).withColumnRenamed("id", "k")
    man = K.write_sharded_parquet(df, str(tmp_path / "data"), "train", num, ["k"])
    got = sorted((r.shard, r.file_name, r.n_rows) for r in man.collect())
    assert [g[2] for g in got] == sizes
    assert got[0][1] == f"train-00000-of-{num:05d}.parquet"
    for _, fname, _ in got:  # every shard, empty ones included, has its folder
        assert os.path.isdir(tmp_path / "data" / f"shard_file={fname}")
    if n:
        back = spark.read.parquet(str(tmp_path / "data"))
        firsts = back.groupBy("shard_file").agg(F.min("k").alias("lo"), F.max("k").alias("hi")).collect()
        size = -(-n // num)
        for r in firsts:
            i = int(r.shard_file.split("-")[1])
            assert (r.lo, r.hi) == (i * size, min((i + 1) * size, n) - 1)


def test_assign_shards_contiguous(spark):
    df = spark.range(23).select((F.col("id") * 7 % 23).alias("k"))
    sharded, n = assign_shards(df, ["k"], 4)
    assert n == 23
    rows = sorted((r.k, r.row_idx, r.shard) for r in sharded.collect())
    assert [r[1] for r in rows] == list(range(23))
    assert [r[2] for r in rows] == [i // 6 for i in range(23)]


def test_load_training_dataset_by_name_or_path(spark, tmp_path):
    p = tmp_path / "t.jsonl"
    p.write_text('{"instruction": "i", "input": "", "output": "o"}\n', encoding="utf-8")
    assert S.load_training_dataset(spark, dataset_path=str(p)).count() == 1
    spark.createDataFrame([("i", "", "o")], S.TRAINING_SCHEMA).createOrReplaceTempView("train_tbl")
    assert S.load_training_dataset(spark, dataset_name="train_tbl").count() == 1
    with pytest.raises(ValueError):
        S.load_training_dataset(spark)


def test_rows_with_image_reads_no_bytes(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(PNG)
    man = spark.createDataFrame([("a.png", "x"), ("b.png", "y"), ("a.png", "z")], "file_name string, text string")
    out = V.rows_with_image(man, S.scan_images(spark, str(tmp_path)))
    assert sorted(r.text for r in out.collect()) == ["x", "z"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    scan = next(ln for ln in plan.splitlines() if "FileScan binaryFile" in ln)
    assert "ReadSchema: struct<path:string>" in scan  # file bodies are never read


def test_referenced_images_reads_only_named_files(spark, tmp_path):
    img = tmp_path / "image"
    img.mkdir()
    (img / "a.png").write_bytes(PNG)
    (img / "unused.png").write_bytes(b"never read")
    man = spark.createDataFrame([("a.png", "x"), ("a.png", "y"), ("gone.png", "z")], "file_name string, text string")
    listing = S.scan_images(spark, str(img))
    refs = V.referenced_images(man, listing)
    got = refs.collect()
    assert [(r.rel_path, bytes(r.content)) for r in got] == [("a.png", PNG)]
    plan = refs._jdf.queryExecution().executedPlan().toString()
    scan = next(ln for ln in plan.splitlines() if "FileScan binaryFile" in ln)
    assert "content" not in scan.split("ReadSchema")[1]
    joined = V.join_images(man, refs)
    assert sorted(r.text for r in joined.collect()) == ["x", "y"]


def test_scan_documents_repairs_invalid_utf8(spark, tmp_path):
    (tmp_path / "latin.txt").write_bytes(b"caf\xe9 au lait")
    (tmp_path / "ok.txt").write_text("café", encoding="utf-8")
    rows = {r.name: r for r in S.scan_documents(spark, str(tmp_path)).collect()}
    assert rows["latin.txt"].text == b"caf\xe9 au lait".decode("utf-8", "replace")
    assert rows["latin.txt"].valid_utf8 is False and rows["ok.txt"].valid_utf8 is True
    assert rows["ok.txt"].text == "café"


def test_manifest_quarantine_keeps_bad_lines(spark, tmp_path):
    p = tmp_path / "m.jsonl"
    p.write_text('{"file_name": "a.png", "text": "t"}\n{not json\n{"file_name": "b.png", "text": "u"}\n',
                 encoding="utf-8")
    df = S.read_manifest(spark, str(p), quarantine=True).cache()
    good = df.filter(F.col("_corrupt_record").isNull())
    bad = df.filter(F.col("_corrupt_record").isNotNull())
    assert sorted(r.file_name for r in good.collect()) == ["a.png", "b.png"]
    assert [r._corrupt_record for r in bad.collect()] == ["{not json"]


def test_pair_sink_file_count_is_bounded(spark, tmp_path):
    rows = [("q", "a", f"s{i % 3}", i, "c") for i in range(600)]
    df = spark.createDataFrame(rows, S.QA_PAIR_SCHEMA).repartition(8)  # every task holds every source
    out = tmp_path / "pairs"
    K.append_pairs(df, str(out), fmt="parquet")
    files = [f for d in os.listdir(out) if d.startswith("source=")
             for f in os.listdir(out / d) if f.endswith(".parquet")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(files) <= parts + 3  # not 8 tasks x 3 sources
    assert S.read_pairs_or_empty(spark, str(out), "parquet").count() == 600


def test_keyed_qa_custom_keys_and_template(spark):
    df = spark.createDataFrame([("What?", "That.", "img.png")], "q string, a string, p string").select(
        "q", "a", F.struct(F.lit(b"x").alias("bytes"), F.col("p").alias("path")).alias("pic"))
    keys = {"question": "q", "answer": "a", "image": "pic", "label": "a"}
    row = V.keyed_qa(df, keys=keys, system_prompt="S", user_prompt="Q: {question}").first()
    assert (row.system, row.user, row.assistant, row.image.path) == ("S", "Q: What?", "That.", "img.png")
    with pytest.raises(ValueError):
        V.keyed_qa(df, keys=keys, exp_type="eval")
