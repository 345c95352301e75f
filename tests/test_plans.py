"""The four programs end to end, on files and tables."""

import functools
import json
import os

from pyspark.sql import functions as F

from sftprep_checks.stub_client import make_client
from sftprep.functions import chat as C
from sftprep.operators.generate import generate_replies
from sftprep.operators.resume import pairs_per_chunk
from sftprep.plans.calibration import calibration_set
from sftprep.plans.chat_dataset import prepare_chat_dataset
from sftprep.plans.qa import run_generation
from sftprep.plans.vlm_dataset import create_vendor_dataset, prepare_vlm_dataset
from sftprep.functions.prompts import user_message
from sftprep.sources.files import read_pairs_or_empty, read_training_json
from sftprep.sources.tables import read_table

from conftest import SF001

PNG = bytes.fromhex("89504E470D0A1A0A") + b"img"


def _docs(spark, names):
    texts = {"a.txt": "Alpha beta. " * 12, "b.md": "Gamma, delta. " * 10, "c.txt": "epsilon " * 5}
    return spark.createDataFrame([(n, texts[n]) for n in names], "name string, text string").withColumn(
        "source", F.regexp_replace("name", "\\.", "_"))


def test_run_generation_resumes_from_sink(spark, tmp_path):
    pairs_dir, train = str(tmp_path / "pairs"), str(tmp_path / "train")
    first = run_generation(_docs(spark, ["a.txt"]), make_client, pairs_dir, chunk_size=64, overlap=16)
    n_a = first.new_pairs.count()
    assert n_a > 0
    second = run_generation(_docs(spark, ["a.txt", "b.md", "c.txt"]), make_client, pairs_dir, train_path=train,
                            chunk_size=64, overlap=16)
    assert second.new_pairs.filter(F.col("source") == "a_txt").count() == 0  # all of a skipped
    merged = read_pairs_or_empty(spark, pairs_dir)
    per_source = {r.source: r["count"] for r in merged.groupBy("source").count().collect()}
    assert per_source["a_txt"] == n_a and set(per_source) == {"a_txt", "b_md", "c_txt"}
    assert pairs_per_chunk(merged).filter(F.col("n_pairs") < 2).count() == 0
    assert read_training_json(spark, train).count() == merged.count()


def test_chat_dataset(spark):
    recs = spark.createDataFrame([(i, f"do {i}", "" if i % 2 else "ctx", f"ans {i}") for i in range(6)],
                                 "id int, instruction string, input string, output string")
    out = {r.id: r for r in prepare_chat_dataset(recs, id_col="id").collect()}
    assert out[1].text == C.CHAT_TEMPLATE.replace("{INPUT}", "do 1").replace("{OUTPUT}", "ans 1")
    assert out[0].conversations[0].content == "do 0\nYour input is:\nctx"
    ext = prepare_chat_dataset(recs, id_col="id", conversation_extension=2, system_prompt="SYS").collect()
    assert all(len(r.conversations) == 4 and r.text.startswith("SYS\n\n") for r in ext)


def test_vlm_dataset(spark, tmp_path):
    (tmp_path / "x.png").write_bytes(PNG)
    (tmp_path / "y.png").write_bytes(b"junk")
    rows = [{"file_name": "x.png", "text": "an x"}, {"file_name": "y.png", "text": "a y"},
            {"file_name": "z.png", "text": "absent"}]
    man = tmp_path / "train_data.jsonl"
    man.write_text("\n".join(json.dumps(r) for r in rows), encoding="utf-8")
    conv, bad = prepare_vlm_dataset(spark, str(man))
    got = conv.collect()
    assert len(got) == 1 and got[0].text == "an x"
    assert got[0].messages[0].content[0].text == "Describe the image in detail."
    assert [r.file_name for r in bad.collect()] == ["y.png"]
    assert os.path.isdir(tmp_path / "converted_dataset")


def test_vendor_dataset_in_line_order(spark, tmp_path):
    img = tmp_path / "image"
    img.mkdir()
    for n in ("1.jpg", "2.jpg", "3.jpg"):
        (img / n).write_bytes(bytes.fromhex("FFD8FFE0") + n.encode())
    lines = [("1.jpg", "q1", "a1"), ("2.jpg", "q2", "a2"), ("1.jpg", "q1", "a1"), ("9.jpg", "q9", "a9"),
             ("3.jpg", None, "a3"), ("3.jpg", "q3", "a3b")]
    (tmp_path / "metadata.jsonl").write_text("\n".join(
        json.dumps({k: v for k, v in {"file_name": f, "instruction": q, "text": a}.items() if v is not None})
        for f, q, a in lines), encoding="utf-8")
    shards, bad = create_vendor_dataset(spark, str(tmp_path), num_shards=3)
    assert sorted((r.shard, r.n_rows) for r in shards.collect()) == [(0, 2), (1, 2), (2, 0)]
    assert sorted(os.listdir(tmp_path / "data")) == [f"train-0000{i}-of-00003.parquet" for i in range(3)]
    named = spark.read.parquet(str(tmp_path / "data")).withColumn("shard_file", F.element_at(F.split(F.input_file_name(), "/"), -1))
    data = named.orderBy("shard_file", "question").collect()
    assert "row_idx" not in data[0].asDict() and [r.question for r in data] == ["q1", "q2", "q1", "q3"]
    assert data[0].shard_file == "train-00000-of-00003.parquet" and data[0].image.bytes[:2] == b"\xff\xd8"
    assert bad.count() == 0


def test_calibration_set(spark):
    conv = read_table(spark, SF001, "conversations")
    toks = calibration_set(conv, num_samples=5, max_tokens=7)
    rows = toks.collect()
    assert toks.columns == ["tokens"] and len(rows) == 5 and all(0 < len(r.tokens) <= 7 for r in rows)


def counting_factory(marker):
    with open(os.path.join(marker, f"{os.getpid()}-{os.urandom(4).hex()}"), "w") as f:
        f.write("x")
    return make_client()


def test_client_built_once_per_worker(spark, tmp_path):
    marker = tmp_path / "calls"
    marker.mkdir()
    df = spark.range(0, 400).repartition(8).select(
        F.col("id"), user_message(F.col("id").cast("string")).alias("messages"))
    factory = functools.partial(counting_factory, str(marker))
    for _ in range(2):
        generate_replies(df, factory, carry=["id"]).count()
    pids = [n.split("-")[0] for n in os.listdir(marker)]
    assert len(pids) == len(set(pids))  # at most one build per worker process


def bracket_renderer():
    return lambda msgs: "".join(f"<{m['role']}>{m['content']}</{m['role']}>" for m in msgs)


def test_calibration_with_model_template(spark):
    conv = read_table(spark, SF001, "conversations")
    toks = calibration_set(conv, num_samples=4, max_tokens=5, renderer_factory=bracket_renderer).collect()
    assert len(toks) == 4 and all(r.tokens[0].startswith("<") for r in toks)
