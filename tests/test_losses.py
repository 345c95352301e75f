"""Inputs that once lost, replaced or repeated rows without an error."""

import json

import pytest
from pyspark.sql import functions as F

from sftprep.cli import main
from sftprep.functions.chat import PREAMBLE, render_chat, render_with
from sftprep.functions.tokens import subword_token_ids
from sftprep.operators.generate import dedupe_replies, generate_replies, unanswered
from sftprep.operators.ranking import extend_conversations
from sftprep.plans.qa import generate_qa_pairs
from sftprep.session import ensure_parallelism, factory_key
from sftprep.sources.files import read_pairs_or_empty, scan_documents, scan_images, unreadable_documents
from sftprep.sources.sinks import write_sharded_parquet
from sftprep.streaming.incremental import run_incremental


def client_named(name):
    def factory():
        return lambda batch, **_: [name] * len(batch)

    return factory


def tokenizer_numbered(n):
    def factory():
        return lambda text: [n] * len(text.split())

    return factory


def test_equal_records_stay_apart_in_extension(spark, tmp_path):
    rows = [{"instruction": "i", "input": "x", "output": "o"}] * 3 + [{"instruction": f"i{k}", "input": "", "output": "o"} for k in range(3)]
    (tmp_path / "in.json").write_text("\n".join(map(json.dumps, rows)), encoding="utf-8")
    main(["chat-dataset", "--input", str(tmp_path / "in.json"), "--output", str(tmp_path / "out"), "--extension", "2"], spark)
    out = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len(out) == 6 and {len(r.conversations) for r in out} == {4}


def test_extension_rejects_repeated_ids(spark):
    df = spark.createDataFrame([(1, ["a"]), (1, ["b"])], "id long, c array<string>")
    with pytest.raises(ValueError, match="not unique"):
        extend_conversations(df, "id", "c", 2)


def test_closures_of_one_function_keep_their_own_objects(spark):
    df = spark.createDataFrame([("a b",)], "t string").withColumn("messages", F.array(F.struct(F.lit("user").alias("role"), F.col("t").alias("content"))))
    for n, name in enumerate("ABCD"):
        assert generate_replies(df, client_named(name)).first().response == name
        assert df.select(subword_token_ids(F.col("t"), tokenizer_numbered(n)).alias("i")).first().i == [n, n]
        assert df.select(render_with(F.col("messages"), lambda name=name: lambda m: name).alias("r")).first().r == name
    assert factory_key(client_named("A")) == factory_key(client_named("A")) != factory_key(client_named("B"))


def test_sharded_sink_keeps_every_column(spark, tmp_path):
    df = spark.createDataFrame([(1, "x", 2, 5), (2, "y", 3, 6)], "id long, _label string, v int, shard int")
    write_sharded_parquet(df, str(tmp_path / "o"), "train", 2, ["id"])
    out = spark.read.parquet(str(tmp_path / "o")).orderBy("id")
    assert out.columns == ["id", "_label", "v", "shard", "shard_file"]
    assert [(r._label, r.shard) for r in out.collect()] == [("x", 5), ("y", 6)]


@pytest.mark.parametrize("form", ["{}", "file://{}", "file:{}", "{}/"])
def test_folder_spellings(spark, tmp_path, form):
    for name in ("a.txt", "_b.md", ".c.txt", "d.html"):
        (tmp_path / name).write_text(name, encoding="utf-8")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "e.txt").write_text("nested", encoding="utf-8")
    path = form.format(tmp_path)
    assert {r.name: r.text for r in scan_documents(spark, path).collect()} == {n: n for n in ("a.txt", "_b.md", ".c.txt")}
    images = {r.rel_path: bytes(r.content).decode() for r in scan_images(spark, path).collect()}
    assert images == {"a.txt": "a.txt", "_b.md": "_b.md", ".c.txt": ".c.txt", "d.html": "d.html", "sub/e.txt": "nested"}


def test_missing_folder_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        scan_documents(spark, str(tmp_path / "none"))


def test_stream_sink_keeps_rows_of_another_checkpoint(spark, tmp_path):
    for k in (0, 1):
        spark.createDataFrame([(k, f"text {k}")], "doc_id long, text string").write.parquet(str(tmp_path / f"in{k}"))
        run_incremental(spark, str(tmp_path / f"in{k}"), spark.read.parquet(str(tmp_path / "in0")).schema, str(tmp_path / "sink"), str(tmp_path / f"cp{k}"))
    assert sorted(r.doc_id for r in spark.read.parquet(str(tmp_path / "sink")).collect()) == [0, 1]


def test_null_replies_answer_nothing(spark):
    requests = spark.createDataFrame([("a",), ("b",), ("c",)], "request_id string")
    replies = spark.createDataFrame([("a", None), ("a", "z"), ("a", "y"), ("b", None)], "request_id string, response string")
    assert [tuple(r) for r in dedupe_replies(replies).collect()] == [("a", "y")]
    assert sorted(r.request_id for r in unanswered(requests, replies).collect()) == ["b", "c"]


def test_documents_without_text_are_reported(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF")
    docs = scan_documents(spark, str(tmp_path))
    assert unreadable_documents(docs).count() == 1
    res = generate_qa_pairs(docs, client_named("x"), checkpoint=False)
    assert [(r.stage, r.source) for r in res.errors.collect()] == [("document", "a_pdf")]
    with pytest.raises(SystemExit, match="no text reader"):
        main(["generate", "--input", str(tmp_path), "--output", str(tmp_path / "o"), "--base-url", "http://127.0.0.1:1", "--model", "m"], spark)


def test_broken_pair_line_is_an_error(spark, tmp_path):
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "x.json").write_text('{"question": "q"}\n{broken\n', encoding="utf-8")
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILFAST"):
        read_pairs_or_empty(spark, str(tmp_path / "p")).collect()
    assert read_pairs_or_empty(spark, str(tmp_path / "none")).count() == 0


def test_empty_system_prompt_keeps_the_preamble(spark):
    m = F.array(F.struct(F.lit("user").alias("role"), F.lit("hi").alias("content")))
    one = spark.range(1)
    texts = [one.select(render_chat(m, p).alias("t")).first().t for p in ("", None, F.lit(""), "P")]
    assert texts[0] == texts[1] == texts[2] and texts[0].startswith(PREAMBLE) and texts[3].startswith("P")


def test_planning_runs_no_job(spark):
    sc = spark.sparkContext
    sc.setJobGroup("planning", "no job may run")
    try:
        df = spark.range(100).groupBy((F.col("id") % 3).alias("k")).count()
        assert ensure_parallelism(df, 64) is df
        assert not sc.statusTracker().getJobIdsForGroup("planning")
    finally:
        sc._jsc.clearJobGroup()
