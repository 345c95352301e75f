"""F1 of round 4: saved requests hold a chunk's text once, and no shuffle carries it."""

import os
import random
import re

import pytest
from pyspark.sql import functions as F

from sftprep.operators.generate import generate_replies, request_id, short_id
from sftprep.plans import qa
from sftprep.plans.qa import (
    offline_answer_requests, offline_pairs, offline_question_requests, save_answer_requests, save_question_requests,
)
from sftprep.sources import saved_rows
from sftprep.sources.saved_rows import dealt_by_place, fetch, place, save_rows
from sftprep_checks.stub_client import make_client


def _same(a, b):
    assert a.columns == b.columns
    assert a.count() == b.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _bytes(folder):
    return sum(os.path.getsize(os.path.join(r, f)) for r, _, fs in os.walk(folder) for f in fs)


@pytest.mark.parametrize("by_place", [True, False])
def test_saved_requests_give_the_same_rows(spark, monkeypatch, by_place):
    monkeypatch.setattr(qa, "can_fetch", lambda _: by_place)
    long = " ".join(f"wörd{i}, 中文。" for i in range(900))
    docs = spark.createDataFrame(
        [("a", long), ("a", long), ("a", long[5:]), ("b", ""), ("c", None), ("d", "{question} and {context}")], "source string, text string")
    asked = offline_question_requests(docs, chunk_size=64, overlap=16, generate_num=3)
    qreq = save_question_requests(asked, 3)
    assert qreq.by_place is by_place
    _same(qreq.requests, asked)
    # a service that answers twice, once with nothing, and leaves out some requests
    some = generate_replies(qreq.requests, make_client, carry=["request_id"]).filter("substring(request_id, 1, 1) > '2'")
    qrep = save_rows(some.unionByName(some).unionByName(some.withColumn("response", F.lit(None).cast("string"))), "q")
    plain = offline_answer_requests(asked, qrep)
    areq = save_answer_requests(offline_answer_requests(qreq, qrep), qreq)
    _same(areq.requests, plain)
    arep = save_rows(generate_replies(areq.requests, make_client, carry=["request_id"]), "a")
    pairs = offline_pairs(plain, arep)
    assert pairs.count() > 1_000
    _same(offline_pairs(areq, arep), pairs)


def test_no_shuffle_carries_the_chunks(spark, tmp_path):
    """Before: request rows with the text two to six times were checkpointed and shuffled."""
    from sftprep_checks import queries as Q

    rnd = random.Random(4)
    text = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyzäöü ,", k=6_000)) for _ in range(200)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(text)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    root = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    before, limit = _bytes(root), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = Q.qa_generation_offline(spark, str(tmp_path))
        assert _bytes(root) - before < 2 * sum(len(t.encode()) for t in text)
        plan = pairs._sc._jvm.PythonSQLUtils.explainString(pairs._jdf.queryExecution(), "formatted")
        shuffled = re.findall(r"^\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", plan, re.M)
        assert shuffled and not [cols for cols in shuffled if re.search(r"\bchunk#", cols)]
        chunks = Q.chunk_text(spark, str(tmp_path)).select("chunk").distinct()
        assert pairs.select("chunk").distinct().exceptAll(chunks).count() == 0 and chunks.count() == pairs.select("chunk").distinct().count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_fetch_reads_any_order(spark):
    rnd = random.Random(1)
    rows = [(i, "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=900)) if i % 7 else None) for i in range(9_000)]
    saved = save_rows(spark.createDataFrame(rows, "id int, text string").repartition(2, "id"), "rows")
    ids = saved.select(F.col("id").alias("want"), place().alias("at"))
    want = ids.unionByName(ids.filter("want % 5 = 0")).orderBy(F.xxhash64("want")).coalesce(1)
    columns = saved.select("text", "id").schema
    text, places = dict(rows), want.count()
    for asked, n in ((want.limit(200), 200), (dealt_by_place(want, "at"), places), (dealt_by_place(want, "at", 3), places), (want.limit(0), 0)):
        got = fetch(asked, columns, "at")
        assert got.columns == ["text", "id", "want", "at"]
        found = got.drop("at").collect()
        assert len(found) == n and all(r.id == r.want and r.text == text[r.id] for r in found)
        assert n != places or len({r.id for r in found}) == 9_000


def test_fetch_from_odd_folder_names(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(saved_rows, "scratch_path", lambda _, name: str(tmp_path / "a b%20ü#c" / name))
    saved = save_rows(spark.createDataFrame([(1, "x"), (2, "y")], "id int, text string"), "rows")
    got = fetch(saved.select("id", place().alias("at")), saved.select("text").schema, "at")
    assert sorted((r.id, r.text) for r in got.collect()) == [(1, "x"), (2, "y")]


def test_short_ids_stay_different(spark):
    ids = ["ab" * 16, "AB" * 16, "aB" + "ab" * 15, "zz" * 16, "ab" * 8, "a" * 31, "a" * 33, "", "ü" * 16, "\0" * 17, None]
    df = spark.createDataFrame([(i,) for i in ids], "id string").withColumn("short", short_id(F.col("id")))
    short = {r.id: r.short and bytes(r.short) for r in df.collect()}
    assert short[None] is None and len(set(short.values())) == len(ids)
    assert short["ab" * 16] == bytes.fromhex("ab" * 16)
    assert spark.range(1).select(F.octet_length(short_id(request_id("id")))).first()[0] == 16
