"""U1 generation, J1 resume, X1/X2 merge, J2 offline replies, and the plan shape."""

from pyspark.sql import functions as F

from sftprep_checks.stub_client import answer_reply, make_client, question_reply
from sftprep.functions.prompts import user_message
from sftprep.operators.generate import attach_replies, dedupe_replies, generate_replies, request_id
from sftprep.operators.resume import merge_pairs, pairs_per_chunk, skip_done_chunks
from sftprep.plans.qa import generate_qa_pairs
from sftprep.sources.files import QA_PAIR_SCHEMA


def three_questions():
    """Replies with three questions to every question prompt."""
    from sftprep_checks.stub_client import StubClient, reply

    class Three(StubClient):
        def __call__(self, batch, **_):
            out = []
            for m in batch:
                r = reply(m)
                out.append("q1,q2,q3" if r.startswith("What does") else r)
            return out

    return Three()


def failing_client():
    def call(batch, **_):
        raise RuntimeError("provider down")
    return call


def none_client():
    return lambda batch, **_: [None for _ in batch]


def _prompts(spark):
    df = spark.createDataFrame([(1, "hello world"), (2, "second text")], "k int, t string")
    return df.select("k", request_id(F.col("k")).alias("request_id"), user_message(F.col("t")).alias("messages"))


def test_generate_replies_with_carry(spark):
    got = generate_replies(_prompts(spark), make_client, carry=["k", "request_id"]).orderBy("k").collect()
    assert [r.k for r in got] == [1, 2] and all(r.error is None for r in got)
    assert got[0].response == ""  # not a known prompt shape -> empty reply


def test_generate_errors_reported_per_row(spark):
    bad = generate_replies(_prompts(spark), failing_client, carry=["k"]).collect()
    assert all(r.response is None and "provider down" in r.error for r in bad)
    nul = generate_replies(_prompts(spark), none_client, carry=["k"]).collect()
    assert all(r.error == "empty reply" for r in nul)


def test_dedupe_and_attach(spark):
    p = _prompts(spark)
    replies = spark.createDataFrame(
        [(r.request_id, "x") for r in p.collect()] * 2, "request_id string, response string")
    d = dedupe_replies(replies)
    assert d.count() == 2
    assert attach_replies(p, d).count() == 2


def _docs(spark):
    return spark.createDataFrame(
        [("a.txt", "One sentence here. " * 8), ("b.txt", "Short doc, with comma."), ("c.txt", "x" * 50)],
        "name string, text string",
    ).withColumn("source", F.regexp_replace("name", "\\.", "_"))


def test_generation_end_to_end(spark):
    res = generate_qa_pairs(_docs(spark), make_client, chunk_size=64, overlap=16, generate_num=2)
    pairs = res.pairs.collect()
    assert res.errors.count() == 0
    for p in pairs:
        assert p.answer == answer_reply(p.chunk, p.question)
    # questions come from splitting the stub reply on commas
    by_chunk = {}
    for p in pairs:
        by_chunk.setdefault((p.source, p.chunk_id), []).append((p.question_no, p.question))
    for (src, cid), qs in by_chunk.items():
        chunk = next(p.chunk for p in pairs if p.source == src and p.chunk_id == cid)
        assert [q for _, q in sorted(qs)] == question_reply(chunk).split(",")


def test_resume_partial_and_done(spark):
    docs = _docs(spark)
    existing = spark.createDataFrame(
        [("e", "e", "a_txt", 0, "c"), ("e", "e", "a_txt", 0, "c"),  # chunk 0 done (2 pairs)
         ("e", "e", "a_txt", 1, "c")],  # chunk 1 partly done (1 pair)
        QA_PAIR_SCHEMA,
    )
    res = generate_qa_pairs(docs, three_questions, chunk_size=64, overlap=16, generate_num=2, existing=existing)
    counts = {(r.source, r.chunk_id): r.n_pairs for r in pairs_per_chunk(res.pairs).collect()}
    assert counts[("a_txt", 0)] == 2  # skipped, stays 2
    assert counts[("a_txt", 1)] == 4  # 1 existing + 3 new
    assert counts[("c_txt", 0)] == 3  # none existing -> 3


def test_skip_done_both_join_paths(spark):
    chunks = spark.createDataFrame([("s", i) for i in range(5)], "source string, chunk_id int")
    pairs = spark.createDataFrame([("s", 1), ("s", 1), ("s", 2)], "source string, chunk_id int")
    small = skip_done_chunks(chunks, pairs, 2)
    big = skip_done_chunks(chunks, pairs, 2, broadcast_bytes=0)
    assert sorted(r.chunk_id for r in small.collect()) == [0, 2, 3, 4]
    assert sorted(r.chunk_id for r in big.collect()) == [0, 2, 3, 4]
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()


def test_merge_keeps_every_source(spark):
    s = [spark.createDataFrame([("q", "a", f"src{i}", 0, "c")], QA_PAIR_SCHEMA) for i in range(3)]
    merged = merge_pairs(*s)
    assert sorted(r.source for r in merged.collect()) == ["src0", "src1", "src2"]


def test_resume_join_is_below_the_model_call(spark):
    docs = _docs(spark)
    chunks_src = docs.select("source", "text")
    from sftprep.operators.chunking import chunk_documents
    from sftprep.plans.qa import question_requests

    chunks = chunk_documents(chunks_src, keep=["source"], chunk_size=64, overlap=16)
    existing = spark.createDataFrame([("e", "e", "a_txt", 0, "c")] * 2, QA_PAIR_SCHEMA)
    todo = skip_done_chunks(chunks.select("source", "chunk_id", "chunk"), existing, 2)
    plan = generate_replies(question_requests(todo, 2), make_client, carry=["source", "chunk_id"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.index("MapInPandas") < text.index("LeftAnti")  # anti-join is a child of the Python stage


def test_skip_done_with_chunk_text(spark):
    chunks = spark.createDataFrame([("s", 0, "new text"), ("s", 1, "same")], "source string, chunk_id int, chunk string")
    pairs = spark.createDataFrame([("q", "a", "s", 0, "old text")] * 2 + [("q", "a", "s", 1, "same")] * 2,
                                  QA_PAIR_SCHEMA)
    assert skip_done_chunks(chunks, pairs, 2).count() == 0
    left = skip_done_chunks(chunks, pairs, 2, match_chunk_text=True).collect()
    assert [(r.chunk_id, r.chunk) for r in left] == [(0, "new text")]


def test_offline_replies_equal_inline(spark):
    from sftprep.plans.qa import offline_answer_requests, offline_pairs, offline_question_requests

    docs = _docs(spark)
    qreq = offline_question_requests(docs, chunk_size=64, overlap=16)
    # the "external service": the stub run over the exported requests, answering twice
    qrep = generate_replies(qreq, make_client, carry=["request_id"])
    qrep = qrep.unionByName(qrep)
    areq = offline_answer_requests(qreq, qrep)
    arep = generate_replies(areq, make_client, carry=["request_id"])
    offline = offline_pairs(areq, arep)
    inline = generate_qa_pairs(docs, make_client, chunk_size=64, overlap=16).pairs.drop("question_no")
    assert offline.count() == inline.count()
    assert offline.exceptAll(inline).count() == 0 and inline.exceptAll(offline).count() == 0
