"""C1/C2 golden cases, invariants and Spark-vs-Python equality."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sftprep.operators.chunking import (
    PLAIN_SEPARATORS,
    chunk_documents,
    effective_separators,
    markdown_bounds,
    plain_bounds,
)
from sftprep.sources.tables import read_table

from conftest import SF001

SF01 = "/root/testdata/sf0.01"

PLAIN_GOLDEN = [
    ("abcdefghij", 4, 1, [(0, 4), (3, 7), (6, 10), (9, 10)]),
    ("aa bb cc dd ee", 6, 2, [(0, 6), (4, 9), (7, 12), (10, 14), (12, 14)]),
    ("甲乙。丙丁，戊己 庚辛壬癸", 6, 0, [(0, 3), (3, 6), (6, 9), (9, 13)]),
    ("", 4, 1, [(0, 0)]),
    ("abc", 0, 1, [(0, 3)]),
    ("abcdefgh", 3, 3, [(0, 3), (3, 6), (6, 8)]),
    ("xx\n\nyy zz qq ww", 10, 0, [(0, 10), (10, 15)]),
    ("a" * 2500, 1024, 200, [(0, 1024), (824, 1848), (1648, 2500), (2300, 2500)]),
]

M1 = "Intro text here.\n\n| a | b |\n| - | - |\n| 1 | 2 |\n| 3 | 4 |\n\nAfter the table. More words follow here.\n"
M2 = "Para one is here.\n```\ncode 1\ncode 2\n```\nTail one. Tail two. Tail three. Tail four.\nLast line."
MD_GOLDEN = [
    (M1, 30, 5, [(0, 18), (13, 58), (53, 76), (71, 100), (95, 100)]),
    (M2, 24, 4, [(0, 22), (18, 93), (89, 93)]),
    ("One two three. Four five six? Seven eight nine; ten eleven twelve. End", 24, 4,
     [(0, 15), (11, 30), (26, 48), (44, 67), (63, 70), (66, 70)]),
]


@pytest.mark.parametrize("text,size,overlap,expected", PLAIN_GOLDEN)
def test_plain_golden(text, size, overlap, expected):
    assert plain_bounds(text, size, overlap) == expected


@pytest.mark.parametrize("text,size,overlap,expected", MD_GOLDEN)
def test_markdown_golden(text, size, overlap, expected):
    assert markdown_bounds(text, size, overlap) == expected


def test_markdown_short_and_zero():
    assert markdown_bounds("short", 10, 2) == [(0, 5)]
    assert markdown_bounds("whatever text", 0, 2) == [(0, 13)]


def test_effective_separators_default():
    assert effective_separators(PLAIN_SEPARATORS) == ["。", "，", "！", "？", "；", "：", " ", "\n\n", "\n"]


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.sampled_from(list("ab .?!:;|+-`\n") + ["```", "| x |", "\n\n"]), max_size=300).map("".join),
    st.integers(min_value=1, max_value=60),
    st.integers(min_value=0, max_value=30),
)
def test_markdown_invariants(text, size, overlap):
    b = markdown_bounds(text, size, overlap)
    assert b[0][0] == 0 and b[-1][1] == len(text)
    starts = [s for s, _ in b]
    assert starts == sorted(set(starts))
    assert all(s <= e for s, e in b)


def test_spark_equals_python_on_documents(spark):
    docs = read_table(spark, SF001, "documents")
    ch = chunk_documents(docs, keep=["doc_id"], chunk_size=1024, overlap=200)
    got = {}
    for r in ch.collect():
        got.setdefault(r["doc_id"], []).append((r["chunk_id"], r["chunk_start"], r["chunk_end"], r["chunk"]))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(got) == set(texts)
    for doc_id, text in texts.items():
        exp = [(i, s, e, text[s:e]) for i, (s, e) in enumerate(plain_bounds(text, 1024, 200))]
        assert sorted(got[doc_id]) == exp


@pytest.mark.parametrize("sf,markdown,size,overlap,count", [
    (SF001, False, 1024, 200, 803), (SF001, False, 1000, 100, 775), (SF001, True, 1000, 100, 833),
    (SF01, False, 1024, 200, 3891), (SF01, False, 1000, 100, 3784), (SF01, True, 1000, 100, 4118)])
def test_whole_table_counts(spark, sf, markdown, size, overlap, count):
    docs = read_table(spark, sf, "documents")
    ch = chunk_documents(docs, keep=["doc_id"], chunk_size=size, overlap=overlap, markdown=markdown)
    assert ch.count() == count


def test_invariants_cover_text(spark):
    docs = read_table(spark, SF001, "documents")
    ch = chunk_documents(docs, keep=["doc_id"], chunk_size=1024, overlap=200)
    agg = ch.groupBy("doc_id").agg(
        F.min("chunk_start").alias("lo"), F.max("chunk_end").alias("hi"),
        F.max(F.length("chunk")).alias("longest"), F.count("*").alias("n"),
        F.count_distinct("chunk_start").alias("nd"),
    ).join(docs.select("doc_id", F.length("text").alias("L")), "doc_id")
    bad = agg.filter((F.col("lo") != 0) | (F.col("hi") != F.col("L")) | (F.col("longest") > 1024)
                     | (F.col("n") != F.col("nd")))
    assert bad.count() == 0


def test_null_text_gives_no_chunks(spark):
    df = spark.createDataFrame([(1, None), (2, "abc")], "id int, text string")
    rows = chunk_documents(df, keep=["id"], chunk_size=2, overlap=0).collect()
    assert [(r["id"], r["chunk"]) for r in rows] == [(2, "ab"), (2, "c")]


def test_negative_parameters_rejected(spark):
    df = spark.createDataFrame([(1, "abc")], "id int, text string")
    with pytest.raises(ValueError):
        chunk_documents(df, keep=["id"], chunk_size=-1, overlap=0)


def test_markdown_injected_count_matches_fixture(spark):
    """FIXTURES §3: fence + table injected mid-text into every fifth document -> 3,877 chunks."""
    docs = read_table(spark, SF01, "documents")
    half = F.floor(F.length("text") / 2).cast("int")
    inj = F.concat(F.substring("text", F.lit(1), half), F.lit("\n```\ncode\n```\n| a | b |\n"),
                   F.substr(F.col("text"), half + 1))
    shaped = docs.select("doc_id", F.when(F.col("doc_id") % 5 == 0, inj).otherwise(F.col("text")).alias("text"))
    assert chunk_documents(shaped, keep=["doc_id"], chunk_size=1000, overlap=100, markdown=True).count() == 3877


def test_chunk_bounds_column(spark):
    from sftprep.operators.chunking import chunk_bounds

    df = spark.createDataFrame([("abcdefghij",), (M2,)], "t string")
    got = [[(b.start, b.end) for b in r.b] for r in df.select(chunk_bounds("t", 4, 1).alias("b")).collect()]
    assert got[0] == [(0, 4), (3, 7), (6, 10), (9, 10)]
    md = df.select(chunk_bounds(F.col("t"), 24, 4, markdown=True).alias("b")).collect()[1].b
    assert [(b.start, b.end) for b in md] == [(0, 22), (18, 93), (89, 93)]


def test_a_batch_is_cut_a_few_megabytes_at_a_time():
    """what a worker holds at once follows the bytes of the texts, not the rows of a batch."""
    import pyarrow as pa

    from sftprep.session import byte_slices

    texts = ["é" * 300, None, "", "x" * 5_000, None] * 40
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["id", "t"])
    parts = list(byte_slices(batch, 1, 10_000))
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch]))
    assert len(parts) > 20 and max(sum(len((t or "").encode()) for t in p.column(1).to_pylist()) for p in parts) <= 15_000
    assert [len(p) for p in byte_slices(batch.slice(0, 0), 1)] == [0]


def test_chunks_come_in_slices(spark, monkeypatch):
    """one large batch of documents yields several batches of chunks, and the same chunks."""
    import pyarrow as pa

    docs = spark.range(0, 3_000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words, "), 500).alias("text"))
    chunks = chunk_documents(docs, keep=["doc_id"], spread=False)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.column(1).nbytes + b.column(0).nbytes + sum(map(len, b.column(4).to_pylist()))])], names=["n"])

    got = [r.n for r in chunks.select("doc_id", "chunk_id", "chunk_start", "chunk_end", "chunk").mapInArrow(sizes, "n long").collect()]
    assert max(got) < 12_000_000 and len(got) >= 4  # 18 MB of text in one batch
    assert chunks.count() == 3_000 * len(plain_bounds("some words, " * 500))
