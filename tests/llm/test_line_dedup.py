import duckdb
import numpy as np

from llm_helpers import edge_documents, no_documents
from sftprep.llm import line_dedup as M

from conftest import SF001


def test_documents_equal_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF001}/documents.parquet'")
    want = sorted(con.sql(M.OP8_SQL).fetchall())
    got = M.op8_line_dedup(spark, SF001).select("doc_id", "n_lines", "n_dropped", "kept_sha256")
    assert sorted(map(tuple, got.collect())) == want


def cleaned(index, docs):
    return sorted((r.doc_id, r.kept, r.n_dropped) for r in index.clean(docs).select("row.doc_id", "r.*").collect())


def test_insertions_and_deletions_equal_a_new_index(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    parts = [docs.filter(f"doc_id % 3 = {k}") for k in range(3)]
    index = M.LineIndex.empty(spark, shards=4)
    for p in [*parts, parts[0]]:  # the last is a repetition
        index = index.insert(p)
    whole = M.LineIndex.empty(spark, shards=4).insert(docs)
    assert cleaned(index, docs) == cleaned(whole, docs)
    rest = docs.filter("doc_id % 3 <> 1")
    fewer = index.delete(parts[1])
    assert cleaned(fewer, rest) == cleaned(M.LineIndex.empty(spark, shards=4).insert(rest), rest)
    again = fewer.insert(parts[1])
    assert cleaned(again, docs) == cleaned(whole, docs)
    assert cleaned(index, docs) == cleaned(whole, docs)  # older versions stay readable


def test_filter_never_misses_and_forgets():
    rng = np.random.default_rng(3)
    keys = rng.integers(-(2**63), 2**63, 5000)
    f = M.CuckooFilter.sized(7500)
    assert f.add(keys) and f.add(keys[:2500])
    assert (f.count(keys[:2500]) >= 2).all() and (f.count(keys) >= 1).all()
    others = rng.integers(-(2**63), 2**63, 20000)
    assert (f.count(others) > 0).mean() < 0.01
    f = M.CuckooFilter.load(f.dump())
    f.remove(keys[:2500])
    assert (f.count(keys) >= 1).all() and (f.count(keys[:2500]) >= 2).mean() < 0.01
    f.remove(keys)
    assert not any(f.table)


def test_a_full_filter_grows(spark):
    small = spark.createDataFrame([(1, "line number one\nline number two")], "doc_id long, text string")
    many = spark.createDataFrame([(k, "\n".join(f"some line {k % 40} {j}" for j in range(40))) for k in range(2, 90)], "doc_id long, text string")
    index = M.LineIndex.empty(spark, shards=1).insert(small).insert(many)
    both = small.union(many)
    assert cleaned(index, both) == cleaned(M.LineIndex.empty(spark, shards=1).insert(both), both)


def test_edges(spark):
    df = edge_documents(spark)
    rows = {r.doc_id: r for r in M.LineIndex.empty(spark).insert(df).clean(df).select("row.doc_id", "r.*").collect()}
    assert (rows[0].n_lines, rows[0].n_dropped, rows[0].kept) == (1, 0, "") and rows[1].n_lines == 1
    assert rows[None].n_dropped == 1 and rows[None].kept == "x" and rows[6].n_dropped == 0
    assert rows[3].n_dropped == 0  # its repetition is the same document
    out = M.dedup_lines(df, length="n_chars")
    assert out.columns == df.columns and out.schema["n_chars"].dataType == df.schema["n_chars"].dataType
    kept = {r.doc_id: r for r in out.collect()}
    assert kept[None].text == "x" and kept[None].n_chars == 1 and kept[1].text is None
    assert M.dedup_lines(no_documents(spark)).count() == 0
