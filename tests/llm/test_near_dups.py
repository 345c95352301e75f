from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from llm_helpers import LONG, edge_documents, no_documents
from sftprep.llm import near_dups as M

from conftest import SF001


def brute(rows, size, percent):
    """(set size, component) per id, from all sharing pairs of whole sets."""
    sets, parent = {}, {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
        parent[i] = i

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i in sorted(sets):
        shared = Counter(j for s in sets[i] for j in holders[s])
        for j, n in shared.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
        for s in sets[i]:
            holders[s].append(i)
    return {i: (len(sets[i]), find(i)) for i in sets}


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def variants(n):
    """A chain of copies that differ more and more, and strays."""
    base = [f"w{i}" for i in range(60)]
    out = []
    for k in range(n):
        words = list(base)
        for j in range(k % 9):
            words[(7 * j + k) % 60] = f"x{k}{j}"
        out.append((k, " ".join(words)))
    return out


@pytest.mark.parametrize("size", [2, 5])
def test_documents_equal_brute_force(spark, size):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(M.near_duplicates(docs, shingle=size)) == brute(rows, size, 80)


@pytest.mark.parametrize("block,weight", [(512, 1_000_000), (4, 300)])
def test_one_large_group_in_blocks(spark, monkeypatch, block, weight):
    monkeypatch.setattr(M, "BLOCK", block)
    monkeypatch.setattr(M, "WEIGHT", weight)
    rows = variants(90)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(M.near_duplicates(df, shingle=2)) == brute(rows, 2, 80)


def test_edges(spark):
    rows = M.near_duplicates(edge_documents(spark), shingle=2).collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == 9 and sum(r.doc_id == 3 for r in rows) == 2
    assert by_id[0].n_shingles == by_id[1].n_shingles == by_id[4].n_shingles == 0 and by_id[0].kept and by_id[4].component_id == 4
    assert by_id[2].n_shingles == 1 and by_id[None].component_id is None and by_id[None].kept
    assert by_id[3].n_shingles == len({tuple(p) for p in zip(LONG.lower().split(), LONG.lower().split()[1:])})
    assert M.near_duplicates(no_documents(spark)).count() == 0


def test_drop_keeps_columns_and_one_document(spark):
    df = edge_documents(spark, [(7, "same text of some words here", "en", "a", 1), (8, "same text of some words here", "en", "a", 1), (9, "other words that stand alone", None, None, None)])
    out = M.drop_near_duplicates(df)
    assert out.columns == df.columns and sorted(r.doc_id for r in out.collect()) == [7, 9]


def test_texts_that_share_an_id_are_all_searched(spark):
    words = [f"w{i}" for i in range(100)]
    a, b, near = " ".join(f"a{i}" for i in range(90)), " ".join(words), " ".join(words[:97] + ["x", "y", "z"])
    for rows in ([(1, a), (1, b), (2, near)], [(1, b), (1, a), (2, near)], [(3, a), (1, a), (1, b), (2, near)]):
        out = M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert {r.doc_id: r.component_id for r in out} == {k: 1 for k, _ in rows}


def test_shared_parts_are_planned_once(spark):
    """op1: a part that several branches read is stored, so no plan holds it as often (driver memory)."""
    shared = spark.createDataFrame([(1, 1), (1, 2), (1, 3), (2, 2), (2, 3)], "key long, id long")
    comps = spark.createDataFrame([(1, 1), (2, 1), (3, 3)], "id long, comp long")
    nodes = spark.range(1, 4).select("id", F.lit(b"\0" * 2 * M.SIGNATURE).alias("sig"))
    plan = M.crossing(shared, comps, nodes)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") <= 6
