"""Both chunkers against their independent SQL restatements on adversarial random texts."""

import random

import duckdb
import pandas as pd
import pytest

from sftprep_checks.fixed import PLAIN_SEPARATORS
from sftprep_checks.oracles import markdown_chunks_sql, plain_chunks_sql
from sftprep.operators.chunking import markdown_bounds, plain_bounds

PIECES = ["word", "two words", "a. ", "b? ", "c! ", "d: ", "e; ", ".\n", "\n", "\n\n", "| x | y |", "+--+",
          "  +-", "```", "  ```py", "。", "，", "！", "甲乙", " ", "end.", "|", "x" * 40]


def _texts(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        k = rng.randint(0, 120)
        out.append((i, "".join(rng.choice(PIECES) for _ in range(k))))
    return out


def _sql_bounds(sql_builder, texts, size, overlap, *extra):
    con = duckdb.connect()
    con.register("docs_df", pd.DataFrame(texts, columns=["doc_id", "text"]))
    sql = sql_builder("SELECT doc_id, text FROM docs_df", size, overlap, *extra)
    got = {}
    for doc_id, chunk_id, s, e, _ in con.sql(sql).fetchall():
        got.setdefault(doc_id, []).append((chunk_id, s, e))
    return {k: [(s, e) for _, s, e in sorted(v)] for k, v in got.items()}


@pytest.mark.parametrize("size,overlap", [(40, 8), (64, 0), (25, 30), (100, 20)])
def test_markdown_matches_sql(size, overlap):
    texts = _texts(250, size * 7 + overlap)
    sql = _sql_bounds(markdown_chunks_sql, texts, size, overlap)
    for doc_id, text in texts:
        assert markdown_bounds(text, size, overlap) == sql[doc_id], (doc_id, text)


@pytest.mark.parametrize("size,overlap", [(40, 8), (64, 0), (25, 30), (100, 20)])
def test_plain_matches_sql(size, overlap):
    texts = _texts(250, size * 11 + overlap)
    sql = _sql_bounds(plain_chunks_sql, texts, size, overlap, PLAIN_SEPARATORS)
    for doc_id, text in texts:
        assert plain_bounds(text, size, overlap) == sql[doc_id], (doc_id, text)


@pytest.mark.parametrize("seps", [[" ", "\n", ". ", "a", "ab"], ["b ", "word", "\n\n"], ["x" * 3, ", ", " "]])
def test_custom_separators_match_sql(seps):
    """Dropping separators that cannot win changes no result: the SQL tries every one."""
    texts = _texts(150, len(seps))
    sql = _sql_bounds(plain_chunks_sql, texts, 30, 6, seps)
    for doc_id, text in texts:
        assert plain_bounds(text, 30, 6, seps) == sql[doc_id], (doc_id, text)


def test_empty_separator_stops_the_search():
    assert plain_bounds("aa bb cc dd", 6, 0, ["", " "]) == [(0, 6), (6, 11)]
