import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm_helpers import ROWS, edge_documents, no_documents
from sftprep.llm import bpe as B
from sftprep.llm import token_files as T
from sftprep.session import scratch_path

from conftest import SF001

PATH = public_tokenizers.path(B.VOCABULARY)
LIBRARY = Tokenizer.from_file(PATH)
with open(PATH, "rb") as f:
    VOCABULARY = B.Vocabulary(f.read())


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def own_ids(text):
    return np.frombuffer(VOCABULARY.encode([text])[0], VOCABULARY.kind).tolist()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "the", "é", "e\u0301", "ß", "Σ", "ς", "İ", "'s", "'LL", " ", "\n", "\x1c", "\x85", "１", "½", "🙂", "日本", "!!", "#", "q" * 70, "<|endoftext|>", "\ue000", "\u0345"]), max_size=30).map("".join))
def test_ids_equal_the_library(text):
    ids = library_ids(text)
    assert own_ids(text) == ids
    assert VOCABULARY.decode(np.array(ids, dtype=int)) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_arrays_equal_single_texts(monkeypatch):
    import pyarrow as pa

    texts = ["", None, "a  b ", " lead", "x\x1cy z", "é <|endoftext|> İ", "same same same", "\n", "Long text " * 40, "\u200b zero", "１２ ½"]
    monkeypatch.setattr(B, "SEGMENT", 100)
    for part in (texts, texts[:4], [None], ["plain", "words"], ["x\x1cy"], []):
        ids, ends = VOCABULARY.encode_array(pa.array(part, pa.string()))
        assert [p.tolist() for p in np.split(ids, ends[:-1])][: len(part)] == [library_ids(t) for t in part]


def test_documents_equal_the_library(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    want = {r.doc_id: library_ids(r.text) for r in docs.collect()}
    both = B.decode_documents(B.encode_documents(docs, PATH), PATH).collect()
    assert {r.doc_id: list(r.token_ids) for r in both} == want
    assert all(r.decoded == LIBRARY.decode(want[r.doc_id], skip_special_tokens=False) for r in both)


def test_cleared_memory_changes_nothing(monkeypatch):
    texts = [f"word{k} other{k % 7} third" for k in range(200)]
    want = [library_ids(t) for t in texts]
    monkeypatch.setattr(B, "REMEMBERED", 20)
    monkeypatch.setattr(B, "SEGMENT", 50)
    with open(PATH, "rb") as f:
        small = B.Vocabulary(f.read())
    assert [np.frombuffer(i, small.kind).tolist() for i in small.encode(texts)] == want
    assert np.frombuffer(small.encode([" ".join(texts)])[0], small.kind).tolist() == [i for w in want for i in w]


def test_certain_cuts_are_never_inside_a_token():
    for token in list(VOCABULARY.ids)[:5000]:
        b = [VOCABULARY.value[c] for c in token.removesuffix(VOCABULARY.end)]
        assert VOCABULARY.joined[b[:-1], b[1:]].all()
    assert not VOCABULARY.joined.all()


def test_bpe_edges(spark):
    df = edge_documents(spark)
    out = B.decode_documents(B.encode_documents(df, PATH), PATH).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, list(r.token_ids)) for r in out) == sorted((k is None, k or 0, library_ids(t)) for k, t, *_ in ROWS)
    assert B.encode_documents(no_documents(spark), PATH).count() == 0
    null = spark.createDataFrame([(1, None)], "doc_id long, token_ids array<int>")
    assert B.decode_documents(null, PATH).first().decoded == ""


@pytest.mark.parametrize("n", [0, 1, 1000, 1024, 1025, 70_000])
def test_block_round_trip(n):
    rng = np.random.default_rng(n)
    counts = np.bincount(rng.zipf(1.3, 50_000) % 3000, minlength=3000)
    scaled = T.FrequencyTable.scaled(counts)
    assert scaled.sum() == 1 << T.PRECISION and ((scaled > 0) == (counts > 0)).all()
    table = T.FrequencyTable(scaled)
    ids = rng.choice(np.flatnonzero(counts), n)
    raw = T.encode_block(ids, table)
    assert (T.decode_block(raw, table) == ids).all()
    for a, b in ((0, 5), (n // 2, n // 2 + 50), (max(0, n - 3), n)):
        assert (T.decode_block(raw, table, a, b) == ids[a:b]).all()
    if n > 1000:
        bad = bytearray(raw)
        bad[-9] ^= 1
        with pytest.raises(ValueError, match="checksum"):
            T.decode_block(bytes(bad), table)


def test_one_symbol_table():
    table = T.FrequencyTable(T.FrequencyTable.scaled(np.array([0, 7])))
    ids = np.ones(5000, dtype=int)
    assert (T.decode_block(T.encode_block(ids, table), table) == ids).all()


def written(spark, df):
    folder = scratch_path(spark, "token-test")
    T.write_tokens(df, folder, PATH)
    return T.read_tokens(spark, folder).withColumn("crc", F.crc32("ids")).orderBy("start").collect()


@pytest.mark.parametrize("block", [1 << 18, 100])
def test_files_round_trip(spark, monkeypatch, block):
    monkeypatch.setattr(T, "BLOCK", block)
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    at, want = 0, []
    for r in docs.orderBy("doc_id").collect():
        ids = np.array([*library_ids(r.text), T.END_ID], dtype="<u4")
        want.append((r.doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert [(r.doc_id, r.start, r.n_tokens, r.crc) for r in written(spark, docs)] == want


def test_file_edges(spark):
    rows = written(spark, edge_documents(spark))
    assert [r.doc_id for r in rows] == [None, 0, 1, 2, 3, 3, 4, 5, 6]
    assert [r.n_tokens for r in rows if r.doc_id in (0, 1)] == [1, 1]
    assert written(spark, no_documents(spark)) == []
