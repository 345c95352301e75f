import json

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_helpers import ROWS, edge_documents, no_documents
from sftprep.llm import token_counts as C

from conftest import SF001

PATH = public_tokenizers.path(C.VOCABULARY)
LIBRARY = Tokenizer.from_file(PATH)
with open(PATH, "rb") as f:
    RAW = f.read()
MERGES = C.Merges(json.loads(RAW))
WHOLE = MERGES.whole()
COUNTER = C.Counter(RAW, WHOLE)


def library(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(["a", " the", "'s", "'LL", " ", "\n", "  ", "\t", "\x1c", "\x85", "\xa0", "é", "é", "１", "½", "🙂", "日本", "!!", "—", "​", "x" * 90, "<|endoftext|>", "<|endof"]), st.characters()), max_size=25).map("".join))
def test_counts_equal_the_library(text):
    assert COUNTER.count(text) == library(text)


def test_verified_code_points_split_as_in_the_library():
    for a, b in C.VERIFIED:
        for c in map(chr, range(a, b + 1)):
            text = f"a{c}1{c} {c}!{c}{c}  {c}a {c}\n{c}"
            pieces = COUNTER.pieces.findall(text)
            assert pieces == [MERGES.raw(p).decode() for p, _ in COUNTER.library.pre_tokenize_str(text)], hex(ord(c))


def test_whole_tokens_are_proven_one_by_one():
    assert len(WHOLE) > 40_000
    for s in sorted(WHOLE)[::17]:
        if s not in MERGES.special:
            pieces = LIBRARY.pre_tokenizer.pre_tokenize_str(s)
            if len(pieces) == 1:
                assert library(s) == 1
    # a string that no merge order reaches would be merged, never counted as one
    spec = json.loads(RAW)
    spec["model"]["merges"] = [m for m in spec["model"]["merges"] if m != ["Ġ", "t"]]
    fewer = C.Merges(spec).whole()
    assert " t" in WHOLE and " t" not in fewer and fewer < WHOLE


def test_long_pieces_and_parts(monkeypatch):
    texts = ["ab" * 5000 + " c", "x" * 3000, "word  two\n\n three's " * 300, "é" * 700 + " " * 900 + "!"]
    want = [library(t) for t in texts]
    assert list(map(COUNTER.count, texts)) == want
    monkeypatch.setattr(C, "SEGMENT", 40)
    monkeypatch.setattr(C, "REMEMBERED", 5)
    small = C.Counter(RAW, WHOLE)
    assert list(map(small.count, texts)) == want


def test_documents_equal_the_library(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = {r.doc_id: r for r in C.op13_token_counts(spark, SF001).collect()}
    assert len(rows) == docs.count()
    for d in docs.collect():
        r, n = rows[d.doc_id], library(d.text)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((d.text or "").encode()), n, n > 512)


def test_edges(spark):
    out = C.count_tokens(edge_documents(spark), PATH, limit=3).collect()
    want = [(k is None, k or 0, len((t or "").encode()), library(t), library(t) > 3) for k, t, *_ in ROWS]
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in out) == sorted(want)
    assert C.count_tokens(no_documents(spark), PATH).count() == 0


def test_other_files_are_refused():
    spec = json.loads(RAW)
    spec["pre_tokenizer"]["add_prefix_space"] = True
    with pytest.raises(ValueError, match="byte-level"):
        C.Merges(spec)
