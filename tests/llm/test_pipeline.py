import corpus_pipeline as P
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm_helpers import edge_documents, no_documents
from sftprep.llm import decontaminate, quality_rules
from sftprep.llm.common import stored
from test_near_dups import brute

from conftest import SF001


@pytest.fixture(scope="module")
def steps(spark):
    """What each stage is given and returns."""
    docs, out = spark.read.parquet(f"{SF001}/documents.parquet"), []
    for name, stage in P.STAGES:
        new = stored(stage(spark, docs, SF001), "step")
        out.append((name, docs, new))
        docs = new
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_in_order(steps):
    assert [n for n, _, _ in steps] == ["quality_rules", "line_dedup", "near_duplicates", "decontamination", "bpe"]
    for _, before, after in steps[:-1]:
        assert after.columns == before.columns and after.dtypes == before.dtypes


def test_quality_stage(steps):
    _, before, after = steps[0]
    want = {r.doc_id for r in quality_rules.judge(before).filter("kept").collect()}
    assert set(texts(after)) == want and 0 < len(want) < before.count()


def test_line_stage_equals_brute_force(steps):
    _, before, after = steps[1]
    owner, lines = {}, {}
    for d, t in sorted(texts(before).items()):
        lines[d] = [(s, k) for s in t.split("\n") if (k := s.strip(" \t\n\r\x0b\x0c").encode().lower().decode()) is not None]
        for _, k in lines[d]:
            if len(k) >= 10:
                owner.setdefault(k, d)
    want = {d: "\n".join(s for s, k in ls if len(k) < 10 or owner[k] == d) for d, ls in lines.items()}
    assert texts(after) == want and all(r.n_chars == len(r.text) for r in after.collect())


def test_near_duplicate_stage_equals_brute_force(steps):
    _, before, after = steps[2]
    comps = brute(list(texts(before).items()), 5, 80)
    assert set(texts(after)) == {d for d, (_, c) in comps.items() if c == d}


def test_decontamination_stage(spark, steps):
    _, before, after = steps[3]
    flat = lambda t: b" ".join(decontaminate.words_of(t))
    items = [flat(r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    assert set(texts(after)) == {d for d, t in texts(before).items() if not any(i in flat(t) for i in items)}


def test_token_stage_equals_the_library(steps):
    _, before, after = steps[4]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {d: library.encode(t, add_special_tokens=False).ids for d, t in texts(before).items()}
    assert {r.doc_id: list(r.token_ids) for r in after.collect()} == want and np.sum([len(w) for w in want.values()]) > 0


def test_run_gives_the_last_stage(spark, steps):
    assert sorted(r.doc_id for r in P.run(spark, SF001).collect()) == sorted(r.doc_id for r in steps[-1][2].collect())


def test_stages_take_odd_and_empty_tables(spark):
    for df in (edge_documents(spark), no_documents(spark)):
        for _, stage in P.STAGES[:-1]:
            out = stage(spark, df, SF001)
            assert out.columns == df.columns and out.select(F.count("*")).first()[0] <= df.count()
        assert P.STAGES[-1][1](spark, df, SF001).count() == df.count()
