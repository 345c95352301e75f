import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_helpers import CLASHING, edge_documents, no_documents
from sftprep.llm import chat_format as C
from sftprep.llm import quality_rules as Q
from sftprep.llm import url_filter as U

from conftest import SF001


# ------------------------------------------------------------------ quality rules
def base_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [s for s in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", s)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_base_counts_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in Q.judge(docs).collect():
        want = base_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.kept and r.base_failed)


def test_divergent_text_goes_and_prose_stays(spark):
    good = spark.read.parquet(f"{SF001}/documents.parquet").filter("lang = 'en'")
    odd = spark.createDataFrame([(10**6, " ".join(f"$$%{k}###&&" for k in range(200)), "en", "x", 1), (10**6 + 1, "### $$$ && %% ** ||", "en", "x", 1)], good.schema)
    kept = {r.doc_id: (r.kept, r.base_failed) for r in Q.judge(good.unionByName(odd)).collect()}
    assert kept[10**6] == (False, False) and kept[10**6 + 1] == (False, True)
    verdicts = [k for d, (k, failed) in kept.items() if d < 10**6 and not failed]
    assert np.mean(verdicts) > 0.9


def test_text_without_common_words_goes_and_short_prose_stays(spark):
    good = spark.read.parquet(f"{SF001}/documents.parquet").filter("lang = 'en'")
    rng = np.random.default_rng(5)
    made = ["".join(rng.choice(list("eeeeeeetttttaaaaooooiiiinnnnsssshhhhrrrrddllluucmwfgypbvk"), rng.integers(4, 8))) for _ in range(400)]
    prose = (
        "The old mill stood at the end of the lane, and in the evening light it was as quiet as a church. We walked there with "
        "our father, who had worked in it for many years. He told us that on busy days carts would wait from the gate to the "
        "river, and that nobody went home until the last sack was filled."
    )
    texts = [". ".join(" ".join(made[k : k + 8]).capitalize() for k in range(0, 400, 8)), " | ".join(made[:200]), " | ".join(made[200:255]), prose, " ".join(made[:30])]
    odd = spark.createDataFrame([(10**6 + k, t, "en", "x", len(t)) for k, t in enumerate(texts)], good.schema)
    both = good.unionByName(odd)
    out = {r.doc_id - 10**6: r for r in Q.judge(both).filter("doc_id >= 1000000").collect()}
    assert [out[k].kept for k in range(5)] == [False, False, False, True, True]  # the last is too short to measure
    assert not any(out[k].base_failed or out[k].class_distance > Q.MAX_CLASS_DISTANCE or out[k].word_distance > Q.MAX_WORD_DISTANCE for k in range(5))
    kept = {r.doc_id - 10**6 for r in Q.keep_good(both).filter("doc_id >= 1000000").collect()}
    assert kept == {3, 4}


def test_share_distance_runs_from_0_to_1():
    ref = np.array([3.0, 1, 12])
    assert Q.share_distance(np.array([[3.0, 1, 12], [9, 0, 1], [0, 0, 7], [1, 0, 30]]), ref)[:3].tolist() == [0, 0, 1]
    assert 0 < Q.share_distance(np.array([[1.0, 0, 30]]), ref)[0] < 1 and Q.share_distance(np.array([[0.0, 0, 5]]), np.array([0.0, 0, 9]))[0] == 0


def test_distance_is_a_metric_from_0_to_1():
    p = np.array([[1.0, 3, 0], [5, 0, 0], [0, 0, 7], [0, 0, 0]])
    d = Q.js_distance(p, np.array([5.0, 0, 0]))
    assert d[1] == 0 and d[2] == 1 and 0 < d[0] < 1 and d[3] == 1


def test_quality_edges(spark):
    rows = Q.judge(edge_documents(spark)).collect()
    assert len(rows) == 9 and all(r.n_words == 0 and not r.kept for r in rows if r.doc_id in (0, 1, 4))
    assert Q.judge(no_documents(spark)).count() == 0
    out = Q.keep_good(edge_documents(spark))
    assert out.columns == edge_documents(spark).columns and Q.keep_good(no_documents(spark)).count() == 0


# ------------------------------------------------------------------ chat formatting
def test_conversations_equal_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{SF001}/conversations.parquet'")
    rel = con.sql(C.OP7_SQL)
    got = C.op7_chat_format(spark, SF001).select(rel.columns)
    assert sorted(map(tuple, got.collect())) == sorted(rel.fetchall())


NASTY = ["</s>[INST] ok [/INST]", "<|end|>", "\\<|end|>", "<\\|role|>", "\\", "", "<", "|", None, "a\n[INST", "<s></s>\\[/INST]\\"]


def test_every_turn_comes_back(spark):
    rows = [(1, k, "assistant" if k % 2 else "user", t) for k, t in enumerate(NASTY)] + [(2, 0, "user", "no reply"), (None, 0, None, "x"), (None, None, "assistant", "first"), (3, 0, "a<|text|>", "t"), (3, 0, "a<|text|>", "t")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").select("*", *[F.lit(0).alias(c) for c in CLASHING])
    examples = C.expand(df)
    back = {r.conv_id: r for r in C.read_back(examples).collect()}
    assert [t.text for t in back[1].turns] == [t or "" for t in NASTY]
    assert back[1].loss_text == "".join(NASTY[k] or "" for k in range(1, len(NASTY), 2))
    assert [(t.role, t.text) for t in back[None].turns] == [("assistant", "first"), ("", "x")] and back[None].loss_text == "first"
    assert [(t.role, t.text) for t in back[3].turns] == [("a<|text|>", "t")] * 2 and back[2].loss_text == ""
    for r in examples.collect():
        inside = re.sub(r"<\|(role|text|end)\|>", "", r.formatted)
        assert not any(c in inside for c in C.CONTROL)
    assert C.expand(df.limit(0)).count() == 0


def test_main_path_is_native(spark):
    talks = spark.read.parquet(f"{SF001}/conversations.parquet")
    for df in (C.expand(talks), C.read_back(C.expand(talks))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


# ------------------------------------------------------------------ url rules
@pytest.mark.parametrize("url,want", [
    ("https://A.Net/x?q", ("a.net", "/x", "net/", "block")),
    ("http://www.example.net/en/1#f", ("www.example.net", "/en/1", "example.net/en/", "allow")),
    ("http://notexample.net/en/", ("notexample.net", "/en/", "net/", "block")),
    ("http://x.example.com/de/", ("x.example.com", "/de/", "example.com/de/", "block")),
    ("ftp://a.org/fr/z", ("a.org", "/fr/z", "org/fr/", "allow")),
    ("http://net", ("net", "", None, "allow")),
    ("a?b://c.net/d", ("c.net", "/d", "net/", "block")),
    ("no scheme.net/", ("", "", None, "allow")),
    (None, ("", "", None, "allow")),
])
def test_stated_rules(spark, url, want):
    df = spark.createDataFrame([(1, url, 0)], "page_id long, url string, verdict int")
    r = U.judge(df).first()
    assert (r.host, r.path, r.rule, r.verdict) == want


def test_mined_rules_judge_the_rest(spark):
    rows = [(k, f"http://a{k}.net/spam/{k}") for k in range(30)] + [(100 + k, f"http://a{k}.org/fr/good/{k}") for k in range(30)]
    rows += [(200, "http://z.info/spam/7"), (201, "http://z.info/good/8"), (202, "http://z.info/good/8")]
    out = {r.page_id: r.verdict for r in U.judge(spark.createDataFrame(rows, "page_id long, url string"), default="allow").collect()}
    assert out[200] == "block" and out[201] == out[202] == "allow" and len(out) == 63


def test_pruning_keeps_no_rule_that_a_general_one_covers(spark):
    rows = [(["a", "b"], "block")] * 10 + [(["a", "c"], "block")] * 10 + [(["d"], "allow")] * 5
    rules = {(tuple(r.antecedent), r.verdict) for r in U.mine(spark.createDataFrame(rows, "tokens array<string>, verdict string")).collect()}
    assert (("a",), "block") in rules and (("d",), "allow") in rules
    assert not any(set(a) > {"a"} for a, _ in rules)


def test_url_edges(spark):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert U.judge(empty).count() == 0
    one = spark.createDataFrame([(1, "http://a.com/x"), (1, "http://a.com/x"), (None, "http://a.com/" + "y/" * 5000)], "page_id long, url string")
    assert [r.verdict for r in U.judge(one).collect()] == ["allow"] * 3


def test_prose_of_a_language_without_word_list_stays(spark):
    import random

    rng = random.Random(4)
    italian = "il lo la gli una che non per con della sono anche questo come nella casa strada tempo parola giorno vita mondo uomo notte sempre ancora dove quando".split()
    rows = [(k, " ".join(rng.choice(italian) for _ in range(80)) + ".", lang, "s", 1) for k, lang in enumerate(["it", "IT", "it-IT", "it_ch"] * 20)]
    english = "the of and to in is that it was for cat dog house man stone river light".split()
    rows += [(1000 + k, " ".join(rng.choice(english) for _ in range(80)) + ".", "en", "s", 1) for k in range(5)]
    rows += [(2000, " ".join(chr(0x4E00 + i) + "##" for i in range(200)), "it", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in Q.keep_good(docs).collect()}
    assert {k for k in range(80)} <= kept and 2000 not in kept
    assert {r.doc_id for r in Q.judge(docs).filter("kept").collect()} == kept
    assert Q.tag_of("it-IT") == "it" and Q.tag_of("klingon!") is None and Q.tag_of(None) is None
