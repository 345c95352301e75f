import pytest

from llm_helpers import edge_documents, no_documents
from sftprep.llm import decontaminate as M

from conftest import SF001


def test_contained_items_are_found_and_no_other(spark):
    docs, bench = (spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("documents", "benchmark"))
    flat = lambda t: b" ".join(M.words_of(t))
    items = {r.item_id: flat(r.text) for r in bench.collect()}
    want = {(r.doc_id, k) for r in docs.collect() for k, i in items.items() if i in flat(r.text)}
    found = M.leaks(docs, bench).collect()
    assert want and want <= {(r.doc_id, r.item_id) for r in found}
    assert all((r.doc_id, r.item_id) in want or r.lcs < 1 for r in found)


def filler(k):
    return " ".join(f"f{k}x{j}" for j in range(120))


ITEM = "Which river runs through the old town of Velmora before it meets the northern sea near Kassel point? The quiet river Tamsin runs there."


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, ITEM), (2, "Seven grey owls sat upon the broken tower and counted every falling leaf of autumn."), (3, None), (4, "")], "item_id long, text string")


def test_paraphrase_needs_the_answer(spark, bench):
    close = ITEM.replace("old town", "ancient city").replace("before it", "until it").replace("near", "by")
    other = close.replace("The quiet river Tamsin runs there", "Nobody could say what was asked")
    rows = [(1, f"{filler(1)} {ITEM.upper()} {filler(2)}"), (2, f"{filler(3)} {close} {filler(4)}"), (3, f"{filler(5)} {other} {filler(6)}"), (4, filler(7))]
    docs = spark.createDataFrame(rows * 3, "doc_id long, text string")
    out = {(r.doc_id, r.item_id, r.kind) for r in M.leaks(docs, bench).collect()}
    assert (1, 1, "verbatim") in out and any(d == 2 for d, _, _ in out) and not any(d in (3, 4) for d, _, _ in out)


def test_an_item_that_a_third_of_all_rows_hold(spark, bench):
    rows = [(k, f"{filler(k)} {ITEM} {filler(k + 500)}" if k % 3 == 0 else f"{filler(k)} {filler(k + 500)}") for k in range(60)]
    out = M.leaks(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in out) == [(k, 1) for k in range(0, 60, 3)]


def test_lcs_equals_the_table():
    def table(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        return row[-1]

    import random

    r = random.Random(5)
    for _ in range(200):
        a, b = ([bytes([r.randint(97, 101)]) for _ in range(r.randint(1, 30))] for _ in "ab")
        assert M.common_length(M.masks(a), len(a), b) == table(a, b)


def test_edges(spark, bench):
    df = edge_documents(spark)
    assert M.leaks(df, bench).count() == 0 and M.leaks(no_documents(spark), bench).count() == 0
    assert M.leaks(df, bench.limit(0)).count() == 0
    leak = edge_documents(spark, [(9, ITEM, None, None, None), (None, filler(1), "en", "a", 1), (10, filler(2), "en", "a", 1)])
    out = M.drop_leaks(leak, bench)
    assert out.columns == df.columns and {r.doc_id for r in out.collect()} == {None, 10}


def test_more_items_than_a_space(spark, monkeypatch):
    monkeypatch.setattr(M, "SPACE", 8)
    monkeypatch.setattr(M, "GROUP", 2)
    items = [(k, " ".join(f"i{k}w{j}" for j in range(20))) for k in range(40)]
    docs = spark.createDataFrame([(k, f"{filler(k)} {t} {filler(k + 100)}") for k, t in items], "doc_id long, text string")
    out = M.leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id) for r in out) == [(k, k) for k in range(40)]


def test_each_stretch_is_judged_by_itself(spark):
    words = [f"k{i}" for i in range(30)]
    item = " ".join(words[:24]) + ". " + " ".join(words[24:])  # the last sentence is the answer
    more = words[:23] + ["zz"] * 7  # more of the item, none of its answer
    less = [w if i % 2 else f"n{i}" for i, w in enumerate(words[:20])] + words[20:]  # 20 of 30 words with the answer
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(1, f"{filler(1)} {' '.join(less)} {filler(2)}"), (2, f"{filler(3)} {' '.join(more)} {' '.join(less)} {filler(4)}"), (3, f"{filler(5)} {' '.join(more)} {filler(6)}")]
    out = M.leaks(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()
    assert sorted((r.doc_id, r.kind) for r in out) == [(1, "paraphrase"), (2, "paraphrase")]


def test_checks_count_words_before_subsequences_and_equal_every_stretch(monkeypatch):
    """The saved places give the result of the whole words, and few stretches reach the subsequence."""
    import random

    import numpy as np

    rng, real, calls, stretches, hits = random.Random(3), M.common_length, [0], 0, 0

    def counted(*args):
        calls[0] += 1
        return real(*args)

    monkeypatch.setattr(M, "common_length", counted)
    for _ in range(300):
        words = [b"w%d" % rng.randrange(40) for _ in range(rng.randint(1, 60))]
        answer = [b"w%d" % rng.randrange(45) for _ in range(rng.randint(0, 5))]
        doc = [b"w%d" % rng.randrange(400) for _ in range(rng.randint(1, 300))]
        if rng.random() < 0.6:
            at = rng.randrange(len(doc))
            doc[at:at] = [w for w in words + answer if rng.random() < 0.85]
        start = rng.randrange(0, len(doc), 40)
        number = {w: k for k, w in enumerate(dict.fromkeys(words + answer))}
        places = [i for i, w in enumerate(doc) if w in number]
        got = M.checked(M.Item(1, words, answer, number), np.array(places, dtype=int), np.array([number[doc[i]] for i in places], dtype=int), len(doc), start)
        n, best = len(words), None
        stretch, step = n + max(2, n // 5), max(1, n // 8)
        lo, hi = max(0, start - n), min(len(doc), start + M.WINDOW + n)
        for s in range(lo, max(lo + 1, hi - stretch + step), step):
            stretches += 1
            part = doc[s : s + stretch]
            share = real(M.masks(words), n, part) / n
            told = real(M.masks(answer), len(answer), part) / max(1, len(answer))
            if M.accepted(share, told) and not (best and share <= best[0]):
                best = (share, told)
        assert got == best
        hits += best is not None
    assert hits > 50 and calls[0] < stretches / 4


def test_no_text_is_saved_between_the_scans(spark, bench, monkeypatch):
    saved, real = [], M.stored
    monkeypatch.setattr(M, "stored", lambda df, name, *rest: (saved.append(df), real(df, name, *rest))[1])
    docs = spark.createDataFrame([(1, f"{filler(1)} {ITEM} {filler(2)}")], "doc_id long, text string")
    assert [(r.doc_id, r.item_id) for r in M.leaks(docs, bench).collect()] == [(1, 1)]
    assert len(saved) == 1 and "string" not in [t for _, t in saved[0].dtypes]


def test_an_answer_column_with_words_that_no_item_has(spark):
    words = [f"k{i}" for i in range(24)]
    bench = spark.createDataFrame([(1, " ".join(words), "Zeta Omega")], "item_id long, text string, reply string")
    near = " ".join(w if i % 3 else f"n{i}" for i, w in enumerate(words))  # two thirds of the item
    rows = [(1, f"{filler(1)} {near} zeta omega {filler(2)}"), (2, f"{filler(3)} {near} {filler(4)}")]
    out = M.leaks(spark.createDataFrame(rows, "doc_id long, text string"), bench, answer="reply").collect()
    assert [(r.doc_id, r.kind, r.answer_share) for r in out] == [(1, "paraphrase", 1.0)]


def test_recall_of_edited_copies(spark):
    import random

    rng = random.Random(11)
    docs = spark.read.parquet(f"{SF001}/documents.parquet").filter("length(text) > 2000").limit(60).collect()
    bench = spark.read.parquet(f"{SF001}/benchmark.parquet")
    items = [(r.item_id, r.text.split()) for r in bench.collect() if len(r.text.split()) >= 8]
    rows, want = [], set()
    for n, (item, words) in enumerate(items * 3):
        kept = [w if rng.random() < 0.88 or i >= len(words) - 6 else f"other{n}x{i}" for i, w in enumerate(words)]
        if sum(a == b for a, b in zip(kept, words)) < 0.8 * len(words):
            continue
        host = docs[n % len(docs)].text.split()
        at = rng.randrange(len(host))
        rows.append((n, " ".join(host[:at] + kept + host[at:])))
        want.add((n, item))
    found = {(r.doc_id, r.item_id) for r in M.leaks(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert len(want) > 50 and len(want & found) >= 0.98 * len(want)


def test_a_paraphrase_that_only_the_latent_directions_find(spark, monkeypatch):
    # the corpus uses rare words and their synonyms together; the paraphrase has the synonyms, and of the
    # item only words that half of the corpus has
    frequent = [f"c{i}" for i in range(9)]
    rare, synonyms = [f"r{i}" for i in range(6)], [f"s{i}" for i in range(6)]
    item = " ".join(w for pair in zip(frequent, rare) for w in pair) + " " + " ".join(frequent[6:]) + ". " + "ans0 ans1"
    others = [" ".join(f"o{k}x{j}" for j in range(10)) for k in range(40)]
    bench = spark.createDataFrame([(1, item), (2, " ".join(synonyms)), *((10 + k, t) for k, t in enumerate(others))], "item_id long, text string")
    close = item
    for a, b in zip(rare, synonyms):
        close = close.replace(a, b)
    rows = [(k, " ".join(rare + synonyms)) for k in range(30)] + [(1000 + k, " ".join(["ans1", "ans0", *reversed(frequent)])) for k in range(1500)]
    rows += [(3000 + k, others[k % 40]) for k in range(400)]
    rows += [(5000, f"{filler(1)} {close} {' '.join(synonyms * 3)} {filler(2)}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(M, "MAX_FREQUENCY", 1.0)
    both = {(r.doc_id, r.item_id) for r in M.leaks(docs, bench).collect()}
    monkeypatch.setattr(M.Space, "solve", plain_only(M.Space.solve))
    plain = {(r.doc_id, r.item_id) for r in M.leaks(docs, bench).collect()}
    assert (5000, 1) in both and (5000, 1) not in plain and plain <= both


def plain_only(solve):
    def without(self, share, passages):
        solve(self, share, passages)
        self.latent = self.latent * 0

    return without
