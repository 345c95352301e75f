import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest

from llm_helpers import ROWS, edge_documents, no_documents
from sftprep.llm import periodic_runs as P

from conftest import SF001


def brute(words):
    """All runs by their definition: (start, length, period) by start and period."""
    n, best = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                best.setdefault((i, j + q), q)  # smaller periods come first
            i = max(j, i + 1)
    return sorted(((s, e - s, q) for (s, e), q in best.items()), key=lambda r: (r[0], r[2]))


def brute_row(words):
    runs = brute(words)
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    digest = hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
    short = hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest()
    return (len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None, digest, short)


def words_of(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def own(texts):
    return [list(map(tuple, r.tolist())) for r in P.runs_of_texts([[w.encode() for w in t] for t in texts])]


def noisy(rng):
    """Pieces with planted powers of words that are periodic themselves, cut and disturbed."""
    out = []
    for _ in range(rng.randint(1, 5)):
        unit = [rng.choice("ab" if rng.random() < 0.6 else "abcdefgh") for _ in range(rng.randint(1, 40))]
        if rng.random() < 0.5:
            unit = unit * rng.randint(1, 6) + [rng.choice("abc")] * rng.randint(0, 12)
        stretch = unit * rng.randint(1, 8)
        stretch = stretch[rng.randint(0, len(unit) - 1) : len(stretch) - rng.randint(0, len(unit) - 1)]
        if stretch and rng.random() < 0.3:
            stretch[rng.randrange(len(stretch))] = rng.choice("abx")
        out += stretch + [rng.choice("abcxyz") for _ in range(rng.randint(0, 5))]
    return out[: rng.randint(1, 900)]


@pytest.mark.parametrize("seed", range(12))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    texts = [noisy(rng) for _ in range(60)]
    assert own(texts) == [brute(t) for t in texts]


def test_regular_words():
    fibonacci, thue = "a", [bin(i).count("1") % 2 for i in range(700)]
    x, y = "a", "ab"
    while len(y) < 900:
        x, y = y, y + x
    fibonacci = list(y)
    texts = [fibonacci, list(map(str, thue)), list("a" * 500), list("a" * 24), list("a" * 23), list("ab" * 12), list("ab" * 11 + "a"), [], list(("a" * 30 + "b") * 9)]
    assert own(texts) == [brute(t) for t in texts]


def test_bounds_may_be_raised_only():
    text = [[w.encode() for w in "ab" * 20 + "cde" * 9]]
    assert [r.tolist() for r in P.runs_of_texts(text, 30, 3)] == [[[0, 40, 2]]]
    with pytest.raises(ValueError):
        P.runs_of_texts(text, 10, 3)


def test_documents_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    rows = {r.doc_id: tuple(r)[1:] for r in P.op11_periodic_runs(spark, SF001).collect()}
    assert len(rows) == len(docs)
    for d in docs:
        assert rows[d.doc_id] == brute_row(words_of(d.doc_id, d.text)), d.doc_id
    assert sum(r[0] > 0 for r in rows.values()) > 10


def test_edges(spark):
    out = P.periodic_runs(edge_documents(spark)).collect()
    assert len(out) == len(ROWS)
    by = {r.doc_id: r for r in out}
    assert by[0].runs == by[1].runs == by[2].runs == by[4].runs == [] and by[1].n_words == 0
    assert [tuple(r) for r in by[3].runs] == [(3, 60_000, 1)]
    assert by[3].collapsed == "Alpha beta gamma. word omega" and None in by
    assert P.periodic_runs(no_documents(spark)).count() == 0
