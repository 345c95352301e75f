import hashlib
import itertools
import random
import re
import zlib

import duckdb

from sftprep.llm import conversation_repair as R

from conftest import SF001


def brute(roles, marks):
    """The least (cost, audit) of all edit strings, tried one by one."""
    n, best = len(roles), None
    for size in range(n, n + 4):
        for letters in itertools.product("DIKR", repeat=size):
            if sum(x != "I" for x in letters) != n:
                continue
            for targets in itertools.product("ua", repeat=sum(x in "IR" for x in letters)):
                cost, read, i, at = 0, "", 0, iter(targets)
                for x in letters:
                    if x == "I":
                        cost, read = cost + 3, read + next(at)
                        continue
                    mark, role = marks[i], roles[i]
                    i += 1
                    if x == "D":
                        cost += 4
                        continue
                    if mark in (1, 2):
                        cost = 10**6
                    cost += 3 * (mark == 3) + 3 * (x == "R")
                    read += role[:1] if x == "K" else next(at)
                    if x == "K" and not role:
                        cost = 10**6
                value = (cost, "".join(letters))
                if cost < 10**6 and re.fullmatch("(s?(ua)+)?", read) and (best is None or value < best):
                    best = value
    return best


def test_agenda_equals_brute_force():
    rng = random.Random(5)
    for _ in range(60):
        n = rng.randint(0, 4)
        roles = [rng.choice(["user", "assistant", "system", "tool", ""]) for _ in range(n)]
        marks = [rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(n)]
        assert R.lightest(list(zip(roles, marks)), R.ENDS, ["start"])["start"] == brute(roles, marks), (roles, marks)


def test_blocks_joined_equal_one_agenda():
    rng = random.Random(7)
    for _ in range(80):
        rows = [(rng.choice(["user", "assistant", "system", "x"]), rng.choice([0, 0, 0, 0, 1, 2, 3])) for _ in range(rng.randint(1, 40))]
        whole = R.lightest(rows, R.ENDS, ["start"])["start"]
        cuts = sorted({0, len(rows), *(rng.randint(0, len(rows)) for _ in range(5))})
        ways = []
        for a, b in zip(cuts, cuts[1:]):
            ways.append({(s, t): v for t in R.STATES for s, v in R.lightest(rows[a:b], [t], R.STATES).items()})
        both, levels = R.joined(ways)
        value, span = min((v, k) for k, v in both.items() if k[0] == "start" and k[1] in R.ENDS)
        assert value == whole
        spans = R.unfolded(span, levels)
        assert "".join(w[k][1] for w, k in zip(ways, spans)) == whole[1]
        assert [t for _, t in spans[:-1]] == [s for s, _ in spans[1:]]


def expected(rows):
    """Report and repaired digest by conversation, in plain Python."""
    talks = {}
    for conv, turn, role, text in rows:
        talks.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        talks[conv] += [(turn, "user" if h == 4 else role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    out = {}
    for conv, talk in talks.items():
        talk.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, marks = set(), []
        for _, role, text in talk:
            body = re.sub(r"[\x20\x09-\x0D]", "", text)
            marks.append(1 if not body else 2 if (role, text) in seen else 0 if body[-1] in ".!?" else 3)
            seen.add((role, text))
        turns = [t for t, *_ in talk if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        roles = [r for _, r, _ in talk]
        illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
        cost, audit = R.lightest(list(zip(roles, marks)), R.ENDS, ["start"])["start"]
        lines, _ = R.replay(roles, [t for *_, t in talk], audit, "start")
        assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in lines))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
        out[conv] = (gaps, marks.count(1), marks.count(2), marks.count(3), illegal, cost, audit, digest)
    return out


def run(spark, tmp_path, rows, name):
    path = str(tmp_path / name)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS conv", "2 AS part", "3 AS since", "'x' AS same")
    df.write.parquet(path + "/conversations.parquet")
    return R.op12_conversation_repair(spark, path).collect()


def edge_rows():
    rng = random.Random(3)
    rows = [(None, 0, "user", "no id."), (None, None, None, None), (7, None, "user", "a."), (7, None, "user", "a."), (7, 5, "assistant", "b"), (8, 0, "", "x."), (8, 1, "tool", " \t")]
    for conv in range(100, 160):
        rows += [(conv, t + rng.randint(0, 1), rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", "No", "", "Why?", "é!\n", None])) for t in range(rng.randint(1, 9))]
    rows += [(9, t, "user" if t % 2 == 0 else "assistant", f"turn {t % 300}.") for t in range(700)]  # one hot conversation
    rows += [(10, 3, "user", f"tie {t % 40}.") for t in range(200)]  # all of one turn
    return rows


def test_rows_equal_plain_python(spark, tmp_path):
    rows = edge_rows()  # the hot conversation fills several blocks
    got = {r.conv_id: tuple(r)[1:] for r in run(spark, tmp_path, rows, "edges")}
    assert got == expected(rows)


def test_empty_table(spark, tmp_path):
    assert run(spark, tmp_path, [], "none") == []


def test_conversations_equal_plain_python_and_sql(spark):
    got = {r.conv_id: tuple(r)[1:] for r in R.op12_conversation_repair(spark, SF001).collect()}
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got == expected(rows)
    duckdb.sql(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM '{SF001}/conversations.parquet'")
    assert {r[0]: tuple(r[1:]) for r in duckdb.sql(R.OP12_SQL).fetchall()} == got
