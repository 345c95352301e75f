"""Operator 12: conversation structure repair by Knuth's lightest-derivation agenda.

A repaired conversation reads ``(s?(ua)+)?`` by its roles' initials: nothing, or
an optional system turn followed by user and assistant turns in alternation.
The edits of a row are Keep (0), Rerole to user or assistant (3) and Delete (4);
an empty user or assistant turn may be Inserted (3) anywhere.  Blank and repeated
rows can only be deleted; a truncated row that stays costs 3 more.

The search is a weighted hypergraph of deductions.  An item [i, state] says that
the rows from i on can be repaired into what the state accepts.  A row's edit and
the item behind it deduce an item before it:

    [edit of row i, reading x]  [i + 1, state after x]  =>  [i, state]
    [insert x]                  [i, state after x]      =>  [i, state]

An item's weight is (cost, rows used, audit); a deduction adds its cost, its row
and puts its letter in front.  Every deduction raises (cost, rows used) and keeps
the order of its antecedent's weights, so it is a superior function and the
agenda may finalise items in order of weight, each once, until the goal is final.

A conversation of any length is cut into blocks of BLOCK rows.  A block that holds
a whole conversation is solved for its goal; any other is solved from every state
to every state, [block, s, t], and blocks are joined pairwise by the deduction
[left, s, u] [right, u, t] => [both, s, t].  Audits of one cost for the same rows
never begin one another (a longer one has further inserts and costs more), so
joining them keeps their order too.

Defined results: a null role or text is one space; rows of a conversation are
ordered by (turn, role, text), null turns first; rows that repeat an earlier role
and text are duplicates, blank ones only blank; a role whose initial is none of
s, u and a cannot be kept; a null conversation id is one conversation; an empty
table gives no rows; columns beside the four are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sftprep.llm.common import column, ship, stored, table

#: rows (and characters) of a block
BLOCK, BLOCK_CHARS = 256, 4_000_000
WHITE = " \t\n\x0b\x0c\r"
ROLES = {"u": "user", "a": "assistant"}
#: what is still to come: a whole conversation, a first user turn, an assistant turn, a user turn or the end
NEXT = {("start", "s"): "first", ("start", "u"): "assistant", ("first", "u"): "assistant", ("assistant", "a"): "user", ("user", "u"): "assistant"}
STATES = ["start", "first", "assistant", "user"]
BEFORE = {t: [(s, x) for (s, x), after in NEXT.items() if after == t] for t in STATES}
ENDS = ["start", "user"]
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
KEEP, REROLE, DELETE, INSERT, CUT_SHORT = 0, 3, 4, 3, 3
WAYS = "array<struct<s:string,t:string,cost:bigint,audit:string>>"
HEAD = (
    "conv string, part int, block int, n int, first_role string, last_role string, first_turn bigint, last_turn bigint,"
    " min_turn bigint, max_turn bigint, turns bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint"
)
BLOCKS = f"{HEAD}, ways {WAYS}, roles array<string>, texts array<string>, marks array<int>"


def edits(role: str, mark: int) -> list[tuple[int, str, str | None]]:
    """(cost, letter, initial read or None) of a row."""
    out = [(DELETE, "D", None)]
    if mark in (BLANK, DUPLICATE):
        return out
    more = CUT_SHORT if mark == TRUNCATED else 0
    if role[:1] in ("s", "u", "a"):
        out.append((KEEP + more, "K", role[0]))
    return out + [(REROLE + more, "R", x) for x in ROLES]


def lightest(rows: list[tuple[str, int]], ends: list[str], goals: list[str]) -> dict[str, tuple[int, str]]:
    """(cost, audit) of the rows (role, mark) from each goal state to any of ``ends``."""
    n, final = len(rows), {}
    agenda = [(0, 0, "", n, t) for t in ends]  # axioms: nothing left to repair
    left = {(0, s) for s in goals}
    choices = [edits(*r) for r in rows]
    while agenda and left:
        cost, used, audit, i, state = heapq.heappop(agenda)
        if (i, state) in final:
            continue
        final[i, state] = (cost, audit)
        left.discard((i, state))
        for s, x in BEFORE[state]:
            if x in ROLES and (i, s) not in final:
                heapq.heappush(agenda, (cost + INSERT, used, "I" + audit, i, s))
        if i:
            for more, letter, x in choices[i - 1]:
                for s in [state] if x is None else [s for s, y in BEFORE[state] if y == x]:
                    if (i - 1, s) not in final:
                        heapq.heappush(agenda, (cost + more, used + 1, letter + audit, i - 1, s))
    return {s: final[0, s] for s in goals if (0, s) in final}


def replay(roles: list[str], texts: list[str], audit: str, state: str) -> tuple[list[tuple[str, str]], str]:
    """The repaired (role, text) rows of an audit from a state, and the state reached."""
    out, i = [], 0
    for letter in audit:
        wanted = "a" if state == "assistant" else "u"
        if letter == "D":
            i += 1
            continue
        if letter == "I":
            out.append((ROLES[wanted], ""))
            state = NEXT[state, wanted]
            continue
        role = roles[i] if letter == "K" else ROLES[wanted]
        out.append((role, texts[i]))
        state = NEXT[state, role[0]]
        i += 1
    return out, state


def joined(ways: list[dict]) -> tuple[dict, list]:
    """Neighbouring blocks' ways (s, t) -> (cost, audit), joined pairwise up to one; and where each was cut."""
    levels = []
    while len(ways) > 1:
        pairs, cuts = [], []
        for left, right in zip(ways[::2], ways[1::2]):
            both, cut = {}, {}
            for (s, u), (c, a) in left.items():
                for (v, t), (d, b) in right.items():
                    if u == v and ((s, t) not in both or (c + d, a + b) < both[s, t]):
                        both[s, t], cut[s, t] = (c + d, a + b), u
            pairs.append(both)
            cuts.append(cut)
        if len(ways) % 2:
            pairs.append(ways[-1])
        levels.append((len(ways), cuts))
        ways = pairs
    return ways[0], levels


def unfolded(goal: tuple[str, str], levels: list) -> list[tuple[str, str]]:
    """The (s, t) of every block on the way of the goal."""
    spans = [goal]
    for size, cuts in reversed(levels):
        wider = []
        for k, (s, t) in enumerate(spans):
            if 2 * k + 1 < size:
                u = cuts[k][s, t]
                wider += [(s, u), (u, t)]
            else:
                wider.append((s, t))
        spans = wider
    return spans


def _legal(a: str, b: str) -> bool:
    return a[:1] + b[:1] in ("su", "ua", "au")


class _Block:
    """The rows of one block while they arrive."""

    def __init__(self, conv: str | None, number: int, begins: bool):
        self.conv, self.number, self.begins = conv, number, begins
        self.roles, self.texts, self.turns, self.marks, self.chars = [], [], [], [], 0

    def add(self, turn: int | None, role: str, text: str, mark: int) -> None:
        self.turns.append(turn)
        self.roles.append(role)
        self.texts.append(text)
        self.marks.append(mark)
        self.chars += len(text)

    def row(self, part: int, ends: bool) -> dict:
        known = [t for t in self.turns if t is not None]
        starts = ["start"] if self.begins else STATES
        rows = list(zip(self.roles, self.marks))
        ways = []
        for t in [ENDS] if ends else [[t] for t in STATES]:
            found = lightest(rows, t, starts)
            ways += [{"s": s, "t": "end" if ends else t[0], "cost": c, "audit": a} for s, (c, a) in found.items()]
        return {
            "conv": self.conv, "part": part, "block": self.number, "n": len(rows), "first_role": self.roles[0], "last_role": self.roles[-1],
            "first_turn": self.turns[0], "last_turn": self.turns[-1], "min_turn": min(known, default=None), "max_turn": max(known, default=None),
            "turns": len(set(known)), "blank": self.marks.count(BLANK), "duplicate": self.marks.count(DUPLICATE), "truncated": self.marks.count(TRUNCATED),
            "illegal": sum(not _legal(a, b) for a, b in zip(self.roles, self.roles[1:])),
            "ways": ways, "roles": self.roles, "texts": self.texts, "marks": self.marks,
        }


def fault(role: str, text: str, repeated: bool) -> int:
    seen = text.rstrip(WHITE)
    if not seen:
        return BLANK
    if repeated:
        return DUPLICATE
    return 0 if seen[-1] in ".!?" else TRUNCATED


BLOCK_TYPE = pa.schema(
    [("conv", pa.string()), ("part", pa.int32()), ("block", pa.int32()), ("n", pa.int32()), ("first_role", pa.string()), ("last_role", pa.string())]
    + [(c, pa.int64()) for c in ("first_turn", "last_turn", "min_turn", "max_turn", "turns", "blank", "duplicate", "truncated", "illegal")]
    + [("ways", pa.list_(pa.struct([("s", pa.string()), ("t", pa.string()), ("cost", pa.int64()), ("audit", pa.string())])))]
    + [("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("marks", pa.list_(pa.int32()))]
)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows into solved blocks; a conversation may go on from the task before and into the next."""
    # the task's first rows may belong to a conversation that began in the task before
    part, number, held, previous, out, size = TaskContext.get().partitionId(), 0, None, None, [], 0

    def record() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(out, schema=BLOCK_TYPE)

    for batch in batches:
        for conv, turn, role, text, since in zip(*(column(batch, c).to_pylist() for c in ("conv", "turn", "role", "text", "since"))):
            row = (conv, turn, role, text)
            full = held is not None and (len(held.roles) >= BLOCK or held.chars >= BLOCK_CHARS)
            if held is None or held.conv != conv or full:
                begins = held is not None and held.conv != conv
                if held is not None:
                    out.append(held.row(part, ends=begins))
                    size += held.chars
                    if len(out) >= 1000 or size >= BLOCK_CHARS:
                        yield record()
                        out, size = [], 0
                held, number = _Block(conv, number, begins), number + 1
            # since: 1 if the same role and text stand at an earlier turn; equal rows are neighbours
            held.add(turn, role, text, fault(role, text, since == 1 or row == previous))
            previous = row
    if held is not None:
        out.append(held.row(part, ends=False))
    if out:
        yield record()


def solved_blocks(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Conversations sorted, cut into blocks and solved; one row per block."""
    space = F.lit(" ")
    plain = rows.select(
        F.col(conv).cast("string").alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), space).alias("role"), F.coalesce(F.col(text), space).alias("text")
    ).withColumn("same", F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text").cast("binary")))
    # role and text that stand at several turns: digests only are shuffled, counted before they are
    place = F.struct("turn")
    often = plain.groupBy("conv", "same").agg(F.min(place).alias("least"), F.max(place).alias("most")).filter(~F.col("least").eqNullSafe(F.col("most")))
    often = often.select(F.col("conv").alias("c"), F.col("same").alias("s"), F.col("least.turn").alias("from"))
    later = F.col("s").isNotNull() & ~F.col("turn").eqNullSafe(F.col("from"))
    marked = plain.join(often, plain["conv"].eqNullSafe(often["c"]) & (plain["same"] == often["s"]), "left").select("conv", "turn", "role", "text", later.cast("int").alias("since"))
    order = ["conv", "turn", "role"]
    ordered = marked.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    return ordered.mapInArrow(_blocks, BLOCKS)


REPORT = f"conv string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, chosen {WAYS.replace('s:string', 'part:int,block:int,s:string')}"


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One conversation a row: its blocks' ways joined, and the way chosen in each block."""
    fields = [(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    chosen_type = pa.list_(pa.struct([("part", pa.int32()), ("block", pa.int32()), ("s", pa.string()), ("t", pa.string()), ("cost", pa.int64()), ("audit", pa.string())]))
    schema = pa.schema([("conv", pa.string()), *fields, ("audit", pa.string()), ("chosen", chosen_type)])
    out, size = [], 0
    for batch in batches:
        for i in range(len(batch)):
            conv, blocks = column(batch, "conv")[i].as_py(), column(batch, "blocks")[i].as_py()
            whole = {k: sum(b[k] for b in blocks) for k in ("blank", "duplicate", "truncated", "illegal")}
            pairs = list(zip(blocks, blocks[1:]))
            whole["illegal"] += sum(not _legal(a["last_role"], b["first_role"]) for a, b in pairs)
            turns = sum(b["turns"] for b in blocks) - sum(b["first_turn"] is not None and a["last_turn"] == b["first_turn"] for a, b in pairs)
            known = [b for b in blocks if b["turns"]]
            whole["gaps"] = max(b["max_turn"] for b in known) - min(b["min_turn"] for b in known) + 1 - turns if known else 0
            ways = [{(w["s"], w["t"]): (w["cost"], w["audit"]) for w in b["ways"]} for b in blocks]
            both, levels = joined(ways)
            goal = min((v, k) for k, v in both.items() if k[0] == "start" and k[1] in ("end", *ENDS))
            (whole["cost"], whole["audit"]), span = goal
            whole["chosen"] = [
                {"part": b["part"], "block": b["block"], "s": s, "t": t, "cost": w[s, t][0], "audit": w[s, t][1]} for b, w, (s, t) in zip(blocks, ways, unfolded(span, levels))
            ]
            out.append({"conv": conv} | whole)
            size += len(whole["audit"])
            if len(out) >= 1000 or size >= BLOCK_CHARS:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out, size = [], 0
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def _messages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    schema = pa.schema([("conv", pa.string()), ("part", pa.int32()), ("block", pa.int32()), ("messages", kind)])
    for batch in batches:
        for i in range(0, len(batch), 100):
            out = []
            for r in batch.slice(i, 100).to_pylist():
                rows, _ = replay(r["roles"], r["texts"], r["audit"], r["s"])
                out.append({k: r[k] for k in ("conv", "part", "block")} | {"messages": [{"role": a, "text": b} for a, b in rows]})
            yield pa.RecordBatch.from_pylist(out, schema=schema)


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(report, repaired): a row per conversation with its faults, cost and audit; and the repaired
    messages in blocks (conv, part, block, messages), ordered by (part, block)."""
    ship(rows.sparkSession)
    kind = rows.schema[conv].dataType
    blocks = stored(solved_blocks(rows, conv, turn, role, text), "conversation-blocks")
    heads = F.struct("part", "block", *[c for c in blocks.columns if c not in ("conv", "part", "block", "roles", "texts", "marks")])
    each = blocks.groupBy("conv").agg(F.sort_array(F.collect_list(heads)).alias("blocks"))
    report = stored(each.mapInArrow(_report, REPORT), "conversation-report")
    chosen = report.select(F.explode("chosen").alias("w")).select("w.part", "w.block", "w.s", "w.audit")
    repaired = blocks.select("conv", "part", "block", "roles", "texts").join(chosen, ["part", "block"])
    repaired = repaired.mapInArrow(_messages, "conv string, part int, block int, messages array<struct<role:string,text:string>>")
    named = lambda df: df.withColumn("conv", F.col("conv").cast(kind)).withColumnRenamed("conv", conv)
    return named(report.drop("chosen")), named(repaired)


def damaged(conversations: DataFrame) -> DataFrame:
    """The check's faults, by each row's crc32."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    h = F.crc32(key) % 20
    text = F.coalesce("text", space)
    text = F.when(h == 1, F.lit("")).when(h == 2, F.translate(text, ".!?", "")).otherwise(text)
    role = F.when(h == 4, F.lit("user")).otherwise(F.coalesce("role", space))
    copies = F.array_repeat(F.lit(1), F.when(h == 3, 2).otherwise(1))
    return conversations.filter(h != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and digest of the repaired rows of all damaged ``conversations``."""
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    report, repaired = repair(damaged(talks))
    lines = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["text"])), "\n")
    held = repaired.filter(F.size("messages") > 0).select(F.col("conv_id").alias("c"), F.struct("part", "block", lines.alias("lines")).alias("b"))
    texts = held.groupBy("c").agg(F.array_join(F.sort_array(F.collect_list("b"))["lines"], "\n").alias("whole"))
    ids = talks.groupBy("conv_id").agg(F.lit(1).alias("one")).select(F.col("conv_id").alias("id"))

    def zero(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0).cast("long")).alias(name)

    both = ids.join(report, ids["id"].eqNullSafe(report["conv_id"]), "left").join(texts, F.col("id").eqNullSafe(F.col("c")), "left")
    return both.select(
        F.col("id").alias("conv_id"),
        *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.sha2(F.coalesce("whole", F.lit("")).cast("binary"), 256).alias("repaired_sha256"),
    )


def _least(*values: str) -> str:
    return f"least({', '.join(values)})"


def _put(cost: str, letter: str, value: str, line: str = "''") -> str:
    """A value is an 8-digit cost, the audit, chr(1) and the repaired lines; strings compare as (cost, audit)."""
    audit = f"substr({value}, 9, instr({value}, chr(1)) - 9)"
    return f"lpad(CAST(CAST(substr({value}, 1, 8) AS INT) + {cost} AS VARCHAR), 8, '0') || '{letter}' || {audit} || chr(1) || {line} || substr({value}, instr({value}, chr(1)) + 1)"


def _line(role: str, text: str) -> str:
    return f"({role} || ':' || {text} || chr(10))"


def _edited(state: str) -> str:
    """A state's value before row r, from the values behind it."""
    more = f"(CASE WHEN r.mark = {TRUNCATED} THEN {CUT_SHORT} ELSE 0 END)"
    column_of = {"start": "q.s0", "first": "q.s1", "assistant": "q.s2", "user": "q.s3"}
    options = [_put(str(DELETE), "D", column_of[state])]
    for x in "sua":
        if (state, x) in NEXT:
            behind = column_of[NEXT[state, x]]
            options.append(f"CASE WHEN r.mark NOT IN ({BLANK}, {DUPLICATE}) AND substr(r.role, 1, 1) = '{x}' THEN {_put(more, 'K', behind, _line('r.role', 'r.txt'))} ELSE '99999999' || chr(1) END")
            if x in ROLES:
                new = f"'{ROLES[x]}'"
                options.append(f"CASE WHEN r.mark NOT IN ({BLANK}, {DUPLICATE}) THEN {_put(f'{REROLE} + {more}', 'R', behind, _line(new, 'r.txt'))} ELSE '99999999' || chr(1) END")
    return _least(*options)


def _inserted(a: str, b: str, role: str) -> str:
    return _least(a, _put(str(INSERT), "I", b, _line(f"'{role}'", "''")))


OP12_SQL = f"""
WITH RECURSIVE tab AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 1, 2, 3, 4, 5, 6, 7], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS txt,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations
), hashed AS (
  SELECT keyed.*, xor(list_reduce(list_concat([4294967295], list_transform(string_split(k, ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS h
  FROM keyed, tab
), harmed AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN h = 1 THEN '' WHEN h = 2 THEN replace(replace(replace(txt, '.', ''), '!', ''), '?', '') ELSE txt END AS txt,
    unnest(CASE WHEN h = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM hashed WHERE h <> 0
), ranked AS (
  SELECT *, rtrim(txt, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS seen,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, txt, copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, txt ORDER BY turn NULLS FIRST, copy) AS again
  FROM harmed
), marked AS (
  SELECT *, CASE WHEN seen = '' THEN {BLANK} WHEN again > 1 THEN {DUPLICATE} WHEN right(seen, 1) NOT IN ('.', '!', '?') THEN {TRUNCATED} ELSE 0 END AS mark,
    lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM ranked
), counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (mark = {BLANK}) AS blank, count(*) FILTER (mark = {DUPLICATE}) AS duplicate, count(*) FILTER (mark = {TRUNCATED}) AS truncated,
    count(*) FILTER (i > 1 AND substr(before, 1, 1) || substr(role, 1, 1) NOT IN ('su', 'ua', 'au')) AS illegal
  FROM marked GROUP BY conv_id
), q AS (
  SELECT conv_id, n AS i, '00000000' || chr(1) AS s0,
    '00000006II' || chr(1) || 'user:' || chr(10) || 'assistant:' || chr(10) AS s1, '00000003I' || chr(1) || 'assistant:' || chr(10) AS s2, '00000000' || chr(1) AS s3
  FROM counted
  UNION ALL
  SELECT conv_id, i, {_inserted('e0', 'a', 'user')}, {_inserted('e1', 'a', 'user')}, a, {_inserted('e3', 'a', 'user')}
  FROM (
    SELECT *, {_inserted('e2', 'e3', 'assistant')} AS a FROM (
      SELECT q.conv_id, q.i - 1 AS i, {_edited('start')} AS e0, {_edited('first')} AS e1, {_edited('assistant')} AS e2, {_edited('user')} AS e3
      FROM q JOIN marked r ON r.conv_id IS NOT DISTINCT FROM q.conv_id AND r.i = q.i
    )
  )
), goal AS (SELECT conv_id, s0 FROM q WHERE i = 0)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(CAST(substr(s0, 1, 8) AS BIGINT), 0) AS cost, coalesce(substr(s0, 9, instr(s0, chr(1)) - 9), '') AS audit,
  sha256(coalesce(rtrim_one, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids
LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN (SELECT *, left(substr(s0, instr(s0, chr(1)) + 1), greatest(0, length(substr(s0, instr(s0, chr(1)) + 1)) - 1)) AS rtrim_one FROM goal) g
  ON g.conv_id IS NOT DISTINCT FROM ids.conv_id
"""
