"""Operator 7: chat formatting by prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes an example of its own: all turns before it are the
context, and only its reply is trainable (``loss_start`` and ``loss_length`` in
code points of ``formatted``).  A conversation that does not end with an
assistant turn gets one more example without a trainable part, so the output
holds every turn.  An example holds its whole prefix by definition; nothing
larger than one conversation is gathered.

The template marks a turn as ``<|role|>role<|text|>text<|end|>``.  In roles and
texts every backslash is doubled, and each control string gets a backslash
after its first character, so no control string is left and the step is exactly
reversible.

Defined results: null texts and null roles are empty; rows of a conversation
are ordered by (turn, role, text), null turns first, so ties have one order;
repeated rows stay as turns of their own; a null conversation id is one
conversation; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sftprep.llm.common import stored, table

CONTROL = ["<|", "<s>", "</s>", "[INST]", "[/INST]"]
ROLE, TEXT, END = "<|role|>", "<|text|>", "<|end|>"
PROBE = "</s>[INST] ok [/INST]"


def escaped(c: Column) -> Column:
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for s in CONTROL:
        c = F.replace(c, F.lit(s), F.lit(s[0] + "\\" + s[1:]))
    return c


def unescaped(c: Column) -> Column:
    for s in CONTROL:
        c = F.replace(c, F.lit(s[0] + "\\" + s[1:]), F.lit(s))
    return F.replace(c, F.lit("\\\\"), F.lit("\\"))


def expand(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", trained: str = "assistant") -> DataFrame:
    """Examples: (conv, example_no, formatted, loss_start, loss_length)."""
    empty = F.lit("")
    rows = conversations.select(
        F.col(conv).alias("conv"),
        F.struct(
            F.col(turn).alias("turn"), F.coalesce(F.col(role), empty).alias("role"), F.coalesce(F.col(text), empty).alias("text")
        ).alias("t"),
    )
    turns = rows.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    head = F.transform("turns", lambda t: F.concat(F.lit(ROLE), escaped(t["role"]), F.lit(TEXT)))
    body = F.transform("turns", lambda t: escaped(t["text"]))
    marked = turns.select("conv", "turns", head.alias("head"), body.alias("body"), F.size("turns").alias("n"))
    targets = F.filter(F.sequence(F.lit(1), F.col("n")), lambda i: (F.element_at("turns", i)["role"] == trained) | (i == F.col("n")))
    one = marked.select("conv", "turns", "head", "body", F.posexplode(targets).alias("example_no", "i"))
    segments = F.zip_with("head", "body", lambda h, b: F.concat(h, b, F.lit(END)))
    context = F.concat(F.array_join(F.slice(segments, 1, F.col("i") - 1), ""), F.element_at("head", F.col("i")))
    target = F.element_at("body", F.col("i"))
    learns = F.element_at("turns", F.col("i"))["role"] == trained
    return one.select("conv", "example_no", context.alias("context"), target.alias("target"), learns.alias("learns")).select(
        F.col("conv").alias(conv),
        "example_no",
        F.concat("context", "target", F.lit(END)).alias("formatted"),
        F.length("context").alias("loss_start"),
        F.when(F.col("learns"), F.length("target")).otherwise(0).alias("loss_length"),
        "learns",
    )


def read_back(examples: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Per conversation, from the written examples: its turns and the text under the loss mask."""
    loss = F.col("formatted").substr(F.col("loss_start") + 1, F.col("loss_length"))
    part = F.when(F.col("learns"), F.struct("example_no", unescaped(loss).alias("loss")))
    whole = examples.groupBy(conv).agg(
        F.max_by("formatted", "example_no").alias("whole"),
        F.sort_array(F.collect_list(part)).alias("parts"),
        F.sum(F.length("formatted").cast("long")).alias("formatted_chars"),
    )

    def turn(segment: Column) -> Column:
        both = F.split(segment, r"<\|text\|>")
        return F.struct(unescaped(F.substring(both[0], len(ROLE) + 1, 2**31 - 1)).alias("role"), unescaped(both[1]).alias("text"))

    segments = F.split("whole", r"<\|end\|>")
    turns = F.transform(F.slice(segments, 1, F.size(segments) - 1), turn)
    return whole.select(
        F.col(conv), turns.alias("turns"), F.array_join(F.transform("parts", lambda p: p["loss"]), "").alias("loss_text"), "formatted_chars"
    )


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``conversations`` and the control-string probe, formatted, written and read back."""
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text")
    )
    examples = stored(expand(talks.unionByName(probe)), "chat-examples")
    back = read_back(examples)
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


def _escaped_sql(c: str) -> str:
    c = rf"replace({c}, '\', '\\')"
    for before, after in (("<|", r"<\|"), ("<s>", r"<\s>"), ("</s>", r"<\/s>"), ("[INST]", r"[\INST]"), ("[/INST]", r"[\/INST]")):
        c = f"replace({c}, '{before}', '{after}')"
    return c


OP7_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'
), s AS (
  SELECT *, length({_escaped_sql('role')}) + length({_escaped_sql('text')}) + 8 + 8 + 7 AS seg,
    row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), p AS (
  SELECT *, sum(seg) OVER (PARTITION BY conv_id ORDER BY i) AS upto FROM s
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(upto) FILTER (role = 'assistant' OR i = n) AS BIGINT) AS formatted_chars
FROM p GROUP BY conv_id
"""
