"""P1–P14 projections: byte-exact prompts, parsing edge cases, records, chat text."""

import json

import pytest
from pyspark.sql import functions as F

from sftprep.functions import chat as C
from sftprep.functions import prompts as P


def one(spark, col, schema="x string", row=("v",)):
    return spark.createDataFrame([row], schema).select(col.alias("out")).first()["out"]


def test_question_prompt_byte_exact(spark):
    ctx = "Some {context} text with {question} and } braces {"
    got = one(spark, P.question_prompt(F.col("x"), 2), row=(ctx,))
    assert got == P.QUESTION_PROMPT.format(context=ctx, target_num=2)
    assert got.startswith("\nYou are a teacher, you task is") and got.endswith("\n")


def test_answer_prompt_leaves_placeholder_in_context(spark):
    ctx = "context mentions {question} literally"
    df = spark.createDataFrame([(ctx, "Q?")], "c string, q string")
    got = df.select(P.answer_prompt(F.col("c"), F.col("q")).alias("p")).first()["p"]
    assert got == P.ANSWER_PROMPT.format(context=ctx, question="Q?")
    assert "context mentions {question} literally" in got


@pytest.mark.parametrize("reply,expected", [
    ("Q1, Q2", ["Q1", " Q2"]),
    ("a,b,", ["a", "b", ""]),
    ("", [""]),
    ("甲，乙", ["甲，乙"]),
])
def test_split_questions(spark, reply, expected):
    assert one(spark, P.split_questions(F.col("x")), row=(reply,)) == expected


def test_explode_questions_numbers_in_order(spark):
    df = spark.createDataFrame([(1, "a,b,c")], "k int, r string")
    rows = P.explode_questions(df, "r", keep=["k"]).orderBy("question_no").collect()
    assert [(r.question_no, r.question) for r in rows] == [(0, "a"), (1, "b"), (2, "c")]


def test_training_record_and_json(spark):
    df = spark.createDataFrame([("问题?", "答案")], "question string, answer string")
    rec = P.training_record(df).first().asDict()
    assert rec == {"instruction": "问题?", "input": "", "output": "答案"}
    alt = P.training_record(df, output_name="response").columns
    assert alt == ["instruction", "input", "response"]
    js = P.training_record_json(df).first()["record"]
    assert json.loads(js) == rec and "问题" in js  # non-ASCII kept


@pytest.mark.parametrize("inp,expected", [
    ("", "do it"), (None, "do it"), ("x", "do it\nYour input is:\nx")])
def test_merged_prompt(spark, inp, expected):
    df = spark.createDataFrame([("do it", inp)], "i string, n string")
    got = df.select(C.merged_prompt({"instruction": F.col("i"), "input": F.col("n")}).alias("m")).first()["m"]
    assert got == expected


def test_sharegpt_and_roles(spark):
    df = spark.createDataFrame([("q", "a")], "h string, g string")
    conv = C.sharegpt_conversation(F.col("h"), F.col("g"))
    norm = df.select(C.normalize_roles(conv).alias("m")).first()["m"]
    assert [(m.role, m.content) for m in norm] == [("user", "q"), ("assistant", "a")]


def test_render_matches_template(spark):
    df = spark.createDataFrame([("do X", "done")], "i string, o string")
    msgs = C.normalize_roles(C.sharegpt_conversation(F.col("i"), F.col("o")))
    got = df.select(C.render_chat(msgs).alias("t")).first()["t"]
    assert got == C.CHAT_TEMPLATE.replace("{INPUT}", "do X").replace("{OUTPUT}", "done")
    sys_got = df.select(C.render_chat(msgs, "Be brief.").alias("t")).first()["t"]
    assert sys_got.startswith("Be brief.\n\n        ### Instruction:\n        do X")


def test_render_system_message_wins(spark):
    df = spark.sql("""SELECT array(named_struct('role','system','content','S'),
                                   named_struct('role','user','content','U')) AS m""")
    got = df.select(C.render_chat(F.col("m"), "ignored").alias("t")).first()["t"]
    assert got == "S\n\n" + C.INSTRUCTION_HEAD + "U"


def test_invalid_role_raises(spark):
    df = spark.createDataFrame([("tool", "x")], "r string, c string")
    with pytest.raises(Exception, match="Invalid role: tool"):
        df.select(C.llm_message(F.col("r"), F.col("c")).alias("m")).collect()
    good, bad = C.split_valid_roles(df, "r")
    assert good.count() == 0 and bad.first()["error"] == "Invalid role: tool"


def test_vlm_message_with_and_without_url(spark):
    df = spark.createDataFrame([("user", "t", "http://x/a.png"), ("user", "t", None)], "r string, t string, u string")
    rows = df.select(C.vlm_message(F.col("r"), F.col("t"), F.col("u")).alias("m")).collect()
    assert [p.type for p in rows[0].m.content] == ["image", "text"]
    assert rows[0].m.content[0].url == "http://x/a.png"
    assert [p.type for p in rows[1].m.content] == ["text"]


def test_assemble_messages_in_turn_order(spark):
    df = spark.createDataFrame([(1, 2, "user", "b"), (1, 0, "system", "s"), (1, 1, "user", "a")],
                               "cid int, turn int, role string, content string")
    m = C.assemble_messages(df, "cid", "turn").first()["messages"]
    assert [x.content for x in m] == ["s", "a", "b"]


def test_block_rendering_equals_list_rendering(spark):
    rows = [(1, t, "system" if t == 0 else ("user" if t % 2 else "assistant"), f"m{t}") for t in range(23)]
    rows += [(2, 0, "user", "only"), (3, 0, "system", "s-only"), (4, 5, "assistant", "late"), (4, 2, "system", "S4")]
    df = spark.createDataFrame(rows, "cid int, turn int, role string, content string")
    listed = C.assemble_messages(df, "cid", "turn").select("cid", C.render_chat(F.col("messages")).alias("t"))
    exp = {r.cid: r.t for r in listed.collect()}
    for block in (1, 2, 5, 256):
        got = {r.cid: r.text for r in C.render_conversations(df, "cid", "turn", block_size=block).collect()}
        assert got == exp
    tr = {r.cid: (r.n_messages, r.transcript) for r in C.transcripts(df, "cid", "turn", block_size=3).collect()}
    assert tr[1][0] == 23 and tr[1][1].split("\n")[:2] == ["system: m0", "user: m1"]
    assert tr[4] == (2, "system: S4\nassistant: late")


def _len_tokenizer():
    return lambda s: [len(w) for w in s.split()]


def test_token_truncation(spark):
    from sftprep.functions.tokens import subword_token_ids, whitespace_tokens

    df = spark.createDataFrame([("a  bb\tccc\n dddd ",), ("",)], "t string")
    rows = df.select(whitespace_tokens(F.col("t"), 3).alias("w"),
                     subword_token_ids(F.col("t"), _len_tokenizer, 2).alias("s")).collect()
    assert rows[0].w == ["a", "bb", "ccc"] and rows[0].s == [1, 2]
    assert rows[1].w == [] and rows[1].s == []


def test_assemble_messages_blocks(spark):
    df = spark.createDataFrame([(1, t, "user", f"m{t}") for t in range(7)], "cid int, turn int, role string, content string")
    rows = sorted((r.block, [m.content for m in r.messages]) for r in C.assemble_messages(df, "cid", "turn", block_size=3).collect())
    assert rows == [(0, ["m0", "m1", "m2"]), (1, ["m3", "m4", "m5"]), (2, ["m6"])]


def test_fill_equals_str_format_on_random_templates(spark):
    import random

    from sftprep.functions.templates import fill

    rng = random.Random(11)
    atoms = ["x", " ", "\n", "é", "{{", "}}", "{a}", "{b}", "{a}{a}", "<ctx>", "甲"]
    templates = ["".join(rng.choice(atoms) for _ in range(rng.randint(0, 12))) for _ in range(40)]
    values = [("v{a}" + "é" * i, "{b}} w" * (i % 3)) for i in range(5)]
    df = spark.createDataFrame(values, "a string, b string")
    cols = [fill(t, {"a": F.col("a"), "b": F.col("b")}).alias(f"t{i}") for i, t in enumerate(templates)]
    rows = df.select("a", "b", *cols).collect()
    for r in rows:
        for i, t in enumerate(templates):
            assert r[f"t{i}"] == t.format(a=r.a, b=r.b), (t, r.a, r.b)


def test_fill_rejects_format_specs_and_missing_fields(spark):
    from sftprep.functions.templates import fill, fill_optional

    with pytest.raises(ValueError):
        fill("{a:>5}", {"a": F.lit("x")})
    with pytest.raises(KeyError):
        fill("{a} {b}", {"a": F.lit("x")})
    with pytest.raises(ValueError):
        fill_optional("{a}[[ unclosed", {"a": F.lit("x")})
