"""Question / answer prompts, reply parsing, QA pair and training record projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftprep.functions.templates import ColumnLike, fill

# ---------------------------------------------------------------------------
# Fixed values (byte-exact prompt texts; both start and end with a newline).
QUESTION_PROMPT = """
You are a teacher, you task is to generate questions for your students based on the given context.
Generation Guidelines:
1. Generate questions diverse and cover different aspects of the context.
2. Use the same language as the context.
3. Only use provided context to generate questions, do not make up any information.
<context>
{context}
</context>
Generate {target_num} questions.
Use `,` to separate each question.
Only Return the questions, no other text.
"""

ANSWER_PROMPT = """
Your task is to answer the question based on the given context.
Generation Guidelines:
1. Use the same language as the context.
2. Only use provided context to generate answer, do not make up any information.
3. If the question is not related to the context, just return "No information found".
4. Must provide as much information as possible from the context to answer the question.
5. Answer must follow the following order: first cite the relevant context in the <reference> tag, then make inferences and finally give the answer in the <answer> tag.
<context>
{context}
</context>
<question>
{question}
</question>
"""
QUESTION_SEPARATOR = ","
USER_ROLE = "user"
# ---------------------------------------------------------------------------


def user_message(content: Column) -> Column:
    """ARRAY<STRUCT<role, content>> holding one user message."""
    return F.array(F.struct(F.lit(USER_ROLE).alias("role"), content.alias("content")))


def question_prompt(context: ColumnLike, target_num: ColumnLike = 2) -> Column:
    """P1 prompt text."""
    return fill(QUESTION_PROMPT, {"context": context, "target_num": target_num})


def answer_prompt(context: ColumnLike, question: ColumnLike) -> Column:
    """P2 prompt text (single pass: a ``{question}`` inside the context stays as is)."""
    return fill(ANSWER_PROMPT, {"context": context, "question": question})


def split_questions(reply: Column, separator: str = QUESTION_SEPARATOR) -> Column:
    """Split on the literal separator; blanks kept, no trimming, no count limit.

    An empty reply yields one empty question.  The separator is quoted so it is
    matched literally by the regex-based ``split``.
    """
    return F.split(reply, "\\Q" + separator + "\\E", -1)


def explode_questions(
    df: DataFrame, reply_col: str, keep: list[str], separator: str = QUESTION_SEPARATOR
) -> DataFrame:
    """One row per (row, question) with ``question_no`` from 0, order kept."""
    return df.select(
        *keep,
        F.posexplode(split_questions(F.col(reply_col), separator)).alias("question_no", "question"),
    ).withColumn("question_no", F.col("question_no").cast("int"))


QA_PAIR_COLUMNS = ("question", "answer", "source", "chunk_id", "chunk")


def qa_pair(df: DataFrame) -> DataFrame:
    """P5: the QA pair record, fields in the record's order."""
    return df.select(
        F.col("question").cast("string"),
        F.col("answer").cast("string"),
        F.col("source").cast("string"),
        F.col("chunk_id").cast("int"),
        F.col("chunk").cast("string"),
    )


def training_record(df: DataFrame, output_name: str = "output") -> DataFrame:
    """instruction = question, input = "", output (or ``response``) = answer."""
    return df.select(
        F.col("question").alias("instruction"),
        F.lit("").alias("input"),
        F.col("answer").alias(output_name),
    )


def training_record_json(df: DataFrame, output_name: str = "output", keep: tuple[str, ...] = ()) -> DataFrame:
    """P6 as one JSON object string per row in column ``record`` (non-ASCII kept)."""
    return df.select(
        *keep,
        F.to_json(
            F.struct(
                F.col("question").alias("instruction"),
                F.lit("").alias("input"),
                F.col("answer").alias(output_name),
            )
        ).alias("record")
    )
