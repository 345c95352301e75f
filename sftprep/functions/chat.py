"""Conversations, role normalization, chat rendering, message lists.

All of it is native Column code (``array``/``struct``/``transform``/
``array_join``); nothing leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftprep.functions.templates import ColumnLike, fill_optional

# ---------------------------------------------------------------------------
# Fixed values.
MERGED_PROMPT = "{instruction}[[\nYour input is:\n{input}]]"
CHAT_TEMPLATE = """Below are some instructions that describe some tasks. Write responses that appropriately complete each request.

        ### Instruction:
        {INPUT}

        ### Response:
        {OUTPUT}"""
ROLE_MAP = {"human": "user", "gpt": "assistant", "system": "system"}
VALID_ROLES = ("system", "user", "assistant")
INVALID_ROLE_MESSAGE = "Invalid role: "
# ---------------------------------------------------------------------------

# The template splits into a preamble (the default system text) and the turn
# block; the turn block splits into the instruction part and the response part.
TURN_GLUE = "\n\n"
PREAMBLE, _TURN = CHAT_TEMPLATE.split(TURN_GLUE, 1)
INSTRUCTION_HEAD, _rest = _TURN.split("{INPUT}", 1)
RESPONSE_HEAD = _rest.split("{OUTPUT}", 1)[0].removeprefix(TURN_GLUE)


def merged_prompt(values: Mapping[str, ColumnLike], template: str = MERGED_PROMPT) -> Column:
    """``{instruction}`` plus the input section only when input is non-empty."""
    return fill_optional(template, values)


def sharegpt_conversation(human: Column, gpt: Column) -> Column:
    """``[{from: human, value}, {from: gpt, value}]``."""
    return F.array(
        F.struct(F.lit("human").alias("from"), human.alias("value")),
        F.struct(F.lit("gpt").alias("from"), gpt.alias("value")),
    )


def normalize_roles(conversation: Column) -> Column:
    """from/value -> role/content; human -> user, gpt -> assistant."""
    def one(m: Column) -> Column:
        role = F.lit(None).cast("string")
        for src, dst in ROLE_MAP.items():
            role = F.when(m["from"] == src, F.lit(dst)).otherwise(role)
        return F.struct(F.coalesce(role, m["from"]).alias("role"), m["value"].alias("content"))

    return F.transform(conversation, one)


def render_chat(messages: Column, system_prompt: str | Column | None = None) -> Column:
    """Render ``ARRAY<STRUCT<role, content>>`` to training text.

    The first system message replaces the preamble; otherwise ``system_prompt``
    does (P11); otherwise the template's preamble.  Each user message becomes
    an instruction block and each assistant message a response block; blocks
    are joined by a blank line, so a one-turn conversation reproduces the
    template exactly.
    """
    if isinstance(system_prompt, Column):
        default = F.when(system_prompt != "", system_prompt).otherwise(F.lit(PREAMBLE))
    else:
        default = F.lit(system_prompt or PREAMBLE)  # an empty prompt is no prompt
    systems = F.filter(messages, lambda m: m["role"] == "system")
    head = F.coalesce(F.try_element_at(systems, F.lit(1))["content"], default)
    turns = F.filter(messages, lambda m: m["role"] != "system")
    blocks = F.transform(
        turns,
        lambda m: F.concat(
            F.when(m["role"] == "assistant", F.lit(RESPONSE_HEAD)).otherwise(F.lit(INSTRUCTION_HEAD)),
            F.coalesce(m["content"], F.lit("")),
        ),
    )
    return F.concat(head, F.lit(TURN_GLUE), F.array_join(blocks, TURN_GLUE))


def llm_message(role: Column, content: Column) -> Column:
    """``STRUCT<role, content>``; an unknown role fails the query."""
    return F.when(
        role.isin(*VALID_ROLES), F.struct(role.alias("role"), content.alias("content"))
    ).otherwise(F.raise_error(F.concat(F.lit(INVALID_ROLE_MESSAGE), F.coalesce(role, F.lit("null")))))


def split_valid_roles(df: DataFrame, role_col: str = "role") -> tuple[DataFrame, DataFrame]:
    """P13 quarantine mode: (rows with a valid role, rows with ``error`` text)."""
    ok = F.col(role_col).isin(*VALID_ROLES)
    good = df.filter(ok)
    bad = df.filter(~ok | F.col(role_col).isNull()).withColumn(
        "error", F.concat(F.lit(INVALID_ROLE_MESSAGE), F.coalesce(F.col(role_col), F.lit("null")))
    )
    return good, bad


PART_FIELDS = ("type", "text", "url", "image")


def _part(type_: str, text: Column | None = None, url: Column | None = None,
          image: Column | None = None) -> Column:
    null_s = F.lit(None).cast("string")
    null_img = F.lit(None).cast("struct<bytes:binary,path:string>")
    return F.struct(
        F.lit(type_).alias("type"),
        (text if text is not None else null_s).alias("text"),
        (url if url is not None else null_s).alias("url"),
        (image if image is not None else null_img).alias("image"),
    )


def text_part(text: Column) -> Column:
    return _part("text", text=text)


def image_part(image: Column | None = None, url: Column | None = None) -> Column:
    return _part("image", url=url, image=image)


def vlm_message(role: Column, text: Column, image_url: Column | None = None) -> Column:
    """Content ``[text]``, or ``[image(url), text]`` when a URL is given."""
    plain = F.array(text_part(text))
    if image_url is None:
        content = plain
    else:
        has_url = image_url.isNotNull() & (image_url != F.lit(""))
        content = F.when(has_url, F.array(image_part(url=image_url), text_part(text))).otherwise(plain)
    msg = F.struct(role.alias("role"), content.alias("content"))
    return F.when(role.isin(*VALID_ROLES), msg).otherwise(
        F.raise_error(F.concat(F.lit(INVALID_ROLE_MESSAGE), F.coalesce(role, F.lit("null"))))
    )


def assemble_messages(
    df: DataFrame,
    key: str,
    order: str,
    role: str = "role",
    content: str = "content",
    block_size: int | None = None,
) -> DataFrame:
    """A2: one row per ``key`` with ``messages`` ordered by ``order``.

    ``collect_list`` is partially aggregated map-side; ``sort_array`` on the
    (order, role, content) struct restores turn order after the shuffle.
    The nested list is the whole conversation by definition; with
    ``block_size`` the output is one row per (key, ``block``) of at most that
    many turns instead, so no group is unbounded (``render_conversations``
    and ``transcripts`` build whole-conversation text from such blocks).
    """
    if block_size:
        blk = F.floor(F.col(order) / F.lit(block_size)).alias("block")
        grouped = df.groupBy(key, blk)
        keys = [key, "block"]
    else:
        grouped = df.groupBy(key)
        keys = [key]
    return grouped.agg(
        F.sort_array(
            F.collect_list(F.struct(F.col(order).alias("o"), F.col(role).alias("role"),
                                    F.col(content).alias("content")))
        ).alias("_m")
    ).select(
        *keys,
        F.transform("_m", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias(
            "messages"
        ),
    )


# ---------------------------------------------------------------------------
# Message rows -> one text per conversation, without gathering a whole
# conversation's rows in one aggregation buffer.
#
# Level 1 groups by (key, turn block) so every group holds at most
# ``block_size`` turns and is partially aggregated map-side; level 2 joins
# the per-block strings (one per block) in block order.  A conversation that
# holds a third of all rows is therefore split into many bounded groups
# before the shuffle.

DEFAULT_BLOCK = 256


def ordered_join(
    df: DataFrame,
    key: str,
    order: str,
    piece: Column,
    sep: str,
    block_size: int = DEFAULT_BLOCK,
    keep: Column | None = None,
) -> DataFrame:
    """``key, text, n``: ``piece`` of the kept rows joined with ``sep`` in ``order``."""
    kept = F.lit(True) if keep is None else keep
    blk = F.floor(F.col(order) / F.lit(block_size)).alias("_blk")
    lvl1 = df.groupBy(key, blk).agg(
        F.array_join(
            F.transform(
                F.sort_array(F.collect_list(F.when(kept, F.struct(F.col(order).alias("o"), piece.alias("p"))))),
                lambda x: x["p"],
            ),
            sep,
        ).alias("_t"),
        F.count(F.when(kept, F.lit(1))).alias("_n"),
    )
    return lvl1.groupBy(key).agg(
        F.array_join(
            F.transform(
                F.sort_array(F.collect_list(F.when(F.col("_n") > 0, F.struct(F.col("_blk"), F.col("_t"))))),
                lambda x: x["_t"],
            ),
            sep,
        ).alias("text"),
        F.sum("_n").alias("n"),
    )


def render_conversations(
    df: DataFrame,
    key: str,
    order: str,
    role: str = "role",
    content: str = "content",
    system_prompt: str | None = None,
    block_size: int = DEFAULT_BLOCK,
) -> DataFrame:
    """P18 over message rows: ``key, text`` equal to ``render_chat`` of the ordered list.

    One two-level aggregation carries both the joined turn blocks and the
    first system message (``min_by`` over the system rows' turn numbers;
    rows whose ordering value is NULL are skipped), so no extra scan or join.
    """
    is_sys = F.col(role) == "system"
    piece = F.concat(
        F.when(F.col(role) == "assistant", F.lit(RESPONSE_HEAD)).otherwise(F.lit(INSTRUCTION_HEAD)),
        F.coalesce(F.col(content), F.lit("")),
    )
    sys_order = F.when(is_sys, F.col(order))
    blk = F.floor(F.col(order) / F.lit(block_size)).alias("_blk")
    lvl1 = df.groupBy(key, blk).agg(
        F.array_join(
            F.transform(
                F.sort_array(F.collect_list(F.when(~is_sys, F.struct(F.col(order).alias("o"), piece.alias("p"))))),
                lambda x: x["p"],
            ),
            TURN_GLUE,
        ).alias("_t"),
        F.count(F.when(~is_sys, F.lit(1))).alias("_n"),
        F.min_by(F.col(content), sys_order).alias("_sys"),
        F.min(sys_order).alias("_sys_o"),
    )
    lvl2 = lvl1.groupBy(key).agg(
        F.array_join(
            F.transform(
                F.sort_array(F.collect_list(F.when(F.col("_n") > 0, F.struct(F.col("_blk"), F.col("_t"))))),
                lambda x: x["_t"],
            ),
            TURN_GLUE,
        ).alias("_body"),
        F.min_by(F.col("_sys"), F.col("_sys_o")).alias("_sys"),
    )
    default = F.lit(system_prompt or PREAMBLE)
    return lvl2.select(
        key, F.concat(F.coalesce(F.col("_sys"), default), F.lit(TURN_GLUE), F.col("_body")).alias("text")
    )


def transcripts(
    df: DataFrame, key: str, order: str, role: str = "role", content: str = "content",
    block_size: int = DEFAULT_BLOCK,
) -> DataFrame:
    """A2 as text: ``key, n_messages, transcript`` with ``role: content`` lines in order."""
    piece = F.concat(F.col(role), F.lit(": "), F.coalesce(F.col(content), F.lit("")))
    return ordered_join(df, key, order, piece, "\n", block_size).select(
        key, F.col("n").alias("n_messages"), F.col("text").alias("transcript")
    )


_RENDERERS: dict[str, object] = {}


def worker_renderer(key: str, factory) -> object:
    """This worker's renderer, built once (top-level so workers share the cache)."""
    r = _RENDERERS.get(key)
    if r is None:
        r = _RENDERERS[key] = factory()
    return r


def render_with(messages: Column, renderer_factory, cache_key: str | None = None) -> Column:
    """P18 with a model-specific chat template supplied by the user.

    ``renderer_factory()`` (called once per Python worker) returns a function
    ``list[{"role", "content"}] -> str``; it runs in Arrow batches.
    """
    from sftprep.session import ensure_library_on_workers, factory_key

    key = cache_key or factory_key(renderer_factory)
    ensure_library_on_workers()

    @F.pandas_udf("string")
    def rendered(batch: pd.Series) -> pd.Series:
        fn = worker_renderer(key, renderer_factory)
        out = []
        for msgs in batch:
            if msgs is None:
                out.append(None)
                continue
            out.append(fn([{"role": m["role"], "content": m["content"]} for m in msgs]))
        return pd.Series(out)

    return rendered(messages)
