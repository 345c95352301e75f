"""Program D: calibration sample -> chat text -> truncated tokens.

    O1 (seeded sample of conversations) -> A2/P18 (rendered text) -> P19
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftprep.functions import chat as C
from sftprep.functions.tokens import whitespace_tokens
from sftprep.operators.ranking import seeded_sample


def calibration_set(
    messages: DataFrame,
    key: str = "conv_id",
    order: str = "turn",
    role: str = "role",
    content: str = "text",
    num_samples: int = 512,
    seed: int = 42,
    max_tokens: int = 2048,
    tokens=None,
    renderer_factory=None,
    messages_col: str | None = None,
) -> DataFrame:
    """``tokens`` per sampled conversation; all other columns dropped.

    ``messages`` is one row per message, or with ``messages_col`` one row per
    conversation whose messages are that ``ARRAY<STRUCT<role, content>>``.  ``tokens`` may be a function
    Column -> Column (e.g. ``subword_token_ids`` bound to a tokenizer);
    whitespace tokens are the default.  The N sampled ids are broadcast, a
    bound fixed by ``num_samples``.  ``renderer_factory`` plugs in a
    model-specific chat template (``chat.render_with``); the default is the
    built-in template, rendered from bounded turn blocks.
    """
    ids = seeded_sample(messages.select(key), num_samples, key, seed, distinct=True)
    sampled = messages.join(F.broadcast(ids), key, "left_semi")
    if messages_col:
        listed = F.col(messages_col)
        rendered = C.render_with(listed, renderer_factory) if renderer_factory else C.render_chat(listed)
        text = sampled.select(key, rendered.alias("text"))
    elif renderer_factory is None:
        text = C.render_conversations(sampled, key, order, role=role, content=content)
    else:  # a user template needs the whole (sampled) conversation as one list
        msgs = C.assemble_messages(sampled, key, order, role=role, content=content)
        text = msgs.select(key, C.render_with(F.col("messages"), renderer_factory).alias("text"))
    tok = tokens(F.col("text")) if tokens else whitespace_tokens(F.col("text"), max_tokens)
    return text.select(tok.alias("tokens"))
