"""Program B: training records -> merged prompts -> conversations -> chat text.

    S5 -> P7/P8 [-> J3] -> P9 -> P10/P11

Everything is native Column work; only conversation extension (k > 1)
shuffles, to pair rows by position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftprep.functions import chat as C
from sftprep.operators.ranking import extend_conversations


def prepare_chat_dataset(
    records: DataFrame,
    id_col: str | None = None,
    conversation_extension: int = 1,
    system_prompt: str | None = None,
    seed: int = 3407,
    merged_prompt: str = C.MERGED_PROMPT,
    output_col: str = "output",
) -> DataFrame:
    """``[id], conversations ARRAY<STRUCT<role, content>>, text`` per record.

    ``records`` has ``instruction``, ``input`` and ``output`` (or
    ``output_col``).  With ``conversation_extension`` k > 1 each record's
    conversation is followed by those of k-1 seeded shuffled copies; that
    needs a unique ``id_col`` (position order).
    """
    values = {c: F.col(c) for c in records.columns}
    conv = C.sharegpt_conversation(C.merged_prompt(values, merged_prompt), F.col(output_col))
    keep = [id_col] if id_col else []
    df = records.select(*keep, conv.alias("conversations"))
    if conversation_extension > 1:
        if not id_col:
            raise ValueError("conversation_extension > 1 needs id_col")
        df = extend_conversations(df, id_col, "conversations", conversation_extension, seed)
    df = df.withColumn("conversations", C.normalize_roles(F.col("conversations")))
    return df.withColumn("text", C.render_chat(F.col("conversations"), system_prompt))
