"""The check queries of this package and their SQL, by name."""

from __future__ import annotations

from sftprep.llm.bpe import op10_bpe
from sftprep.llm.chat_format import OP7_SQL, op7_chat_format
from sftprep.llm.conversation_repair import OP12_SQL, op12_conversation_repair
from sftprep.llm.decontaminate import op2_decontamination
from sftprep.llm.line_dedup import OP8_SQL, op8_line_dedup
from sftprep.llm.near_dups import op1_near_duplicates
from sftprep.llm.periodic_runs import op11_periodic_runs
from sftprep.llm.quality_model import op5_quality
from sftprep.llm.quality_rules import op9_quality_rules
from sftprep.llm.token_counts import op13_token_counts
from sftprep.llm.token_files import op6_token_files
from sftprep.llm.toxicity import op3_toxicity
from sftprep.llm.url_filter import op4_url_rules

QUERIES = {
    "op1_near_duplicates": op1_near_duplicates,
    "op2_decontamination": op2_decontamination,
    "op3_toxicity": op3_toxicity,
    "op4_url_rules": op4_url_rules,
    "op5_quality": op5_quality,
    "op6_token_files": op6_token_files,
    "op7_chat_format": op7_chat_format,
    "op8_line_dedup": op8_line_dedup,
    "op9_quality_rules": op9_quality_rules,
    "op10_bpe": op10_bpe,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_token_counts": op13_token_counts,
}
#: the others are compared with brute force, round trips or held-out labels in tests/llm
ORACLES = {"op7_chat_format": OP7_SQL, "op8_line_dedup": OP8_SQL, "op12_conversation_repair": OP12_SQL}
