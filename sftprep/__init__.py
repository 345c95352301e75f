"""sftprep: supervised fine-tuning data preparation as Spark DataFrame jobs.

Sub-packages:

* ``sources``   – document / manifest / image scans and the sinks (S1–S12)
* ``functions`` – Column builders: prompts, chat rendering, tokens (P1–P19)
* ``operators`` – chunking, batch generation, resume, ranking, VLM joins
* ``plans``     – the four end-to-end programs composed from the above
* ``streaming`` – incremental chunking / prompt building (T1)

Every public function takes DataFrames and plain keyword parameters and
returns a DataFrame; what reaches the driver is bounded by partitions, shards or
other parameters, never by the data.  The most used
entry points are re-exported here (imported lazily).
"""

from sftprep.session import build_session, checkpoint_root, cut_lineage

_LAZY = {
    "chunk_documents": "sftprep.operators.chunking",
    "generate_replies": "sftprep.operators.generate",
    "skip_done_chunks": "sftprep.operators.resume",
    "seeded_sample": "sftprep.operators.ranking",
    "with_row_index": "sftprep.operators.ranking",
    "generate_qa_pairs": "sftprep.plans.qa",
    "run_generation": "sftprep.plans.qa",
    "prepare_chat_dataset": "sftprep.plans.chat_dataset",
    "prepare_vlm_dataset": "sftprep.plans.vlm_dataset",
    "create_vendor_dataset": "sftprep.plans.vlm_dataset",
    "calibration_set": "sftprep.plans.calibration",
    "scan_documents": "sftprep.sources.files",
    "run_incremental": "sftprep.streaming.incremental",
}

__all__ = ["build_session", "checkpoint_root", "cut_lineage", *_LAZY]


def __getattr__(name: str):
    if name in _LAZY:
        import importlib

        return getattr(importlib.import_module(_LAZY[name]), name)
    raise AttributeError(f"module 'sftprep' has no attribute {name!r}")
