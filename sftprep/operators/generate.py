"""U1 batch generation and J2 reply attachment.

``generate_replies`` runs a user-supplied text-generation client over Arrow
batches with ``mapInPandas``.  The client is built once per Python worker by
``client_factory`` (lazy module-level cache) and receives a whole batch of
message lists, so it can issue requests concurrently.  Concurrency is the
number of partitions; batch size is ``spark.sql.execution.arrow.maxRecordsPerBatch``.

Task retries make calls at-least-once.  Callers cut lineage right after this
stage (``sftprep.session.cut_lineage``) so recomputation re-reads saved
replies instead of calling the model again, and replies carry a
``request_id`` so duplicates from speculative or retried tasks can be dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sftprep.session import ensure_library_on_workers, factory_key

# Generation defaults.
DEFAULT_MAX_TOKENS = 4096
DEFAULT_TEMPERATURE = 0.5

Client = Callable[..., Sequence[str | None]]

_CLIENTS: dict[str, Any] = {}


def worker_client(key: str, factory: Callable[[], Any]) -> Any:
    """The client of this Python worker process, built on first use.

    A top-level function, so closures shipped to workers reach it by
    reference and share this module's cache (a dict captured by a closure
    would be copied into every task).
    """
    client = _CLIENTS.get(key)
    if client is None:
        client = _CLIENTS[key] = factory()
    return client


def _reply_error(reply: Any) -> str | None:
    """None for a usable reply, else the text recorded in the ``error`` column."""
    if isinstance(reply, str):
        return None
    if reply is None:
        return "empty reply"
    if isinstance(reply, BaseException):
        return f"{type(reply).__name__}: {reply}"
    return f"non-string reply: {type(reply).__name__}"


def _messages_to_py(v: Any) -> list[dict]:
    if v is None:
        return []
    out = []
    for m in v:
        if isinstance(m, dict):
            out.append({"role": m.get("role"), "content": m.get("content")})
        else:  # Row-like
            out.append({"role": m["role"], "content": m["content"]})
    return out


def request_id(*parts: Column | str) -> Column:
    """Stable id of a prompt: md5 over its key parts."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat_ws("\u001f", *[c.cast("string") for c in cols]))


def short_id(col: Column) -> Column:
    """A request id as bytes, half as long if it is one of ``request_id``; different ids stay different.

    Ids of any other form are longer than those 16 bytes.
    """
    raw = F.unhex(col)
    ours = (F.octet_length(col) == 32) & (F.lower(col) == col) & raw.isNotNull()
    return F.when(ours, raw).when(col.isNotNull(), F.concat(F.lit(bytes(17)), F.encode(col, "UTF-8")))


def generate_replies(
    df: DataFrame,
    client_factory: Callable[[], Client],
    messages_col: str = "messages",
    carry: Sequence[str] = (),
    request_id_col: str | None = None,
    max_tokens: int = DEFAULT_MAX_TOKENS,
    temperature: float = DEFAULT_TEMPERATURE,
    cache_key: str | None = None,
    known_col: str | None = None,
) -> DataFrame:
    """``carry…, [request_id], response STRING, error STRING`` per input row.

    With ``known_col`` rows that have a reply there keep it and are not sent to
    the client; ``reused`` tells them apart.

    ``carry`` columns pass through Python unchanged, which avoids joining the
    replies back to their prompts.  A client exception or a NULL reply is
    reported in ``error`` with a NULL ``response``; it never fails the task.
    """
    key = cache_key or factory_key(client_factory)
    ensure_library_on_workers(df.sparkSession)
    carry = list(carry)
    if request_id_col and request_id_col not in carry:
        carry.append(request_id_col)
    known = [F.col(known_col).alias("_known")] if known_col else []
    in_df = df.select(*carry, F.col(messages_col).alias("_messages"), *known)
    fields = [in_df.schema[c] for c in carry]
    out_schema = T.StructType(
        fields
        + [
            T.StructField("response", T.StringType(), True),
            T.StructField("error", T.StringType(), True),
        ]
        + ([T.StructField("reused", T.BooleanType(), False)] if known_col else [])
    )
    opts = {"max_tokens": max_tokens, "temperature": temperature}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = worker_client(key, client_factory)
        for pdf in batches:
            ask = pdf["_known"].isna() if known_col else pd.Series(True, index=pdf.index)
            prompts = [_messages_to_py(v) for v in pdf.loc[ask, "_messages"]]
            try:
                replies = list(client(prompts, **opts)) if prompts else []
                if len(replies) != len(prompts):
                    raise RuntimeError(f"client returned {len(replies)} replies for {len(prompts)} prompts")
                errors = [_reply_error(r) for r in replies]
                replies = [r if e is None else None for r, e in zip(replies, errors)]
            except Exception as exc:  # noqa: BLE001 - reported per row
                replies = [None] * len(prompts)
                errors = [f"{type(exc).__name__}: {exc}"] * len(prompts)
            out = pdf[carry].copy() if carry else pd.DataFrame(index=pdf.index)
            out["response"] = pdf["_known"].astype(object) if known_col else None
            out["error"] = None
            out.loc[ask, "response"] = pd.Series(replies, index=pdf.index[ask], dtype=object)
            out.loc[ask, "error"] = pd.Series(errors, index=pdf.index[ask], dtype=object)
            if known_col:
                out["reused"] = ~ask
            yield out

    return in_df.mapInPandas(run, out_schema)


def dedupe_replies(
    replies: DataFrame, request_id_col: str = "request_id", response_col: str = "response"
) -> DataFrame:
    """One reply per request (retried or speculative tasks may repeat calls).

    NULL replies answer nothing; of several answers the smallest is kept, so the
    choice does not depend on the order of rows.  ``unanswered`` reports the rest.
    """
    usable = replies.filter(F.col(response_col).isNotNull())
    return usable.groupBy(request_id_col).agg(F.min(response_col).alias(response_col))


def unanswered(
    requests: DataFrame, replies: DataFrame, request_id_col: str = "request_id", response_col: str = "response"
) -> DataFrame:
    """Requests without any usable reply: nothing was returned, or only NULLs."""
    usable = replies.filter(F.col(response_col).isNotNull()).select(request_id_col)
    return requests.join(usable, request_id_col, "left_anti")


def attach_replies(
    prompts: DataFrame, replies: DataFrame, request_id_col: str = "request_id", how: str = "inner"
) -> DataFrame:
    """Equi-join prompts with replies produced offline, on ``request_id``."""
    return prompts.join(replies, on=request_id_col, how=how)
