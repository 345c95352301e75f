"""Program A: documents -> chunks -> questions -> answers -> QA pairs -> training records.

Plan shape (only the UDF steps cross to Python)::

    scan -> C1/C2 -> J1 (left-anti, below the model) -> spread on (source, chunk_id)
         -> P1 -> U1 -> lineage cut -> P3/P4 -> P2 -> U1 -> lineage cut -> P5
         [-> X2 append to existing]

Shuffles: the resume join (keys, or a broadcast of measured size) and the
spread that balances model calls.  The chunk text is carried through both
generation stages, so no join back to the chunk table is needed.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor, as_completed
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sftprep.functions import prompts as P
from sftprep.operators.chunking import chunk_documents
from sftprep.operators.generate import attach_replies, dedupe_replies, generate_replies, request_id, short_id, unanswered
from sftprep.operators.reply_log import WAVE, ReplyLog, Waves, by_wave, of_wave, with_known
from sftprep.operators.resume import merge_pairs, skip_done_chunks
from sftprep.session import cut_lineage, scratch_path
from sftprep.sources.files import read_pairs_or_empty, source_id
from sftprep.sources.saved_rows import can_fetch, dealt_by_place, fetch, place, save_rows
from sftprep.sources.sinks import PAIR_BUCKETS, append_pairs, recover_pairs, write_training_json


NO_TEXT = "document has no text"
#: a wave's pairs go to one file for each of these, at most PAIR_BUCKETS
PAIRS_PER_FILE = 10_000
PAIR_ROW_SCHEMA = "question string, answer string, source string, chunk_id int, chunk string, question_no int"
ERROR_SCHEMA = "stage string, source string, chunk_id int, question_no int, error string"


@dataclass
class QAResult:
    pairs: DataFrame  # question, answer, source, chunk_id, chunk, question_no (existing + new)
    errors: DataFrame  # stage, source, chunk_id, question_no, error
    new_pairs: DataFrame  # the pairs generated by this run only


def _default_call_partitions(spark) -> int:
    try:
        return 2 * spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - no SparkContext view (Connect)
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def question_requests(chunks: DataFrame, generate_num: int) -> DataFrame:
    """P1 prompts as one-message conversations, keyed by ``request_id``.

    The id covers the kind, the chunk key and the prompt text, so replies made
    for another template or other chunk settings are never reused.
    """
    prompt = P.question_prompt(F.col("chunk"), generate_num)
    return chunks.select(
        "source",
        "chunk_id",
        "chunk",
        request_id(F.lit("q"), "source", "chunk_id", F.md5(prompt)).alias("request_id"),
        P.user_message(prompt).alias("messages"),
    )


def answer_requests(questions: DataFrame, *extra: str) -> DataFrame:
    """P2 prompts for every (chunk, question), keyed like ``question_requests``; ``extra`` columns pass through."""
    prompt = P.answer_prompt(F.col("chunk"), F.col("question"))
    return questions.select(
        "source",
        "chunk_id",
        "chunk",
        "question_no",
        "question",
        request_id(F.lit("a"), "source", "chunk_id", "question_no", F.md5(prompt)).alias("request_id"),
        P.user_message(prompt).alias("messages"),
        *extra,
    )


# ---------------------------------------------------------------- J2: offline replies
# For replies produced outside Spark (a batch inference service): export the
# requests, let the service answer them, and join the replies back on
# ``request_id``.  Replies are de-duplicated first (a service may answer twice).
#
# Saved requests hold a chunk's text once: prompts are made from it when they
# are read, an answer request knows the place of its chunk, and replies are
# joined with ids and places, so no shuffle carries the text.


@dataclass
class SavedRequests:
    """Exported requests, lineage cut: ``requests`` has the columns of ``question_requests`` or ``answer_requests``."""

    requests: DataFrame
    saved: DataFrame  # the saved rows, without prompts
    by_place: bool  # else replies are joined with ``requests``, chunk and all


CHUNK_KEYS = ["source", "chunk_id", "chunk"]


def _columns(df: DataFrame, names: list[str]) -> T.StructType:
    return T.StructType([df.schema[n] for n in names])


def save_question_requests(requests: DataFrame, generate_num: int) -> SavedRequests:
    """The requests of ``question_requests`` saved; prompts are made again from the saved chunks."""
    saved = save_rows(requests.drop("messages"), "question-requests")
    prompt = P.question_prompt(F.col("chunk"), generate_num)
    whole = saved.withColumn("messages", P.user_message(prompt)).select(*requests.columns)
    return SavedRequests(whole, saved, can_fetch(requests.sparkSession))


def _attach_saved(saved: DataFrame, replies: DataFrame, columns: list[str], partitions: int | None = None) -> DataFrame:
    """J2 over saved rows: ``columns, place, response``; only ids, places and replies are shuffled."""
    asked = saved.select(short_id(F.col("request_id")).alias("request_id"), place().alias("place"))
    once = dedupe_replies(replies.select(short_id(F.col("request_id")).alias("request_id"), "response"))
    found = attach_replies(asked, once)
    return fetch(dealt_by_place(found.drop("request_id"), "place", partitions), _columns(saved, columns), "place")


def offline_question_requests(
    docs: DataFrame, *, source: Column | str = "source", text_col: str = "text",
    chunk_size: int = 1024, overlap: int = 200, generate_num: int = 2, markdown: bool = False,
    existing: DataFrame | None = None,
) -> DataFrame:
    """Question requests for the chunks still to do (resume applied)."""
    src = F.col(source) if isinstance(source, str) else source
    named = docs.select(src.alias("source"), F.col(text_col).alias("text"))
    chunks = chunk_documents(named, keep=["source"], chunk_size=chunk_size, overlap=overlap,
                             markdown=markdown).select("source", "chunk_id", "chunk")
    return question_requests(skip_done_chunks(chunks, existing, generate_num), generate_num)


def offline_answer_requests(q_requests: DataFrame | SavedRequests, q_replies: DataFrame) -> DataFrame:
    """J2 + P3/P4 + P2: answer requests from question replies (``request_id, response``).

    Of saved question requests that were read by place, each also tells its chunk's ``place``.
    """
    if isinstance(q_requests, SavedRequests) and q_requests.by_place:
        # as many tasks as model calls get: the requests are saved by them and read that way
        parts = _default_call_partitions(q_replies.sparkSession)
        joined = _attach_saved(q_requests.saved, q_replies, CHUNK_KEYS, parts)
        return answer_requests(P.explode_questions(joined, "response", keep=[*CHUNK_KEYS, "place"]), "place")
    requests = q_requests.requests if isinstance(q_requests, SavedRequests) else q_requests
    joined = attach_replies(requests.drop("messages"), dedupe_replies(q_replies.select("request_id", "response")))
    return answer_requests(P.explode_questions(joined, "response", keep=CHUNK_KEYS))


def save_answer_requests(requests: DataFrame, q_requests: SavedRequests) -> SavedRequests:
    """The requests of ``offline_answer_requests`` saved without their chunks, which ``q_requests`` has."""
    if q_requests.by_place:
        rows = requests.select("question_no", "question", "request_id", F.col("place").alias("chunk_place"))
        saved = save_rows(rows, "answer-requests")
        whole = fetch(saved, _columns(requests, CHUNK_KEYS), "chunk_place")
    else:
        whole = saved = save_rows(requests.drop("messages"), "answer-requests")
    prompt = P.answer_prompt(F.col("chunk"), F.col("question"))
    whole = whole.withColumn("messages", P.user_message(prompt)).select(*[c for c in requests.columns if c != "place"])
    return SavedRequests(whole, saved, q_requests.by_place)


def offline_pairs(a_requests: DataFrame | SavedRequests, a_replies: DataFrame) -> DataFrame:
    """J2 + P5: QA pairs from answer replies (``request_id, response``).

    Requests without a usable reply give no pair; ``offline_unanswered`` lists them.
    """
    if isinstance(a_requests, SavedRequests) and a_requests.by_place:
        answered = _attach_saved(a_requests.saved, a_replies, ["question", "chunk_place"])
        joined = fetch(answered, _columns(a_requests.requests, CHUNK_KEYS), "chunk_place")
    else:
        requests = a_requests.requests if isinstance(a_requests, SavedRequests) else a_requests
        joined = attach_replies(requests.drop("messages"), dedupe_replies(a_replies.select("request_id", "response")))
    return P.qa_pair(joined.withColumnRenamed("response", "answer"))


def offline_unanswered(requests: DataFrame, replies: DataFrame) -> DataFrame:
    """Requests of either kind that no usable reply answers, to be asked again."""
    return unanswered(requests.drop("messages"), replies.select("request_id", "response"))


def generate_qa_pairs(
    docs: DataFrame,
    client_factory: Callable,
    *,
    source: Column | str = "source",
    text_col: str = "text",
    chunk_size: int = 1024,
    overlap: int = 200,
    generate_num: int = 2,
    markdown: bool = False,
    existing: DataFrame | None = None,
    checkpoint: bool = True,
    max_tokens: int = 4096,
    temperature: float = 0.5,
    call_partitions: int | None = None,
    match_chunk_text: bool = False,
) -> QAResult:
    """The whole generation program over a document table.

    ``source`` names each document (a column name or a Column such as
    ``source_id(file_name)``).  ``existing`` holds pairs of earlier runs:
    chunks with at least ``generate_num`` of them are skipped before any call,
    and the returned pairs are the existing ones plus the new ones.

    Model calls dominate the cost, so the chunks to process are hash-spread
    on ``(source, chunk_id)`` into ``call_partitions`` tasks before the first
    call: a document holding a third of the corpus still spreads its calls
    over every task.  The default is twice the cluster's task slots (every
    slot busy, with slack for uneven reply times); the count is explicit, so
    AQE does not coalesce the byte-small stage away.

    ``checkpoint=False`` keeps everything lazy (tests, plan inspection); the
    returned pairs and errors then share uncut model stages, so evaluating
    both would call the model twice.
    """
    src = F.col(source) if isinstance(source, str) else source
    named = docs.select(src.alias("source"), F.col(text_col).alias("text"))
    chunks = chunk_documents(
        named, keep=["source"], chunk_size=chunk_size, overlap=overlap, markdown=markdown
    ).select("source", "chunk_id", "chunk")
    parts = call_partitions or _default_call_partitions(docs.sparkSession)
    # resume, then spread on the chunk key; a shuffled resume join shares the spread
    todo = skip_done_chunks(chunks, existing, generate_num, match_chunk_text=match_chunk_text,
                            partitions=parts)

    opts = {"max_tokens": max_tokens, "temperature": temperature}
    q, a = _ask(todo, client_factory, generate_num, opts, cut_lineage if checkpoint else None)
    new_pairs = _pairs_of(a)
    pairs = new_pairs
    if existing is not None:
        old = existing.select(*P.QA_PAIR_COLUMNS).withColumn(
            "question_no", F.lit(None).cast("int")
        )
        pairs = merge_pairs(old, new_pairs)
    errors = _call_errors(q, a).unionByName(_without_text(named))
    return QAResult(pairs=pairs, errors=errors, new_pairs=new_pairs)


def _ask(
    todo: DataFrame, client_factory: Callable, generate_num: int, opts: dict,
    save: Callable | None, known: DataFrame | None = None, logged: Callable | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Question and answer replies for some chunks: the two model stages.

    ``save`` cuts the lineage after each.  With ``logged`` (kind, replies) a
    stage's new replies are handed to the log before the next stage begins, and
    requests that ``known`` answers are not sent.
    """
    stages = {"q": ["source", "chunk_id", "chunk", "request_id"], "a": ["source", "chunk_id", "chunk", "question_no", "question", "request_id"]}

    def replies(requests: DataFrame, kind: str) -> DataFrame:
        extra = {}
        if logged:
            requests, extra = with_known(requests, known, kind), {"known_col": "known_reply"}
        out = generate_replies(requests, client_factory, carry=stages[kind], **extra, **opts)
        out = save(out) if save else out
        if logged:
            logged(kind, out.filter(~F.col("reused")))
        return out

    q = replies(question_requests(todo, generate_num), "q")
    questions = P.explode_questions(q.filter(F.col("error").isNull()), "response", keep=["source", "chunk_id", "chunk"])
    return q, replies(answer_requests(questions), "a")


def _pairs_of(answers: DataFrame, *extra: str) -> DataFrame:
    return answers.filter(F.col("error").isNull()).select(
        "question",
        F.col("response").alias("answer"),
        "source",
        F.col("chunk_id").cast("int").alias("chunk_id"),
        "chunk",
        F.col("question_no").cast("int").alias("question_no"),
        *extra,
    )


def _call_errors(q: DataFrame, a: DataFrame) -> DataFrame:
    return q.filter(F.col("error").isNotNull()).select(
        F.lit("question").alias("stage"), "source", "chunk_id",
        F.lit(None).cast("int").alias("question_no"), "error",
    ).unionByName(
        a.filter(F.col("error").isNotNull()).select(
            F.lit("answer").alias("stage"), "source", "chunk_id",
            F.col("question_no").cast("int"), "error",
        )
    )


def _without_text(named: DataFrame) -> DataFrame:
    return named.filter(F.col("text").isNull()).select(
        F.lit("document").alias("stage"), "source", F.lit(None).cast("int").alias("chunk_id"),
        F.lit(None).cast("int").alias("question_no"), F.lit(NO_TEXT).alias("error"),
    )


def _run_waves(spark, run_wave: Callable, waves: list, in_flight: int) -> None:
    """``run_wave(number, wave)`` for every wave, ``in_flight`` at once; after a failure no other one begins."""
    if in_flight == 1 or len(waves) < 2:
        for number, wave in enumerate(waves):
            run_wave(number, wave)
        return
    failed = threading.Event()

    def one(number: int, wave: tuple[int, int]) -> None:
        if failed.is_set():
            return
        try:
            run_wave(number, wave)
        except BaseException:
            failed.set()
            raise

    with ThreadPoolExecutor(in_flight) as pool:
        tasks = [pool.submit(inheritable_thread_target(spark)(one), *item) for item in enumerate(waves)]
        try:
            for task in as_completed(tasks):
                task.result()
        except BaseException:  # also an interrupt of the caller: waves in flight end, no other begins
            failed.set()
            raise


def run_generation(
    docs: DataFrame,
    client_factory: Callable,
    pairs_dir: str,
    train_path: str | None = None,
    fmt: str = "json",
    errors_path: str | None = None,
    *,
    source: Column | str = "source",
    text_col: str = "text",
    chunk_size: int = 1024,
    overlap: int = 200,
    generate_num: int = 2,
    markdown: bool = False,
    max_tokens: int = 4096,
    temperature: float = 0.5,
    call_partitions: int | None = None,
    match_chunk_text: bool = False,
    log_dir: str | None = None,
    wave_chunks: int = 50_000,
    max_waves: int | None = None,
) -> QAResult:
    """Resumable program A over a pair sink (S9 -> J1 -> ... -> S8 [-> X1 -> S10]).

    Chunks that have ``generate_num`` pairs in ``pairs_dir`` are skipped; the
    rest is processed in waves of about ``wave_chunks`` chunks.  A wave's replies
    go to the reply log (``log_dir``, default ``<pairs_dir>.replies``) as soon as
    its calls end, then its pairs to the sink.  A run that stops anywhere is
    continued by running it again: requests that the log answers are never
    sent again, pairs that the sink holds are not appended again, and at most
    the calls of the unfinished stages of the waves in flight are repeated.  A wave
    has ``call_partitions`` tasks; so many waves run at once that their tasks are
    twice the cluster's slots (with the default, one wave).  ``max_waves``
    ends a run early on purpose (a budget); the next one goes on.

    With ``train_path`` the merged training set (all sources) is rewritten as
    JSON lines.  ``fmt="json"`` keeps the pairs as JSON lines; ``"parquet"``
    lets the resume scan read only the key columns (preferable at scale).
    """
    spark = docs.sparkSession
    recover_pairs(spark, pairs_dir)
    existing = read_pairs_or_empty(spark, pairs_dir, fmt)
    src = F.col(source) if isinstance(source, str) else source
    named = docs.select(src.alias("source"), F.col(text_col).alias("text"))
    chunks = chunk_documents(named, keep=["source"], chunk_size=chunk_size, overlap=overlap, markdown=markdown)
    todo = skip_done_chunks(
        chunks.select("source", "chunk_id", "chunk"), existing, generate_num, match_chunk_text=match_chunk_text
    )
    waves = Waves(todo, wave_chunks, call_partitions or _default_call_partitions(spark))
    log = ReplyLog(spark, log_dir or f"{pairs_dir.rstrip('/')}.replies")
    known = log.known(waves.rows)
    # waves with a reply in the log (at most one row a wave); the others need neither it nor the pairs held
    logged = set() if known is None else {(r["grp"], r["slice"]) for r in known.select(*WAVE).distinct().collect()}
    # pairs of unfinished chunks, by wave: only asked for pairs that come from the log
    held = None
    if logged:
        keys = waves.rows.select("source", "chunk_id", *WAVE)
        held = by_wave(existing.select("source", "chunk_id", "question").join(keys, ["source", "chunk_id"]).distinct(), "held-pairs")
    opts = {"max_tokens": max_tokens, "temperature": temperature}
    done = scratch_path(spark, "generated")
    empty = spark.createDataFrame([], PAIR_ROW_SCHEMA), spark.createDataFrame([], ERROR_SCHEMA)
    for df, name in zip(empty, ("pairs", "errors")):  # a run without waves has a result too
        df.write.parquet(f"{done}/{name}/wave=-1")
    appending = threading.Lock()  # two jobs that append to one folder would remove each other's unfinished files

    def run_wave(number: int, wave: tuple[int, int]) -> None:
        q, a = _ask(
            waves.chunks(wave), client_factory, generate_num, opts, cut_lineage,
            known=of_wave(known, wave) if wave in logged else None,
            logged=lambda kind, replies: log.append(replies, kind, number),
        )
        pairs = _pairs_of(a, "reused")
        if wave in logged:
            old = of_wave(held, wave)
            again = pairs.filter("reused").join(old, ["source", "chunk_id", "question"], "left_anti")
            pairs = pairs.filter("NOT reused").unionByName(again)
        pairs.drop("reused").write.parquet(f"{done}/pairs/wave={number}")
        mine = spark.read.schema(PAIR_ROW_SCHEMA).parquet(f"{done}/pairs/wave={number}")
        with appending:
            append_pairs(mine.select(*P.QA_PAIR_COLUMNS), pairs_dir, fmt, buckets=min(PAIR_BUCKETS, 1 + waves.sizes[wave][0] * generate_num // PAIRS_PER_FILE))
        _call_errors(q, a).write.parquet(f"{done}/errors/wave={number}")

    _run_waves(spark, run_wave, list(waves)[:max_waves], waves.in_flight())
    new_pairs = spark.read.schema(PAIR_ROW_SCHEMA).parquet(f"{done}/pairs").select(*empty[0].columns)
    errors = spark.read.schema(ERROR_SCHEMA).parquet(f"{done}/errors").select(*empty[1].columns).unionByName(_without_text(named))
    if errors_path:  # failed calls and documents without text, run after run
        errors.write.mode("append").json(errors_path)
    merged = read_pairs_or_empty(spark, pairs_dir, fmt)
    if train_path:
        write_training_json(P.training_record(merged), train_path)
    return QAResult(pairs=merged.withColumn("question_no", F.lit(None).cast("int")), errors=errors, new_pairs=new_pairs)


def documents_with_source(docs: DataFrame, name_col: str = "name") -> DataFrame:
    """S3 applied to a named document table."""
    return docs.withColumn("source", source_id(F.col(name_col)))
