"""Spark side of the registered queries: each takes (spark, sf_dir) -> DataFrame.

Every query reads whole driver tables (or data Spark derives from them);
outputs are flat scalar columns, INT widened to BIGINT, aliased to the same
names as the SQL oracles in ``sftprep_checks.oracles``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sftprep_checks import fixtures as FX
from sftprep_checks.stub_client import make_client
from sftprep.functions import chat as C
from sftprep.functions import prompts as P
from sftprep.functions.tokens import whitespace_tokens
from sftprep.operators import ranking as R
from sftprep.operators import resume as RS
from sftprep.operators import vlm as V
from sftprep.operators.chunking import chunk_documents
from sftprep.operators.generate import attach_replies, request_id
from sftprep.plans.chat_dataset import prepare_chat_dataset
from sftprep.plans.qa import generate_qa_pairs
from sftprep.sources.files import extension, has_document_extension, source_collisions, source_id
from sftprep.sources.tables import read_table
from sftprep.streaming.incremental import stream_chunks_once


def flat(df: DataFrame) -> DataFrame:
    """INT -> BIGINT so both engines report the same integer type."""
    return df.select(
        *[
            F.col(f.name).cast("bigint").alias(f.name)
            if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# ------------------------------------------------------------------ chunking
def _plain_chunks(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    return chunk_documents(docs, keep=["doc_id"], chunk_size=FX.CHUNK_SIZE, overlap=FX.CHUNK_OVERLAP)


def chunk_text(spark: SparkSession, sf: str) -> DataFrame:
    """S4/C1/C7 at the generation defaults 1024/200."""
    return flat(_plain_chunks(spark, sf))


def chunk_text_defaults(spark: SparkSession, sf: str) -> DataFrame:
    """C1 at the chunker's own defaults 1000/100."""
    docs = read_table(spark, sf, "documents")
    return flat(chunk_documents(docs, keep=["doc_id"]))


INJECTED = "\n```\ncode\n```\n| a | b |\n"
INJECT_LANG = "de"


def markdown_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with a fenced block and a table injected mid-text for one language."""
    docs = read_table(spark, sf, "documents")
    half = F.floor(F.length("text") / 2).cast("int")
    injected = F.concat(
        F.substring(F.col("text"), F.lit(1), half), F.lit(INJECTED), F.substr(F.col("text"), half + 1)
    )
    return docs.select(
        "doc_id", F.when(F.col("lang") == INJECT_LANG, injected).otherwise(F.col("text")).alias("text")
    )


def chunk_markdown(spark: SparkSession, sf: str) -> DataFrame:
    """C2–C7 at 1000/100 over documents, some with a fence and a table."""
    docs = markdown_documents(spark, sf)
    return flat(
        chunk_documents(
            docs, keep=["doc_id"], chunk_size=FX.MD_CHUNK_SIZE, overlap=FX.MD_OVERLAP, markdown=True
        )
    )


# ------------------------------------------------------------------ sources
def file_names(spark: SparkSession, sf: str) -> DataFrame:
    """A file listing derived from documents: names with assorted extensions."""
    docs = read_table(spark, sf, "documents")
    ext = (
        F.when(F.col("lang") == "en", F.lit("txt"))
        .when(F.col("lang") == "fr", F.lit("PDF"))
        .when(F.col("lang") == "de", F.lit("html"))
        .otherwise(F.lit("Md"))
    )
    name = F.when(
        F.col("source") == "src3", F.concat(F.lit("doc"), F.col("doc_id").cast("string"))
    ).otherwise(F.concat(F.lit("doc."), F.col("doc_id").cast("string"), F.lit("."), ext))
    return docs.select("doc_id", name.alias("name"))


def doc_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Extension filter and source id over a listing."""
    names = file_names(spark, sf)
    return flat(
        names.filter(has_document_extension(F.col("name"))).select(
            "doc_id", "name", extension(F.col("name")).alias("ext"),
            source_id(F.col("name")).alias("source"),
        )
    )


# ------------------------------------------------------------------ prompts
def question_prompts(spark: SparkSession, sf: str) -> DataFrame:
    """P1 over every chunk."""
    ch = _plain_chunks(spark, sf)
    return flat(
        ch.select("doc_id", "chunk_id", P.question_prompt(F.col("chunk"), FX.GENERATE_NUM).alias("prompt"))
    )


def stub_question_reply(chunk: Column) -> Column:
    """The stub model's question reply as a Column (same as sftprep_checks.stub_client)."""
    return F.concat(
        F.lit("What does "), F.md5(chunk), F.lit(" cover?,Which points fill "),
        F.length(chunk).cast("string"), F.lit(" characters?"),
        F.when(F.instr(chunk, ",") > 0, F.lit(",Why the commas?")).otherwise(F.lit("")),
        F.when(F.length(chunk) % 7 == 0, F.lit(",")).otherwise(F.lit("")),
    )


def answer_prompts(spark: SparkSession, sf: str) -> DataFrame:
    """Split the replies and build an answer prompt per question."""
    ch = _plain_chunks(spark, sf).withColumn("reply", stub_question_reply(F.col("chunk")))
    qs = P.explode_questions(ch, "reply", keep=["doc_id", "chunk_id", "chunk"])
    return flat(
        qs.select(
            "doc_id", "chunk_id", "question_no", "question",
            P.answer_prompt(F.col("chunk"), F.col("question")).alias("prompt"),
        )
    )


def parse_questions(spark: SparkSession, sf: str) -> DataFrame:
    """P3/P4 over every assistant reply in conversations."""
    conv = read_table(spark, sf, "conversations").filter(F.col("role") == "assistant")
    return flat(P.explode_questions(conv, "text", keep=["conv_id", "turn"]))


# ------------------------------------------------------------------ resume / pairs
def _named_chunks(spark: SparkSession, sf: str) -> DataFrame:
    ch = _plain_chunks(spark, sf)
    return ch.withColumn(
        "source", source_id(F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt")))
    )


def _existing_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Earlier-run pairs derived from conversations: two turns per chunk id."""
    conv = read_table(spark, sf, "conversations")
    return conv.select(
        F.col("text").alias("question"),
        F.col("role").alias("answer"),
        source_id(F.concat(F.lit("doc_"), F.col("conv_id").cast("string"), F.lit(".txt"))).alias("source"),
        F.expr("turn div 2").cast("int").alias("chunk_id"),
        F.col("text").alias("chunk"),
    )


def resume_skip(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks still to generate given earlier pairs (generate_num = 2)."""
    todo = RS.skip_done_chunks(_named_chunks(spark, sf), _existing_pairs(spark, sf), FX.GENERATE_NUM)
    return flat(todo.select("source", "chunk_id", "chunk_start", "chunk_end"))


def _qa_pairs(spark: SparkSession, sf: str) -> DataFrame:
    conv = read_table(spark, sf, "conversations")
    requests = conv.filter(F.col("role") == "user").select(
        request_id(F.col("conv_id"), F.col("turn")).alias("request_id"),
        "conv_id", "turn", F.col("text").alias("question"),
    )
    replies = conv.filter(F.col("role") == "assistant").select(
        request_id(F.col("conv_id"), F.col("turn") - 1).alias("request_id"),
        F.col("text").alias("answer"),
    )
    joined = attach_replies(requests, replies)
    return P.qa_pair(
        joined.select(
            "question", "answer",
            F.concat(F.lit("conv_"), F.col("conv_id").cast("string")).alias("source"),
            F.col("turn").alias("chunk_id"),
            F.col("question").alias("chunk"),
        )
    )


def qa_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Each user turn joined with the assistant reply that follows it."""
    return flat(_qa_pairs(spark, sf))


def merge_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Three per-source pair sets merged back into one."""
    pairs = _qa_pairs(spark, sf)
    a = pairs.filter(F.col("chunk_id") < 2)
    b = pairs.filter((F.col("chunk_id") >= 2) & (F.col("chunk_id") < 4))
    c = pairs.filter(F.col("chunk_id") >= 4)
    return flat(RS.merge_pairs(a, b, c))


def alpaca_records(spark: SparkSession, sf: str) -> DataFrame:
    """Instruction / input / output records."""
    return flat(P.training_record(_qa_pairs(spark, sf)))


# ------------------------------------------------------------------ records / chat
def merged_prompt(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with an optional input built from labels."""
    docs = read_table(spark, sf, "documents")
    labels = read_table(spark, sf, "labels")
    j = docs.join(labels, "doc_id", "left")
    inp = F.when(
        F.col("quality").isNull(), F.lit("")
    ).otherwise(F.concat(F.lit("quality="), F.col("quality").cast("string"),
                         F.lit(" toxic="), F.col("toxic").cast("string")))
    return flat(
        j.select("doc_id", C.merged_prompt({"instruction": F.col("text"), "input": inp}).alias("merged"))
    )


def _records(spark: SparkSession, sf: str) -> DataFrame:
    pairs = _qa_pairs(spark, sf)
    rec = pairs.select("source", "chunk_id", F.col("question").alias("instruction"),
                       F.lit("").alias("input"), F.col("answer").alias("output"))
    return rec.withColumn(
        "conversation",
        C.sharegpt_conversation(
            C.merged_prompt({"instruction": F.col("instruction"), "input": F.col("input")}), F.col("output")
        ),
    )


def sharegpt(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations exploded to one row per turn."""
    rec = _records(spark, sf)
    return flat(
        rec.select("source", "chunk_id", F.posexplode("conversation").alias("msg_no", "m")).select(
            "source", "chunk_id", "msg_no", F.col("m.from").alias("from_"), F.col("m.value").alias("value")
        )
    )


def normalized_roles(spark: SparkSession, sf: str) -> DataFrame:
    """role/content after normalization."""
    rec = _records(spark, sf).withColumn("messages", C.normalize_roles(F.col("conversation")))
    return flat(
        rec.select("source", "chunk_id", F.posexplode("messages").alias("msg_no", "m")).select(
            "source", "chunk_id", "msg_no", F.col("m.role").alias("role"), F.col("m.content").alias("content")
        )
    )


def chat_text(spark: SparkSession, sf: str) -> DataFrame:
    """P10: rendered training text."""
    rec = _records(spark, sf)
    return flat(rec.select("source", "chunk_id",
                           C.render_chat(C.normalize_roles(F.col("conversation"))).alias("text")))


SYSTEM_PROMPT = "You are a helpful assistant."


def chat_text_system(spark: SparkSession, sf: str) -> DataFrame:
    """Rendered with a configured system prompt."""
    rec = _records(spark, sf)
    return flat(rec.select(
        "source", "chunk_id",
        C.render_chat(C.normalize_roles(F.col("conversation")), SYSTEM_PROMPT).alias("text"),
    ))


def conversation_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Validated messages assembled per conversation in turn order."""
    conv = read_table(spark, sf, "conversations")
    checked = conv.select("conv_id", "turn", C.llm_message(F.col("role"), F.col("text")).alias("m")).select(
        "conv_id", "turn", F.col("m.role").alias("role"), F.col("m.content").alias("content"))
    return flat(C.transcripts(checked, "conv_id", "turn"))


def role_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """P13 quarantine: rows whose role is not system/user/assistant."""
    conv = read_table(spark, sf, "conversations").withColumn(
        "role", F.when(F.col("role") == "system", F.lit("tool")).otherwise(F.col("role"))
    )
    _, bad = C.split_valid_roles(conv)
    return flat(bad.select("conv_id", "turn", "role", "error"))


def _record_conversations(spark: SparkSession, sf: str) -> DataFrame:
    rec = _records(spark, sf)
    return rec.select(
        F.concat(F.col("source"), F.lit(":"), F.col("chunk_id").cast("string")).alias("rec_id"),
        F.transform("conversation", lambda m: m["value"]).alias("turns"),
    )


def extend_conversations(spark: SparkSession, sf: str) -> DataFrame:
    """Each record extended with the records at its position in two shuffled copies."""
    rec = _record_conversations(spark, sf)
    ext = R.extend_conversations(rec, "rec_id", "turns", FX.EXTENSION_K, FX.EXTENSION_SEED)
    return flat(ext.select("rec_id", F.size("turns").alias("n_turns"),
                           F.array_join("turns", "\u001e").alias("joined")))


# ------------------------------------------------------------------ calibration
def _sampled_conversations(spark: SparkSession, sf: str) -> DataFrame:
    conv = read_table(spark, sf, "conversations")
    ids = R.seeded_sample(conv.select("conv_id"), FX.CALIBRATION_N, "conv_id", FX.CALIBRATION_SEED, distinct=True)
    return conv.join(F.broadcast(ids), "conv_id", "left_semi")  # at most N ids


def calibration_sample(spark: SparkSession, sf: str) -> DataFrame:
    """O1: N conversation ids chosen by a seeded hash order."""
    conv = read_table(spark, sf, "conversations")
    return flat(R.seeded_sample(conv.select("conv_id"), FX.CALIBRATION_N, "conv_id",
                                FX.CALIBRATION_SEED, distinct=True))


def _calibration_text(spark: SparkSession, sf: str) -> DataFrame:
    return C.render_conversations(_sampled_conversations(spark, sf), "conv_id", "turn", content="text")


def calibration_text(spark: SparkSession, sf: str) -> DataFrame:
    """Sampled conversations rendered to one text each."""
    return flat(_calibration_text(spark, sf))


def calibration_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """Whitespace tokens truncated to max_seq_len; other columns dropped."""
    t = _calibration_text(spark, sf).select(
        "conv_id", whitespace_tokens(F.col("text"), FX.CALIBRATION_MAX_TOKENS).alias("tokens")
    )
    return flat(t.select("conv_id", F.size("tokens").alias("n_tokens"),
                         F.array_join("tokens", " ").alias("tokens")))


# ------------------------------------------------------------------ images
IMAGE_MAGIC = {"com": "89504E470D0A1A0A", "net": "FFD8FFE0", "org": "4E4F54494D47"}


def image_files(spark: SparkSession, sf: str) -> DataFrame:
    """Image listing derived from pages: p<id>.png, header bytes chosen by the URL's domain."""
    pages = read_table(spark, sf, "pages")
    tld = F.regexp_extract(F.col("url"), "\\.example\\.([a-z]+)", 1)
    magic = F.lit(None).cast("binary")
    for k, v in IMAGE_MAGIC.items():
        magic = F.when(tld == k, F.unhex(F.lit(v))).otherwise(magic)
    name = F.concat(F.lit("p"), F.col("page_id").cast("string"), F.lit(".png"))
    return pages.select(
        name.alias("rel_path"),
        F.concat(F.lit("images/"), name).alias("path"),
        F.concat(magic, F.encode(F.col("html"), "UTF-8")).alias("content"),
    )


def image_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Manifest from documents: repeated and missing file names, optional instruction."""
    docs = read_table(spark, sf, "documents")
    page = F.expr("doc_id div 3").cast("string")
    return docs.select(
        "doc_id",
        F.concat(F.lit("p"), page, F.lit(".png")).alias("file_name"),
        F.when(F.col("lang") == "en", F.concat(F.lit("What is on page "), page, F.lit("?"))).alias("instruction"),
        "text",
    )


def _joined_images(spark: SparkSession, sf: str) -> DataFrame:
    return V.join_images(image_manifest(spark, sf), image_files(spark, sf))


def images_joined(spark: SparkSession, sf: str) -> DataFrame:
    """Manifest rows whose image exists."""
    j = _joined_images(spark, sf)
    return flat(j.select("doc_id", "file_name", "image_path", F.length("content").alias("n_bytes"),
                         F.col("text")))


def _valid_images(spark: SparkSession, sf: str) -> DataFrame:
    good, _ = V.split_valid_images(_joined_images(spark, sf))
    return good


def images_valid(spark: SparkSession, sf: str) -> DataFrame:
    """rows whose header is an image signature."""
    good = _valid_images(spark, sf)
    return flat(good.select("doc_id", "file_name", "image_path", "image_format",
                            F.length("content").alias("n_bytes")))


def vlm_conversation(spark: SparkSession, sf: str) -> DataFrame:
    """User [instruction text, image], assistant [text], exploded to parts."""
    good = _valid_images(spark, sf)
    rows = good.select("doc_id", "instruction", "text", "image_path",
                       V.image_struct(F.col("content"), F.col("image_path")).alias("image"))
    conv = V.vlm_conversation(rows)
    msgs = conv.select("doc_id", F.posexplode("messages").alias("msg_no", "m"))
    parts = msgs.select("doc_id", "msg_no", F.col("m.role").alias("role"),
                        F.posexplode("m.content").alias("part_no", "p"))
    return flat(parts.select(
        "doc_id", "msg_no", "role", "part_no", F.col("p.type").alias("type"), F.col("p.text").alias("text"),
        F.col("p.image.path").alias("image_path"),
    ))


VLM_SYSTEM = "You are a helpful assistant that can answer questions about images."


def vlm_messages(spark: SparkSession, sf: str) -> DataFrame:
    """System / user (image URL first) / assistant messages, exploded to parts."""
    good = _valid_images(spark, sf)
    msgs = good.select(
        "doc_id",
        F.array(
            C.vlm_message(F.lit("system"), F.lit(VLM_SYSTEM)),
            C.vlm_message(F.lit("user"), F.coalesce(F.col("instruction"), F.lit(V.DEFAULT_VLM_INSTRUCTION)),
                          F.col("image_path")),
            C.vlm_message(F.lit("assistant"), F.col("text")),
        ).alias("messages"),
    )
    m = msgs.select("doc_id", F.posexplode("messages").alias("msg_no", "m"))
    parts = m.select("doc_id", "msg_no", F.col("m.role").alias("role"),
                     F.posexplode("m.content").alias("part_no", "p"))
    return flat(parts.select("doc_id", "msg_no", "role", "part_no", F.col("p.type").alias("type"),
                             F.col("p.text").alias("text"), F.col("p.url").alias("url")))


def _vendor(spark: SparkSession, sf: str) -> DataFrame:
    j = _joined_images(spark, sf)
    good, _ = V.vendor_rows(j)
    return good


def vendor_qa(spark: SparkSession, sf: str) -> DataFrame:
    """question/answer/image rows; rows without an instruction skipped."""
    g = _vendor(spark, sf)
    return flat(g.select("question", "answer", "image_path", F.length("image.bytes").alias("n_bytes")))


def keyed_qa(spark: SparkSession, sf: str) -> DataFrame:
    """Configured keys rendered to system / user / assistant turns."""
    k = V.keyed_qa(_vendor(spark, sf))
    return flat(k.select("system", "user", "assistant", F.col("image.path").alias("image_path")))


# ------------------------------------------------------------------ shards
def _shards(spark: SparkSession, sf: str):
    docs = read_table(spark, sf, "documents").select("doc_id", "n_chars")
    return R.assign_shards(docs, ["doc_id"], FX.SHARDS)


def shard_assign(spark: SparkSession, sf: str) -> DataFrame:
    """A3: contiguous shard of every document in doc_id order."""
    sharded, _ = _shards(spark, sf)
    return flat(sharded.select("doc_id", "row_idx", "shard"))


def shard_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Every shard's file name and row count."""
    sharded, _ = _shards(spark, sf)
    return flat(R.shard_manifest(spark, sharded, "train", FX.SHARDS))


# ------------------------------------------------------------------ streaming
def incremental_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Documents chunked by a Structured Streaming query (availableNow)."""
    return flat(stream_chunks_once(spark, f"{sf}/documents.parquet",
                                   read_table(spark, sf, "documents").schema,
                                   chunk_size=FX.CHUNK_SIZE, overlap=FX.CHUNK_OVERLAP))


# ------------------------------------------------------------------ flagship
def qa_generation(spark: SparkSession, sf: str) -> DataFrame:
    """Program A end to end with the stub model: chunks -> questions -> answers -> pairs."""
    docs = read_table(spark, sf, "documents").withColumn(
        "name", F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt"))
    )
    res = generate_qa_pairs(
        docs, make_client, source=source_id(F.col("name")), chunk_size=FX.CHUNK_SIZE,
        overlap=FX.CHUNK_OVERLAP, generate_num=FX.GENERATE_NUM,
    )
    return flat(res.pairs.select("source", "chunk_id", "question_no", "question", "answer", "chunk"))


# ------------------------------------------------------------------ more coverage
def training_json(spark: SparkSession, sf: str) -> DataFrame:
    """P6 as JSON text (instruction / input / output)."""
    return flat(P.training_record_json(_qa_pairs(spark, sf), keep=("source", "chunk_id")))


def chat_dataset(spark: SparkSession, sf: str) -> DataFrame:
    """Program B: records -> conversations extended by one shuffled copy -> text with a system prompt."""
    pairs = _qa_pairs(spark, sf)
    recs = pairs.select(
        F.concat(F.col("source"), F.lit(":"), F.col("chunk_id").cast("string")).alias("rec_id"),
        F.col("question").alias("instruction"), F.lit("").alias("input"), F.col("answer").alias("output"),
    )
    out = prepare_chat_dataset(recs, id_col="rec_id", conversation_extension=2,
                              system_prompt=SYSTEM_PROMPT, seed=FX.EXTENSION_SEED)
    return flat(out.select("rec_id", F.size("conversations").alias("n_messages"), "text"))


def source_collisions_report(spark: SparkSession, sf: str) -> DataFrame:
    """S3: source ids shared by different file names (a.b.txt vs a_b.txt)."""
    docs = read_table(spark, sf, "documents")
    dotted = docs.select(F.concat(F.lit("doc."), F.col("doc_id").cast("string"), F.lit(".txt")).alias("name"))
    under = docs.filter(F.col("lang") == "fr").select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("name"))
    return flat(source_collisions(dotted.unionByName(under)))


def image_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """F3 rejects: joined rows whose header is no image signature."""
    _, bad = V.split_valid_images(_joined_images(spark, sf))
    return flat(bad.select("doc_id", "file_name", "image_path", F.length("content").alias("n_bytes")))


def keyed_qa_inference(spark: SparkSession, sf: str) -> DataFrame:
    """P15 inference mode: no assistant turn, label kept."""
    k = V.keyed_qa(_vendor(spark, sf), exp_type="inference")
    return flat(k.select("system", "user", "label", F.col("image.path").alias("image_path")))


def qa_generation_resumed(spark: SparkSession, sf: str) -> DataFrame:
    """J1 + X2 inside program A: pairs per chunk after resuming from earlier pairs."""
    docs = read_table(spark, sf, "documents").withColumn(
        "name", F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt")))
    res = generate_qa_pairs(
        docs, make_client, source=source_id(F.col("name")), chunk_size=FX.CHUNK_SIZE,
        overlap=FX.CHUNK_OVERLAP, generate_num=FX.GENERATE_NUM, existing=_existing_pairs(spark, sf),
    )
    return flat(RS.pairs_per_chunk(res.pairs))


def qa_generation_restarted(spark: SparkSession, sf: str) -> DataFrame:
    """Program A stopped after its first wave of calls and run again: the pairs of the sink."""
    from sftprep.plans.qa import run_generation
    from sftprep.sources.files import read_pairs_or_empty

    docs = read_table(spark, sf, "documents").withColumn(
        "name", F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt")))
    path = _folder(spark, "restarted")
    opts = dict(source=source_id(F.col("name")), chunk_size=FX.CHUNK_SIZE, overlap=FX.CHUNK_OVERLAP,
                generate_num=FX.GENERATE_NUM, fmt="parquet", wave_chunks=8_000, call_partitions=4)
    run_generation(docs, make_client, path, max_waves=1, **opts)
    run_generation(docs, make_client, path, **opts)
    return flat(read_pairs_or_empty(spark, path, "parquet"))


def images_present(spark: SparkSession, sf: str) -> DataFrame:
    """F2 without bytes: manifest rows whose image file exists (left-semi on names)."""
    man = image_manifest(spark, sf)
    listing = image_files(spark, sf).select("rel_path", "path")
    return flat(V.rows_with_image(man, listing).select("doc_id", "file_name"))


def qa_generation_offline(spark: SparkSession, sf: str) -> DataFrame:
    """J2 offline path: exported requests answered by a separate batch job, joined back by request_id."""
    from sftprep.operators.generate import generate_replies
    from sftprep.plans.qa import (
        offline_answer_requests, offline_pairs, offline_question_requests, save_answer_requests, save_question_requests,
    )
    from sftprep.sources.saved_rows import save_rows

    docs = read_table(spark, sf, "documents").withColumn(
        "name", F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt")))
    qreq = save_question_requests(offline_question_requests(
        docs, source=source_id(F.col("name")), chunk_size=FX.CHUNK_SIZE, overlap=FX.CHUNK_OVERLAP,
        generate_num=FX.GENERATE_NUM), FX.GENERATE_NUM)
    qrep = save_rows(generate_replies(qreq.requests, make_client, carry=["request_id"]), "question-replies")  # the "service"
    areq = save_answer_requests(offline_answer_requests(qreq, qrep), qreq)
    arep = save_rows(generate_replies(areq.requests, make_client, carry=["request_id"]), "answer-replies")
    pairs = offline_pairs(areq, arep)
    return flat(pairs.select("source", "chunk_id", "question", "answer", "chunk"))


# ------------------------------------------------------------------ written and read back
def _folder(spark: SparkSession, name: str) -> str:
    from sftprep.session import scratch_path

    return scratch_path(spark, name)


def _pairs_of_documents(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    return docs.select(
        F.concat(F.lit("q"), F.col("doc_id").cast("string")).alias("question"), F.substring("text", 1, 40).alias("answer"),
        "source", F.col("doc_id").cast("int").alias("chunk_id"), "text",
    ).withColumnRenamed("text", "chunk")


def pairs_sink_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs appended in three runs, in both layouts, compacted in between and read back."""
    from sftprep.sources.files import read_pairs_or_empty
    from sftprep.sources.sinks import append_pairs, compact_pairs

    pairs, path = _pairs_of_documents(spark, sf), _folder(spark, "pairs")
    append_pairs(pairs.filter("chunk_id % 3 = 0"), path)
    append_pairs(pairs.filter("chunk_id % 3 = 1"), path, buckets=8)
    compact_pairs(spark, path, buckets=4)
    append_pairs(pairs.filter("chunk_id % 3 = 2"), path, buckets=8)
    return flat(read_pairs_or_empty(spark, path))


def sharded_sink_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Contiguous shards written as exactly named files and read back; a column named with '_' stays."""
    from sftprep.sources.files import base_name
    from sftprep.sources.sinks import write_shard_files

    path = _folder(spark, "shards")
    rows = read_table(spark, sf, "documents").select("doc_id", F.col("lang").alias("_label"), "n_chars")
    write_shard_files(rows, path, "train", FX.SHARDS, ["doc_id"])
    return flat(spark.read.parquet(path).withColumn("shard_file", base_name(F.input_file_name())))


def document_files(spark: SparkSession, sf: str) -> DataFrame:
    """Documents written as files, some with '_' or '.' names, and scanned."""
    from sftprep.sources.files import scan_documents

    path = _folder(spark, "files")
    ext = F.when(F.col("lang") == "en", "txt").when(F.col("lang") == "fr", "MD").when(F.col("lang") == "de", "html").otherwise("csv")
    lead = F.when(F.col("doc_id") % 5 == 1, "_").when(F.col("doc_id") % 5 == 2, ".").otherwise("")
    docs = read_table(spark, sf, "documents").select(F.concat(lead, F.lit("d"), F.col("doc_id").cast("string"), F.lit("."), ext).alias("name"), "text")
    write_files(docs.select("name", F.col("text").cast("binary").alias("content")), path)
    return scan_documents(spark, path).select("name", "ext", "source", "text")


#: files that one task of ``write_files`` writes
TASK_FILES = 2_000


def write_files(files: DataFrame, folder: str) -> None:
    """One file per row (name, content) below ``folder``, written by the tasks through pyarrow.

    A file costs more than its bytes, so rows are dealt to tasks by their number.
    """
    from sftprep.operators.vlm import _local_or_uri
    from sftprep.session import byte_slices, ensure_library_on_workers

    spark = files.sparkSession
    ensure_library_on_workers(spark)
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(folder)
    p.getFileSystem(sc._jsc.hadoopConfiguration()).mkdirs(p)
    files = files.select("name", "content")
    tasks = max(sc.defaultParallelism, -(-files.count() // TASK_FILES))

    def write(batches):
        import pyarrow as pa
        from pyarrow import fs as pafs

        target = _local_or_uri(folder)
        filesystem, inner = pafs.FileSystem.from_uri(target) if "://" in target else (pafs.LocalFileSystem(), target)
        n, made = 0, set()
        for batch in (part for whole in batches for part in byte_slices(whole, 1)):
            for name, content in zip(*(c.to_pylist() for c in batch.columns)):
                parent = f"{inner}/{name}".rpartition("/")[0]
                if parent not in made:
                    filesystem.create_dir(parent)
                    made.add(parent)
                with filesystem.open_output_stream(f"{inner}/{name}") as f:
                    f.write(content)
            n += len(batch)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    files.repartition(tasks).mapInArrow(write, "n long").write.format("noop").mode("overwrite").save()


def image_files_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """S7/F2/F3/P17 on files: names joined, headers read by range, bodies read last.

    Some files have hidden names, some manifest names are spelled with './' or as
    absolute paths, and the files of one language are no images.
    """
    from sftprep.operators import images as I
    from sftprep.sources.files import list_images
    from sftprep.sources.listing import located_path

    path = _folder(spark, "images")
    docs = read_table(spark, sf, "documents")
    lead = F.when(F.col("doc_id") % 7 == 1, "_").when(F.col("doc_id") % 7 == 2, ".").otherwise("")
    name = F.concat(F.col("source"), F.lit("/"), lead, F.col("doc_id").cast("string"), F.lit(".png"))
    magic = F.unhex(F.when(F.col("lang") == "fr", "4E4F").when(F.col("lang") == "de", "0000001C667479706D696631000000006D696631617669666D696166").otherwise("89504E470D0A1A0A"))
    files = docs.select(name.alias("name"), F.concat(magic, F.col("text").cast("binary")).alias("content"))
    write_files(files, path)
    root, _ = located_path(spark, path)
    spelled = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("./"), name)).when(F.col("doc_id") % 3 == 1, F.concat(F.lit(root + "/"), name)).otherwise(name)
    manifest = docs.select("doc_id", spelled.alias("file_name"), F.lit(None).cast("string").alias("instruction"), F.col("lang").alias("text"))
    located = I.locate_images(manifest, list_images(spark, path), root=root)
    good, _ = I.split_by_format(located, I.read_formats(located))
    rows = V.image_text_rows(I.with_content(good))
    relative = F.regexp_extract("image_path", r"/(src[0-9]+/[^/]+)$", 1)
    return rows.select(relative.alias("name"), "text", F.length(F.col("image.bytes")).cast("long").alias("n_bytes"))


def training_json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Training records written as JSON lines and read back."""
    from sftprep.sources.files import load_training_dataset
    from sftprep.sources.sinks import write_training_json

    path = _folder(spark, "training")
    write_training_json(read_table(spark, sf, "documents").select(F.col("lang").alias("instruction"), F.col("source").alias("input"), F.col("text").alias("output")), path)
    return load_training_dataset(spark, dataset_path=path)


def write_array(records: DataFrame, path: str) -> None:
    """One JSON array file of all records (``value``): tasks write pieces in order, then copy them to their places in the file.

    On a file system that does not write at an offset the pieces are streamed one after the other.
    """
    from pyarrow import fs as pafs
    from sftprep.sources.listing import file_system, list_files, located_path

    spark = records.sparkSession
    records.select(F.concat(F.lit(","), "value").alias("value")).write.text(f"{path}.pieces")
    root, _ = located_path(spark, f"{path}.pieces")
    found = list_files(spark, root).filter(F.col("path").rlike("/part-[^/]*$") & (F.col("length") > 0))
    places, at = [], 1  # every record begins with a comma: the first one's gives way to the bracket
    for r in sorted(found.select("path", "length").toLocalIterator()):  # one row per task
        places.append((len(places), r.path, int(not places), at))
        at += r.length - int(len(places) == 1)
    filesystem, inner = file_system(path)

    def copy(source: str, skip: int, f) -> None:
        pieces, name = file_system(source)
        with pieces.open_input_file(name) as piece:
            piece.seek(skip)
            while data := piece.read(8 << 20):
                f.write(data)

    def place(batches):
        for batch in batches:
            for _, source, skip, start in zip(*(c.to_pylist() for c in batch.columns)):
                with open(inner, "r+b") as f:
                    f.seek(start)
                    copy(source, skip, f)
            yield batch.slice(0, 0)

    local = isinstance(filesystem, pafs.LocalFileSystem)
    with filesystem.open_output_stream(inner) as f:
        f.write(b"[")
        if not local:
            for _, source, skip, _start in places:
                copy(source, skip, f)
            f.write(b"]\n")
    if local:
        if places:
            schema = "piece int, source string, skip int, start long"
            spark.createDataFrame(places, schema).repartitionById(len(places), "piece").mapInArrow(place, schema).write.format("noop").mode("overwrite").save()
        with open(inner, "r+b") as f:
            f.seek(at)
            f.write(b"]\n")


def training_json_array(spark: SparkSession, sf: str) -> DataFrame:
    """S5 on one array file read by many tasks: the records keep their other fields too."""
    from sftprep.sources.files import read_training_json

    path = _folder(spark, "array")
    docs = read_table(spark, sf, "documents").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    record = F.to_json(F.struct(F.col("lang").alias("instruction"), F.col("source").alias("input"), F.col("text").alias("output"),
                                F.struct("doc_id", F.array("n_chars").alias("sizes")).alias("meta")))
    write_array(docs.select(record.alias("value")), f"{path}/train.json")
    out = read_training_json(spark, f"{path}/train.json", schema=None, block=200_000)
    return flat(out.select("instruction", "input", "output", F.col("meta.doc_id").alias("doc_id"), F.col("meta.sizes")[0].alias("n_chars")))


def load_chunks_of_files(spark: SparkSession, sf: str) -> DataFrame:
    """A folder of files straight to plain chunks."""
    from sftprep.sources.files import load_chunks

    path = _folder(spark, "chunk-files")
    docs = read_table(spark, sf, "documents")
    write_files(docs.select(F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("name"), F.col("text").cast("binary").alias("content")), path)
    chunks = load_chunks(spark, path, chunk_size=FX.CHUNK_SIZE, overlap=FX.CHUNK_OVERLAP)
    return flat(chunks.select("source", "chunk_id", "chunk_start", "chunk_end", "chunk"))


def manifest_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """A manifest written as JSON lines and read back."""
    from sftprep.sources.files import read_manifest

    path = _folder(spark, "manifest")
    rows = read_table(spark, sf, "documents").select(F.concat("source", F.lit("/"), F.col("doc_id").cast("string")).alias("file_name"), F.col("lang").alias("instruction"), "text")
    rows.write.json(path)
    return read_manifest(spark, path)


def render_all_conversations(spark: SparkSession, sf: str) -> DataFrame:
    """P18 over every conversation."""
    return C.render_conversations(read_table(spark, sf, "conversations"), "conv_id", "turn", content="text")


def tokenize_all_conversations(spark: SparkSession, sf: str) -> DataFrame:
    """P19 over every conversation."""
    toks = whitespace_tokens(F.col("text"), FX.CALIBRATION_MAX_TOKENS)
    return render_all_conversations(spark, sf).select("conv_id", F.size(toks).cast("long").alias("n_tokens"), F.array_join(toks, " ").alias("tokens"))


def vlm_from_table(spark: SparkSession, sf: str) -> DataFrame:
    """Program C on a saved table whose rows carry their own instruction."""
    from sftprep.plans.vlm_dataset import vlm_dataset_from_table
    from sftprep.sources.sinks import save_and_reload

    rows = _valid_images(spark, sf).select(
        "doc_id", "instruction", "text", V.image_struct(F.col("content"), F.col("image_path")).alias("image")
    )
    conv = vlm_dataset_from_table(save_and_reload(rows, _folder(spark, "vlm-table")))
    m = F.col("messages")
    return conv.select(
        "doc_id", m[0]["content"][0]["text"].alias("instruction"), m[0]["content"][1]["image"]["path"].alias("image_path"),
        F.length(m[0]["content"][1]["image"]["bytes"]).cast("long").alias("n_bytes"), m[1]["content"][0]["text"].alias("answer"),
    )


def calibration_messages_array(spark: SparkSession, sf: str) -> DataFrame:
    """Program D on one row per conversation with a messages array: the sampled token lists."""
    from sftprep.plans.calibration import calibration_set

    talks = C.assemble_messages(read_table(spark, sf, "conversations"), "conv_id", "turn", content="text")
    toks = calibration_set(talks, num_samples=FX.CALIBRATION_N, seed=FX.CALIBRATION_SEED,
                           max_tokens=FX.CALIBRATION_MAX_TOKENS, messages_col="messages")
    return toks.select(F.size("tokens").cast("long").alias("n_tokens"), F.array_join("tokens", " ").alias("tokens"))


def incremental_documents(spark: SparkSession, sf: str) -> DataFrame:
    """T1 over document files: the chunks of every text file that arrived in a folder, hidden names included."""
    import os

    from sftprep.streaming.incremental import run_incremental

    base = _folder(spark, "incremental-files")
    lead = F.when(F.col("doc_id") % 5 == 1, "_").when(F.col("doc_id") % 5 == 2, ".").otherwise("")
    name = F.concat(lead, F.lit("d."), F.col("doc_id").cast("string"), F.when(F.col("lang") == "en", ".txt").otherwise(".MD"))
    docs = read_table(spark, sf, "documents")
    write_files(docs.select(name.alias("name"), F.col("text").cast("binary").alias("content")), os.path.join(base, "in"))
    sink = os.path.join(base, "sink")
    run_incremental(spark, os.path.join(base, "in"), None, sink, os.path.join(base, "checkpoint"),
                    chunk_size=FX.CHUNK_SIZE, overlap=FX.CHUNK_OVERLAP)
    return flat(spark.read.parquet(sink).select("source", "chunk_id", "chunk_start", "chunk_end", "chunk"))
