"""Hot keys: one conversation / one document holding most of the rows."""

from pyspark.sql import functions as F

from sftprep_checks.stub_client import make_client
from sftprep.functions import chat as C
from sftprep.plans.qa import generate_qa_pairs


def test_hot_conversation_rendered_in_bounded_blocks(spark):
    hot = spark.range(0, 3000).select(F.lit(0).alias("cid"), F.col("id").alias("turn"))
    cold = spark.range(1, 200).select(F.col("id").alias("cid"), F.lit(0).cast("long").alias("turn"))
    df = hot.unionByName(cold).select(
        "cid", "turn",
        F.when(F.col("turn") % 2 == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
        F.concat(F.lit("m"), F.col("turn").cast("string")).alias("content"),
    )
    blocks = C.render_conversations(df, "cid", "turn", block_size=64)
    whole = C.assemble_messages(df, "cid", "turn").select("cid", C.render_chat(F.col("messages")).alias("text"))
    assert blocks.exceptAll(whole).count() == 0 and whole.exceptAll(blocks).count() == 0
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    assert "_blk" in plan  # first aggregation level is keyed by (conversation, block)


def test_model_calls_spread_on_chunk_key(spark):
    docs = spark.createDataFrame([("big", "word " * 3000), ("small", "tiny")], "source string, text string")
    res = generate_qa_pairs(docs, make_client, chunk_size=64, overlap=8, checkpoint=False, call_partitions=6)
    plan = res.new_pairs._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(source" in plan and ", 6)" in plan
    # the big document's chunks land in every one of the 6 call partitions
    spread = (docs.where("source = 'big'").select("source", "text"))
    from sftprep.operators.chunking import chunk_documents
    ch = chunk_documents(spread, keep=["source"], chunk_size=64, overlap=8).repartition(6, "source", "chunk_id")
    per_part = ch.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(per_part) == 6 and max(r["count"] for r in per_part) < 2 * min(r["count"] for r in per_part)


def test_salted_image_join_equals_plain_join(spark):
    from sftprep.operators import vlm as V

    man = spark.range(0, 3000).select(
        F.when(F.col("id") < 1500, F.lit("hot.png")).otherwise(
            F.concat(F.lit("p"), (F.col("id") % 300).cast("string"), F.lit(".png"))).alias("file_name"),
        F.col("id").cast("string").alias("text"),
    )
    imgs = spark.range(0, 320).select(
        F.when(F.col("id") == 0, F.lit("hot.png")).otherwise(
            F.concat(F.lit("p"), F.col("id").cast("string"), F.lit(".png"))).alias("rel_path"),
        F.concat(F.lit("/img/"), F.col("id").cast("string")).alias("path"),
        F.encode(F.col("id").cast("string"), "UTF-8").alias("content"),
    )
    salted = V.join_images(man, imgs, broadcast_bytes=0, salt_buckets=8)
    plain = man.join(imgs.withColumnRenamed("path", "image_path"), man.file_name == imgs.rel_path).drop("rel_path")
    assert salted.count() == plain.count() == 1500 + 1500 - 5  # p0 has no image file
    cols = ["file_name", "text", "image_path", "content"]
    assert salted.select(cols).exceptAll(plain.select(cols)).count() == 0
    assert plain.select(cols).exceptAll(salted.select(cols)).count() == 0
    plan = salted._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan  # hot name salted (Catalyst may still broadcast a tiny image side)


def test_long_document_is_linear(spark):
    """One 2.7M-character non-ASCII document: cutting chunks must not rescan the text."""
    import time

    from sftprep.operators.chunking import chunk_documents

    text = " ".join(["éléphant", "naïve", "straße", "word"] * 100_000)
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    ch = chunk_documents(df, keep=["doc_id"], chunk_size=1024, overlap=200, spread=False)
    t = time.perf_counter()
    rows = ch.select("chunk_start", "chunk_end", F.length("chunk").alias("n")).collect()
    assert time.perf_counter() - t < 15  # was ~18 s with a code-point substring per chunk
    assert rows[0].chunk_start == 0 and max(r.chunk_end for r in rows) == len(text)
    assert all(r.n == r.chunk_end - r.chunk_start for r in rows)


def test_shuffled_resume_join_shares_the_call_spread(spark):
    from sftprep.operators.chunking import chunk_documents
    from sftprep.operators.resume import skip_done_chunks
    from sftprep.sources.files import QA_PAIR_SCHEMA

    docs = spark.createDataFrame([("a", "word " * 2000), ("b", "x " * 900)], "source string, text string")
    ch = chunk_documents(docs, keep=["source"], chunk_size=64, overlap=8, spread=False).select(
        "source", "chunk_id", "chunk")
    existing = spark.createDataFrame([("q", "a", "a", i, "c") for i in range(5) for _ in range(2)], QA_PAIR_SCHEMA)
    todo = skip_done_chunks(ch, existing, 2, broadcast_bytes=0, partitions=6)
    plan = todo._jdf.queryExecution().executedPlan().toString()
    chunk_side = [ln for ln in plan.splitlines() if "Exchange" in ln and "REPARTITION_BY_NUM" in ln]
    assert len(chunk_side) == 2  # one per side, both with the call partition count
    assert all(", 6)" in ln for ln in chunk_side)
    assert todo.rdd.getNumPartitions() == 6
    assert 0 not in {r.chunk_id for r in todo.filter("source = 'a'").collect()}
    assert skip_done_chunks(ch, existing, 2, broadcast_bytes=0).count() == todo.count()
