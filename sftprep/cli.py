"""Command line for the four programs (spark-submit or plain python).

    python -m sftprep.cli generate --input DIR_OR_FILE --output DIR [--base-url URL --model M | --client mod:fn]
    python -m sftprep.cli chat-dataset --input train.json --output DIR [--system-prompt S] [--extension K]
    python -m sftprep.cli vlm-dataset --manifest metadata.jsonl [--image-dir DIR] --output DIR
    python -m sftprep.cli vendor-dataset --dataset-dir DIR [--num-shards N] [--parquet-name train]
    python -m sftprep.cli calibration --input TABLE_PATH --output DIR [--samples 512] [--max-tokens 2048]

Outputs are written with Spark's writers (folders of part files).
"""

from __future__ import annotations

import argparse
import importlib
import importlib.util
import os
import sys
from collections.abc import Callable

from pyspark.sql import functions as F

from sftprep.session import build_session


def _factory(args) -> Callable:
    if args.client:
        mod, _, name = args.client.partition(":")
        return getattr(importlib.import_module(mod), name)
    if args.base_url and args.model:
        from sftprep.operators.clients import openai_compatible

        return openai_compatible(args.base_url, args.model, api_key_env=args.api_key_env,
                                 concurrency=args.concurrency)
    raise SystemExit("generate needs --client module:factory or --base-url and --model")


def cmd_generate(spark, args) -> None:
    from sftprep.plans.qa import run_generation
    from sftprep.session import ship_code
    from sftprep.sources.files import scan_documents, unreadable_documents

    if args.client:
        mod = args.client.partition(":")[0].split(".")[0]
        spec = importlib.util.find_spec(mod)
        if spec and spec.submodule_search_locations:
            ship_code(spark, list(spec.submodule_search_locations)[0])
        elif spec and spec.origin and spec.origin.endswith(".py"):  # a single-file client module
            spark.sparkContext.addPyFile(spec.origin)
    docs = scan_documents(spark, args.input)
    unread = unreadable_documents(docs).count()
    if unread and not args.skip_unreadable:
        raise SystemExit(f"{unread} documents have no text reader (see --skip-unreadable)")
    res = run_generation(
        docs, _factory(args), os.path.join(args.output, "pairs"),
        train_path=os.path.join(args.output, "train_data"), fmt=args.pairs_format,
        errors_path=os.path.join(args.output, "errors"),
        chunk_size=args.chunk_size, overlap=args.chunk_overlap, generate_num=args.generate_num,
        markdown=args.markdown, max_tokens=args.max_tokens, temperature=args.temperature,
        call_partitions=args.call_partitions,
    )
    errors = res.errors.count()
    print(f"new pairs: {res.new_pairs.count()}, failed calls: {errors}")


def cmd_chat_dataset(spark, args) -> None:
    from sftprep.plans.chat_dataset import prepare_chat_dataset
    from sftprep.sources.files import load_training_dataset

    recs = load_training_dataset(spark, dataset_name=args.table, dataset_path=args.input)
    if args.extension > 1:
        recs = recs.withColumn("_id", F.monotonically_increasing_id())  # equal records stay apart
    out = prepare_chat_dataset(recs, id_col="_id" if args.extension > 1 else None,
                               conversation_extension=args.extension, system_prompt=args.system_prompt)
    out.drop("_id").write.mode("overwrite").parquet(args.output)


def cmd_vlm_dataset(spark, args) -> None:
    from sftprep.plans.vlm_dataset import prepare_vlm_dataset, vlm_dataset_from_table

    if args.table:
        vlm_dataset_from_table(spark.table(args.table)).write.mode("overwrite").parquet(args.output)
        return
    if not args.manifest:
        raise SystemExit("vlm-dataset needs --manifest or --table")
    conv, bad = prepare_vlm_dataset(spark, args.manifest, args.image_dir)
    conv.write.mode("overwrite").parquet(args.output)
    bad.drop("content").write.mode("overwrite").parquet(args.output.rstrip("/") + "_rejected")
    print(f"rejected images: {bad.count()}")


def cmd_vendor_dataset(spark, args) -> None:
    from sftprep.plans.vlm_dataset import create_vendor_dataset

    shards, bad = create_vendor_dataset(spark, args.dataset_dir, args.output, args.parquet_name,
                                        args.num_shards)
    for r in shards.orderBy("shard").collect():  # one row per shard
        print(f"{r.file_name}: {r.n_rows} rows")
    print(f"rows without text: {bad.count()}")


def cmd_calibration(spark, args) -> None:
    from sftprep.plans.calibration import calibration_set

    msgs = spark.read.parquet(args.input)
    calibration_set(msgs, num_samples=args.samples, seed=args.seed, max_tokens=args.max_tokens,
                    key=args.key, order=args.order, role=args.role, content=args.content,
                    messages_col=args.messages_col,
                    ).write.mode("overwrite").parquet(args.output)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sftprep")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="cmd", required=True)

    g = sub.add_parser("generate")
    g.add_argument("--input", required=True)
    g.add_argument("--output", required=True)
    g.add_argument("--client", help="module:factory returning a batch client")
    g.add_argument("--base-url")
    g.add_argument("--model")
    g.add_argument("--api-key-env")
    g.add_argument("--concurrency", type=int, default=8)
    g.add_argument("--chunk-size", type=int, default=1024)
    g.add_argument("--chunk-overlap", type=int, default=200)
    g.add_argument("--generate-num", type=int, default=2)
    g.add_argument("--markdown", action="store_true")
    g.add_argument("--max-tokens", type=int, default=4096)
    g.add_argument("--temperature", type=float, default=0.5)
    g.add_argument("--call-partitions", type=int, default=None)
    g.add_argument("--pairs-format", choices=["json", "parquet"], default="json",
                   help="pair sink format; parquet lets resume read only the key columns")
    g.add_argument("--skip-unreadable", action="store_true",
                   help="go on without documents that have no text reader; they are listed in errors/")
    g.set_defaults(run=cmd_generate)

    c = sub.add_parser("chat-dataset")
    c.add_argument("--input")
    c.add_argument("--table")
    c.add_argument("--output", required=True)
    c.add_argument("--system-prompt", default=None)
    c.add_argument("--extension", type=int, default=1)
    c.set_defaults(run=cmd_chat_dataset)

    v = sub.add_parser("vlm-dataset")
    v.add_argument("--manifest")
    v.add_argument("--table", help="catalog table with image, text and optionally instruction")
    v.add_argument("--image-dir", default=None)
    v.add_argument("--output", required=True)
    v.set_defaults(run=cmd_vlm_dataset)

    d = sub.add_parser("vendor-dataset")
    d.add_argument("--dataset-dir", required=True)
    d.add_argument("--output", default=None)
    d.add_argument("--num-shards", type=int, default=1)
    d.add_argument("--parquet-name", default="train")
    d.set_defaults(run=cmd_vendor_dataset)

    k = sub.add_parser("calibration")
    k.add_argument("--input", required=True, help="Parquet messages: one row per message")
    k.add_argument("--output", required=True)
    k.add_argument("--samples", type=int, default=512)
    k.add_argument("--seed", type=int, default=42)
    k.add_argument("--max-tokens", type=int, default=2048)
    k.add_argument("--key", default="conv_id")
    k.add_argument("--order", default="turn")
    k.add_argument("--messages-col", default=None, help="one row per conversation: its array of role/content")
    k.add_argument("--role", default="role")
    k.add_argument("--content", default="text")
    k.set_defaults(run=cmd_calibration)
    return p


def main(argv: list[str] | None = None, spark=None) -> None:
    """Run one command; a session passed in is used as is and left running."""
    args = parser().parse_args(argv)
    own = spark is None
    spark = spark or build_session(args.master)
    try:
        args.run(spark, args)
    finally:
        if own:
            spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
