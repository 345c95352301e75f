"""T1 over files of any name: once each, replayable, a few files at a time, single files."""

import json
import os

import pytest
from pyspark.sql import functions as F

from sftprep.operators.chunking import chunk_documents
from sftprep.sources.files import scan_documents
from sftprep.streaming.incremental import run_incremental

NAMES = ["a.txt", "_b.md", ".c.txt", "d e%20.TXT", "ü.csv", "empty.txt"]


def write(folder, names):
    os.makedirs(folder, exist_ok=True)
    for n in names:
        with open(os.path.join(folder, n), "w") as f:
            f.write("" if n == "empty.txt" else f"{n} has words. " * 20)


def run(spark, base, source=None, **kw):
    run_incremental(spark, str(source or base / "in"), None, str(base / "sink"), str(base / "ck"), chunk_size=64, overlap=16, **kw)
    return spark.read.parquet(str(base / "sink"))


def rows(df):
    return sorted((r.source, r.chunk_id, r.chunk) for r in df.collect())


def test_stream_equals_batch_and_files_are_read_once(spark, tmp_path):
    write(tmp_path / "in", NAMES[:4] + ["skip.html", "report.pdf"])
    run(spark, tmp_path)
    write(tmp_path / "in", NAMES)  # two new, four written again
    out = run(spark, tmp_path)
    docs = scan_documents(spark, str(tmp_path / "in"))
    assert rows(out) == rows(chunk_documents(docs, keep=["source"], chunk_size=64, overlap=16))
    assert rows(run(spark, tmp_path)) == rows(out)


def test_a_few_files_at_a_time(spark, tmp_path):
    write(tmp_path / "in", [f"{'_' if i % 2 else ''}n{i}.txt" for i in range(7)])
    out = run(spark, tmp_path, max_files_per_trigger=3)
    assert out.select("source").distinct().count() == 7
    assert out.select("batch_id").distinct().count() == 3
    entries = sorted(os.listdir(tmp_path / "ck.files"))
    planned = [p for e in entries for p, _ in json.loads((tmp_path / "ck.files" / e).read_text())]
    assert len(planned) == len(set(planned)) == 7 and not any(e.endswith(".tmp") for e in entries)


def test_a_failed_batch_is_replayed_with_its_files(spark, tmp_path, monkeypatch):
    import sftprep.streaming.incremental as module

    write(tmp_path / "in", NAMES[:2])
    real = module.chunk_documents

    def down(*args, **kw):
        raise RuntimeError("down")

    monkeypatch.setattr(module, "chunk_documents", down)
    with pytest.raises(Exception, match="down"):
        run(spark, tmp_path)
    monkeypatch.setattr(module, "chunk_documents", real)
    write(tmp_path / "in", NAMES)
    out = run(spark, tmp_path)
    docs = scan_documents(spark, str(tmp_path / "in"))
    assert rows(out) == rows(chunk_documents(docs, keep=["source"], chunk_size=64, overlap=16))


def test_a_single_hidden_file(spark, tmp_path):
    write(tmp_path / "in", NAMES)
    out = run(spark, tmp_path, source=tmp_path / "in" / ".c.txt")
    assert {r.source for r in out.collect()} == {"_c_txt"}
    assert out.filter(F.col("chunk").contains(".c.txt")).count() > 0
