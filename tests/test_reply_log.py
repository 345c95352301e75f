"""A run stopped between or inside waves goes on without repeating a logged call."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from sftprep.operators.reply_log import ReplyLog, Waves
from sftprep.plans.qa import run_generation
from sftprep.sources.files import read_pairs_or_empty
from sftprep_checks.stub_client import make_client


def counting(folder, fail=None):
    """A client that leaves one file per call; a second call of one prompt is told by its name."""

    def factory():
        inner = make_client()

        def client(prompts, **opts):
            replies = list(inner(prompts, **opts))
            for i, p in enumerate(prompts):
                name = hashlib.md5(p[0]["content"].encode()).hexdigest()
                if fail and fail in p[0]["content"]:
                    replies[i] = RuntimeError("down")
                n = 0
                while True:
                    try:
                        os.close(os.open(f"{folder}/{name}.{n}", os.O_CREAT | os.O_EXCL))
                        break
                    except FileExistsError:
                        n += 1
            return replies

        return client

    return factory


@pytest.fixture()
def docs(spark):
    rows = [(f"d{i}", f"Sentence number {i} is here. " * (3 + i % 5)) for i in range(24)] + [("empty", ""), ("none", None)]
    return spark.createDataFrame(rows, "source string, text string").repartition(6, "source")


OPTS = dict(chunk_size=64, overlap=16, wave_chunks=12, call_partitions=2)


def pairs(spark, path):
    return sorted(tuple(r) for r in read_pairs_or_empty(spark, path).collect())


def test_waves_hold_every_chunk_once(spark, docs):
    chunks = spark.range(500).select(F.lit("s").alias("source"), F.col("id").cast("int").alias("chunk_id"), F.lit("c").alias("chunk"))
    waves = Waves(chunks.repartition(5), wave_chunks=40, tasks_per_wave=2)
    held = [[r.chunk_id for r in waves.chunks(w).collect()] for w in waves]
    assert sorted(c for w in held for c in w) == list(range(500))
    assert len(held) > 10 and all(len(w) <= 40 for w in held)
    assert "Exchange" not in waves.rows._jdf.queryExecution().executedPlan().toString()


def test_a_stopped_run_repeats_no_call(spark, docs, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    whole = str(tmp_path / "whole")
    run_generation(docs, make_client, whole, chunk_size=64, overlap=16)
    path = str(tmp_path / "pairs")
    sizes = []
    for stop in (1, 2, None, None):
        run_generation(docs, counting(str(calls)), path, max_waves=stop, **OPTS)
        sizes.append(len(pairs(spark, path)))
    assert 0 < sizes[0] < sizes[1] < sizes[2] == sizes[3]
    assert pairs(spark, path) == pairs(spark, whole)
    assert all(f.endswith(".0") for f in os.listdir(calls))


def test_a_stop_between_the_log_and_the_sink(spark, docs, tmp_path, monkeypatch):
    import sftprep.plans.qa as Q

    calls = tmp_path / "calls"
    calls.mkdir()
    path, real = str(tmp_path / "pairs"), Q.append_pairs

    def stopped(*args, **kw):
        raise KeyboardInterrupt

    monkeypatch.setattr(Q, "append_pairs", stopped)
    with pytest.raises(KeyboardInterrupt):
        run_generation(docs, counting(str(calls)), path, **OPTS)
    answered = len(os.listdir(calls))
    monkeypatch.setattr(Q, "append_pairs", real)
    run_generation(docs, counting(str(calls)), path, **OPTS)
    assert 0 < answered < len(os.listdir(calls)) and all(f.endswith(".0") for f in os.listdir(calls))
    whole = str(tmp_path / "whole")
    run_generation(docs, make_client, whole, chunk_size=64, overlap=16)
    assert pairs(spark, path) == pairs(spark, whole)


def test_unfinished_chunks_are_neither_asked_nor_appended_again(spark, docs, tmp_path):
    # four pairs are wanted, the model gives at most three: no chunk is ever done
    calls = tmp_path / "calls"
    calls.mkdir()
    path = str(tmp_path / "pairs")
    run_generation(docs, counting(str(calls)), path, generate_num=4, **OPTS)
    once = pairs(spark, path)
    res = run_generation(docs, counting(str(calls)), path, generate_num=4, **OPTS)
    assert pairs(spark, path) == once and res.new_pairs.count() == 0
    assert all(f.endswith(".0") for f in os.listdir(calls))


def test_failed_calls_are_asked_again(spark, docs, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    path, whole = str(tmp_path / "pairs"), str(tmp_path / "whole")
    first = run_generation(docs, counting(str(calls), fail="number 3"), path, **OPTS)
    assert {r.source for r in first.errors.filter("stage = 'question'").collect()} == {"d3"}
    assert [r.source for r in first.errors.filter("stage = 'document'").collect()] == ["none"]
    second = run_generation(docs, counting(str(calls)), path, **OPTS)
    assert {r.source for r in second.new_pairs.collect()} == {"d3"}
    run_generation(docs, make_client, whole, chunk_size=64, overlap=16)
    assert pairs(spark, path) == pairs(spark, whole)


def test_small_waves_run_at_once(spark, docs, tmp_path, monkeypatch):
    """waves of fewer tasks than slots do not wait for each other; appends to the sink do."""
    import threading

    import sftprep.plans.qa as Q

    lock, now, most = threading.Lock(), {}, {}

    def counted(name, real):
        def call(*args, **kw):
            with lock:
                now[name] = now.get(name, 0) + 1
                most[name] = max(most.get(name, 0), now[name])
            try:
                return real(*args, **kw)
            finally:
                with lock:
                    now[name] -= 1
        return call

    for name in ("_ask", "append_pairs"):
        monkeypatch.setattr(Q, name, counted(name, getattr(Q, name)))
    calls = tmp_path / "calls"
    calls.mkdir()
    path, whole = str(tmp_path / "pairs"), str(tmp_path / "whole")
    run_generation(docs, counting(str(calls)), path, max_waves=3, **OPTS)
    run_generation(docs, counting(str(calls)), path, **OPTS)
    assert 1 < most["_ask"] <= 4 and most["append_pairs"] == 1
    assert all(f.endswith(".0") for f in os.listdir(calls))
    run_generation(docs, make_client, whole, chunk_size=64, overlap=16)
    assert pairs(spark, path) == pairs(spark, whole)


def test_an_empty_log(spark, tmp_path):
    log = ReplyLog(spark, str(tmp_path / "none"))
    assert log.is_new() and log.read().count() == 0
