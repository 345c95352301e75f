"""Task failure in a model stage: Spark retries the task and the result stays whole and exact.

Runs in its own Spark application (``local[2,4]``: up to 4 attempts per task) so
the shared test session is untouched.
"""

import json
import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent(
    """
    import json, os, sys
    sys.path.insert(0, {root!r})
    from pyspark.sql import SparkSession, functions as F
    from sftprep.plans.qa import generate_qa_pairs
    from sftprep.session import ship_code

    MARK = {mark!r}

    def flaky_factory():
        # the first build anywhere fails the whole task (not a per-row error)
        try:
            fd = os.open(MARK, os.O_CREAT | os.O_EXCL)
            os.close(fd)
            raise RuntimeError("worker lost")
        except FileExistsError:
            from sftprep_checks.stub_client import make_client
            return make_client()

    spark = (SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "4").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    ship_code(spark, os.path.join({root!r}, "sftprep_checks"))
    docs = spark.createDataFrame([("d%d" % i, "Sentence number %d here. " % i * 30) for i in range(6)],
                                 "source string, text string")
    res = generate_qa_pairs(docs, flaky_factory, chunk_size=120, overlap=20, call_partitions=4)
    pairs = res.pairs
    out = dict(n=pairs.count(), distinct=pairs.select("source", "chunk_id", "question_no").distinct().count(),
               errors=res.errors.count(), failed_once=os.path.exists(MARK))
    ref = generate_qa_pairs(docs, lambda: __import__("sftprep_checks.stub_client", fromlist=["x"]).make_client(),
                            chunk_size=120, overlap=20, call_partitions=4).pairs
    out["same"] = pairs.drop("question_no").exceptAll(ref.drop("question_no")).count() == 0 and \\
        ref.drop("question_no").exceptAll(pairs.drop("question_no")).count() == 0
    print("RESULT " + json.dumps(out))
    spark.stop()
    """
)


def test_generation_survives_a_failed_task(tmp_path):
    mark = str(tmp_path / "failed-once")
    script = tmp_path / "run.py"
    script.write_text(SCRIPT.format(root=ROOT, mark=mark), encoding="utf-8")
    env = dict(os.environ, PYTHONPATH=os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")]))
    proc = subprocess.run([sys.executable, str(script)], capture_output=True, text=True, timeout=600,
                          env=env, cwd=str(tmp_path))
    line = next((ln for ln in proc.stdout.splitlines() if ln.startswith("RESULT ")), None)
    assert line, proc.stderr[-3000:]
    out = json.loads(line[len("RESULT "):])
    assert out["failed_once"] and out["errors"] == 0
    assert out["n"] == out["distinct"] > 0  # every (chunk, question) exactly once
    assert out["same"]
