"""A JSON array read in byte ranges equals json.loads, wherever the cuts fall."""

import json
import random

import pytest

from sftprep.sources.files import load_training_dataset, read_training_json
from sftprep.sources.json_array import json_array_records


def values(rng, depth=0):
    kind = rng.randint(0, 5 if depth < 3 else 3)
    if kind == 0:
        return "".join(rng.choice(['"', "\\", "\\\\", "{", "}", "[", "]", ",", "é", "\n", "🙂", "a", " "]) for _ in range(rng.randint(0, 14)))
    if kind == 1:
        return rng.randint(-9, 99)
    if kind == 2:
        return None
    if kind == 3:
        return "x" * rng.randint(0, 60)
    if kind == 4:
        return [values(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    return {f"k{i}": values(rng, depth + 1) for i in range(rng.randint(0, 3))}


@pytest.mark.parametrize("seed, block", [(1, 7), (2, 64), (3, 1000)])
def test_records_equal_the_parser(spark, tmp_path, seed, block):
    rng = random.Random(seed)
    rows = [{f"f{i}": values(rng) for i in range(rng.randint(0, 4))} for _ in range(30 if block < 10 else 200)]
    path = tmp_path / "a.json"
    path.write_text(json.dumps(rows, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1])), encoding="utf-8")
    if block < 10:
        block = max(block, path.stat().st_size // 150)
    got = json_array_records(spark, str(path), path.stat().st_size, block).collect()
    key = lambda r: json.dumps(r, sort_keys=True)
    assert sorted((json.loads(r.value) for r in got), key=key) == sorted(rows, key=key)


def test_long_runs_of_backslashes(spark, tmp_path):
    rows = [{"a": "\\" * n + '"' * (n % 3)} for n in (1, 63, 64, 65, 200, 500)]
    path = tmp_path / "a.json"
    path.write_text(json.dumps(rows))
    got = json_array_records(spark, str(path), path.stat().st_size, 37).collect()
    assert sorted(json.loads(r.value)["a"] for r in got) == sorted(r["a"] for r in rows)


@pytest.mark.parametrize("text", ['[{"a": 1}, 7]', '[{"a": 1}, "x"]', '[[{"a": 1}]]', '[{"a": 1}', '[{"a": "x]'])
def test_no_array_of_objects_fails(spark, tmp_path, text):
    path = tmp_path / "a.json"
    path.write_text(text)
    with pytest.raises(Exception, match="array|end"):
        json_array_records(spark, str(path), len(text), 4).collect()


def test_tasks_follow_the_bytes_not_the_blocks(spark, tmp_path):
    """many small blocks share a bounded number of tasks, and so of part files."""
    rows = [{"a": "x{]\\\"" * (i % 5), "i": i} for i in range(400)]
    path = tmp_path / "a.json"
    path.write_text(json.dumps(rows))
    df = json_array_records(spark, str(path), path.stat().st_size, 20)  # about 500 blocks
    assert df.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
    assert sorted((json.loads(r.value) for r in df.collect()), key=lambda r: r["i"]) == rows


@pytest.mark.parametrize("n", [0, 1, 500])
def test_array_written_in_pieces_is_one_json_file(spark, tmp_path, n):
    """the fixture's file is written by tasks and equals the rows in order."""
    from pyspark.sql import functions as F

    from sftprep_checks.queries import write_array

    rows = spark.range(0, n, 1, 7).select(F.to_json(F.struct("id", F.lit('é "\n,').alias("t"))).alias("value"))
    write_array(rows, f"file://{tmp_path}/a.json")
    assert json.loads((tmp_path / "a.json").read_text()) == [{"id": i, "t": 'é "\n,'} for i in range(n)]


def test_all_fields_are_kept(spark, tmp_path):
    rows = [{"instruction": "i", "output": "o", "score": 2, "tags": ["a"]}, {"instruction": "j", "input": "n", "output": "p"}]
    array, lines = tmp_path / "a.json", tmp_path / "l.jsonl"
    array.write_text(json.dumps(rows))
    lines.write_text("\n".join(map(json.dumps, rows)))
    want = [("i", None, "o", 2, ["a"]), ("j", "n", "p", None, None)]
    for df in (load_training_dataset(spark, dataset_path=str(array)), load_training_dataset(spark, dataset_path=str(lines)), read_training_json(spark, str(array), schema=None, block=16)):
        assert df.columns == ["instruction", "input", "output", "score", "tags"]
        assert sorted(map(tuple, df.collect())) == want
    assert read_training_json(spark, str(array), block=16).columns == ["instruction", "input", "output"]
