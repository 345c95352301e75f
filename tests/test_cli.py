"""Command line front end, run in-process on the test session."""

import json
import os

from sftprep import cli

from conftest import SF001


def test_generate_command(spark, tmp_path, capsys):
    src = tmp_path / "docs"
    src.mkdir()
    (src / "one.txt").write_text("First sentence here. " * 20, encoding="utf-8")
    (src / "two.md").write_text("Second, with commas. " * 10, encoding="utf-8")
    (src / "skip.html").write_text("<p>no</p>", encoding="utf-8")
    out = tmp_path / "out"
    cli.main(["generate", "--input", str(src), "--output", str(out), "--client", "sftprep_checks.stub_client:make_client",
              "--chunk-size", "100", "--chunk-overlap", "20"], spark=spark)
    assert "new pairs:" in capsys.readouterr().out
    pairs = spark.read.json(str(out / "pairs"))
    assert {r.source for r in pairs.select("source").distinct().collect()} == {"one_txt", "two_md"}
    train = spark.read.json(str(out / "train_data"))
    assert train.columns == ["input", "instruction", "output"] and train.count() == pairs.count()
    # a second run resumes: nothing new
    cli.main(["generate", "--input", str(src), "--output", str(out), "--client", "sftprep_checks.stub_client:make_client",
              "--chunk-size", "100", "--chunk-overlap", "20"], spark=spark)
    assert "new pairs: 0" in capsys.readouterr().out


def test_chat_dataset_command(spark, tmp_path):
    recs = [{"instruction": f"i{n}", "input": "", "output": f"o{n}"} for n in range(5)]
    p = tmp_path / "train.json"
    p.write_text(json.dumps(recs, indent=2), encoding="utf-8")
    out = str(tmp_path / "chat")
    cli.main(["chat-dataset", "--input", str(p), "--output", out, "--extension", "2"], spark=spark)
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 5 and all(len(r.conversations) == 4 for r in rows)


def test_vendor_dataset_command(spark, tmp_path, capsys):
    (tmp_path / "image").mkdir()
    for n in range(5):
        (tmp_path / "image" / f"{n}.jpg").write_bytes(bytes.fromhex("FFD8FFE0") + bytes([n]))
    (tmp_path / "metadata.jsonl").write_text("\n".join(
        json.dumps({"file_name": f"{n}.jpg", "instruction": "Q", "text": f"A{n}"}) for n in range(5)), encoding="utf-8")
    cli.main(["vendor-dataset", "--dataset-dir", str(tmp_path), "--num-shards", "2"], spark=spark)
    printed = capsys.readouterr().out
    assert "train-00000-of-00002.parquet: 3 rows" in printed and "train-00001-of-00002.parquet: 2 rows" in printed
    assert os.path.isdir(tmp_path / "data")


def test_calibration_command(spark, tmp_path):
    out = str(tmp_path / "cal")
    cli.main(["calibration", "--input", f"{SF001}/conversations.parquet", "--output", out, "--samples", "9",
              "--max-tokens", "16"], spark=spark)
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 9 and all(len(r.tokens) <= 16 for r in rows)


def test_vlm_dataset_command(spark, tmp_path, capsys):
    (tmp_path / "ok.png").write_bytes(bytes.fromhex("89504E470D0A1A0A") + b"1")
    (tmp_path / "bad.png").write_bytes(b"text")
    (tmp_path / "train_data.jsonl").write_text("\n".join(json.dumps(r) for r in [
        {"file_name": "ok.png", "text": "an image"}, {"file_name": "bad.png", "text": "not"},
        {"file_name": "none.png", "text": "missing"}]), encoding="utf-8")
    out = str(tmp_path / "vlm")
    cli.main(["vlm-dataset", "--manifest", str(tmp_path / "train_data.jsonl"), "--output", out], spark=spark)
    assert "rejected images: 1" in capsys.readouterr().out
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 1 and rows[0].messages[1].content[0].text == "an image"


def test_generate_command_parquet_sink(spark, tmp_path, capsys):
    src = tmp_path / "docs"
    src.mkdir()
    (src / "one.txt").write_text("First sentence here. " * 20, encoding="utf-8")
    out = tmp_path / "out"
    args = ["generate", "--input", str(src), "--output", str(out), "--client", "sftprep_checks.stub_client:make_client",
            "--chunk-size", "100", "--chunk-overlap", "20", "--pairs-format", "parquet"]
    cli.main(args, spark=spark)
    first = spark.read.parquet(str(out / "pairs")).count()
    cli.main(args, spark=spark)
    assert "new pairs: 0" in capsys.readouterr().out.splitlines()[-1]
    assert spark.read.parquet(str(out / "pairs")).count() == first > 0
