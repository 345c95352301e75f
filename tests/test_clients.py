"""Client and tokenizer factories, without network or ports."""

import io
import json

from pyspark.sql import functions as F

from sftprep.functions.prompts import user_message
from sftprep.functions.tokens import subword_token_ids, tokenizer_file_factory
from sftprep.operators import clients
from sftprep.operators.generate import generate_replies


class _Resp(io.BytesIO):
    def __enter__(self):
        return self

    def __exit__(self, *a):
        return False


def test_openai_compatible_client_protocol(monkeypatch):
    seen = []

    def fake_urlopen(req, timeout):
        body = json.loads(req.data.decode())
        seen.append((req.full_url, req.headers.get("Authorization"), body))
        text = body["messages"][-1]["content"]
        if text == "fail":
            raise OSError("boom")
        return _Resp(json.dumps({"choices": [{"message": {"content": text.upper()}}]}).encode())

    monkeypatch.setattr(clients.urllib.request, "urlopen", fake_urlopen)
    sleeps = []
    monkeypatch.setattr(clients.time, "sleep", sleeps.append)
    monkeypatch.setenv("TEST_KEY", "k123")
    client = clients.openai_compatible("http://llm.invalid/v1", "m", api_key_env="TEST_KEY", retries=1)()
    out = client([[{"role": "user", "content": "hi"}], [{"role": "user", "content": "fail"}]],
                 max_tokens=7, temperature=0.1)
    assert out[0] == "HI" and isinstance(out[1], OSError)
    url, auth, body = seen[0]
    assert url == "http://llm.invalid/v1/chat/completions" and auth == "Bearer k123"
    assert body["max_tokens"] == 7 and body["temperature"] == 0.1 and body["model"] == "m"
    assert sum(1 for s in seen if s[2]["messages"][-1]["content"] == "fail") == 2  # one retry
    assert sleeps == [1.0]  # backoff before the retry


def exception_client():
    def reply(m):
        text = m[-1]["content"]
        if "x" in text:
            return ValueError("bad row")
        if "d" in text:
            return {"not": "a string"}
        return "ok"
    return lambda batch, **_: [reply(m) for m in batch]


def test_exceptions_become_row_errors(spark):
    df = spark.createDataFrame([(1, "a"), (2, "x"), (3, "d")], "k int, t string").select(
        "k", user_message(F.col("t")).alias("messages"))
    got = {r.k: (r.response, r.error) for r in generate_replies(df, exception_client, carry=["k"]).collect()}
    assert got == {1: ("ok", None), 2: (None, "ValueError: bad row"), 3: (None, "non-string reply: dict")}


def test_tokenizer_file_factory(spark, tmp_path):
    from tokenizers import Tokenizer
    from tokenizers.models import WordLevel
    from tokenizers.pre_tokenizers import Whitespace

    tok = Tokenizer(WordLevel({"[UNK]": 0, "hello": 1, "world": 2}, unk_token="[UNK]"))
    tok.pre_tokenizer = Whitespace()
    path = str(tmp_path / "tokenizer.json")
    tok.save(path)
    df = spark.createDataFrame([("hello world hello other",)], "t string")
    ids = df.select(subword_token_ids(F.col("t"), tokenizer_file_factory(path), 3).alias("ids")).first().ids
    assert ids == [1, 2, 1]
