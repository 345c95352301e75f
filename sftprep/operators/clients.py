"""Client factories for ``generate_replies``.

A factory is called once per Python worker and returns a callable that takes
a batch of message lists and returns one reply per prompt: a string, None
(no reply) or an Exception (recorded in the ``error`` column).

``openai_compatible`` speaks the widely used ``/v1/chat/completions`` HTTP
protocol (hosted APIs and self-hosted servers alike) with a bounded pool of
concurrent requests per worker; it needs only the standard library.
"""

from __future__ import annotations

import json
import os
import time
import urllib.error
import urllib.request
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any


#: client errors worth another attempt: timeout, conflict, too early, rate limit
RETRIED_STATUS = (408, 409, 425, 429)


class OpenAICompatibleClient:
    def __init__(self, base_url: str, model: str, api_key: str | None, concurrency: int,
                 timeout: float, retries: int, backoff: float = 1.0):
        self.url = base_url.rstrip("/") + "/chat/completions"
        self.model = model
        self.api_key = api_key
        self.pool = ThreadPoolExecutor(max_workers=max(1, concurrency))
        self.timeout = timeout
        self.retries = retries
        self.backoff = backoff

    def _one(self, messages: list[dict], max_tokens: int, temperature: float) -> Any:
        body = json.dumps({
            "model": self.model, "messages": messages,
            "max_tokens": max_tokens, "temperature": temperature,
        }).encode("utf-8")
        headers = {"Content-Type": "application/json"}
        if self.api_key:
            headers["Authorization"] = f"Bearer {self.api_key}"
        last: Exception | None = None
        for attempt in range(self.retries + 1):
            if attempt:  # exponential backoff for rate limits and transient server errors
                time.sleep(min(self.backoff * 2 ** (attempt - 1), 60.0))
            try:
                req = urllib.request.Request(self.url, data=body, headers=headers, method="POST")
                with urllib.request.urlopen(req, timeout=self.timeout) as resp:
                    payload = json.loads(resp.read().decode("utf-8"))
                return payload["choices"][0]["message"]["content"]
            except urllib.error.HTTPError as exc:
                last = exc
                if exc.code < 500 and exc.code not in RETRIED_STATUS:
                    break  # the request itself is wrong: asking again cannot help
            except Exception as exc:  # noqa: BLE001 - retried, then reported per row
                last = exc
        return last

    def __call__(self, batch: list[list[dict]], max_tokens: int = 4096, temperature: float = 0.5) -> list:
        return list(self.pool.map(lambda m: self._one(m, max_tokens, temperature), batch))


def openai_compatible(
    base_url: str,
    model: str,
    api_key_env: str | None = None,
    concurrency: int = 8,
    timeout: float = 120.0,
    retries: int = 2,
    backoff: float = 1.0,
) -> Callable[[], OpenAICompatibleClient]:
    """Factory for a chat-completions endpoint.

    The API key is read on the worker from the environment variable named by
    ``api_key_env`` (never shipped inside the task closure).  Total request
    concurrency is ``concurrency`` times the number of running tasks.
    """

    def factory() -> OpenAICompatibleClient:
        key = os.environ.get(api_key_env) if api_key_env else None
        return OpenAICompatibleClient(base_url, model, key, concurrency, timeout, retries, backoff)

    return factory
