"""Tokenize and truncate.

The built-in tokenizer is whitespace splitting, a native expression.  A
subword tokenizer plugs in as an Arrow ``pandas_udf`` whose tokenizer object
is built once per Python worker by a user factory.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sftprep.session import ensure_library_on_workers, factory_key

# whitespace class spelled out so every regex engine reads it the same way
WHITESPACE = "[ \\t\\n\\r\\f]+"
DEFAULT_MAX_TOKENS = 2048


def whitespace_tokens(text: Column, max_tokens: int = DEFAULT_MAX_TOKENS) -> Column:
    """First ``max_tokens`` whitespace tokens, no padding, no special tokens."""
    toks = F.filter(F.split(text, WHITESPACE, -1), lambda t: t != F.lit(""))
    return F.slice(toks, 1, max_tokens)


_TOKENIZERS: dict[str, object] = {}


def worker_tokenizer(key: str, factory: Callable) -> object:
    """This worker's tokenizer, built once (top-level so workers share the cache)."""
    tok = _TOKENIZERS.get(key)
    if tok is None:
        tok = _TOKENIZERS[key] = factory()
    return tok


def subword_token_ids(
    text: Column,
    tokenizer_factory: Callable[[], Callable[[str], list[int]]],
    max_tokens: int = DEFAULT_MAX_TOKENS,
    cache_key: str | None = None,
) -> Column:
    """ARRAY<INT> ids from a user tokenizer, truncated; one tokenizer per worker."""
    key = cache_key or factory_key(tokenizer_factory)
    ensure_library_on_workers()

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def ids(texts: pd.Series) -> pd.Series:
        tok = worker_tokenizer(key, tokenizer_factory)
        return pd.Series([None if t is None else list(tok(t))[:max_tokens] for t in texts])

    return ids(text)


def tokenizer_file_factory(path: str) -> Callable[[], Callable[[str], list[int]]]:
    """Factory for a serialized ``tokenizers`` tokenizer (``tokenizer.json``).

    Encodes without special tokens and without padding; truncation is done
    by ``subword_token_ids``.  The file must be readable from every worker
    (shared storage or shipped with ``SparkContext.addFile``).
    """

    def factory():
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        return lambda text: tok.encode(text, add_special_tokens=False).ids

    return factory
