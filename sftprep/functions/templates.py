"""Compile ``str.format``-style templates into one ``concat`` Column.

A template is split once into literal pieces and named fields; each field is
bound to a Column.  The result is a single ``concat`` of literals and columns,
so inserted text is never rescanned for placeholders (unlike nested
``replace`` calls) and the expression stays inside whole-stage codegen.

Optional sections ``[[ ... ]]`` are kept only when every field inside them
is non-empty (the merged-prompt convention of the chat-dataset tools).
"""

from __future__ import annotations

import string
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str | int | float


def _as_col(v: ColumnLike) -> Column:
    if isinstance(v, Column):
        return v
    return F.lit(str(v))


def template_fields(template: str) -> list[str]:
    return [f for _, f, _, _ in string.Formatter().parse(template) if f is not None]


def fill(template: str, values: Mapping[str, ColumnLike]) -> Column:
    """Single-pass fill; a NULL value is inserted as the empty string."""
    parts: list[Column] = []
    for literal, field, spec, conv in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if field is None:
            continue
        if spec or conv:
            raise ValueError(f"format specs are not supported: {{{field}!{conv}:{spec}}}")
        if field not in values:
            raise KeyError(f"template field {field!r} has no value")
        parts.append(F.coalesce(_as_col(values[field]).cast("string"), F.lit("")))
    if not parts:
        return F.lit("")
    return F.concat(*parts)


def _split_optional(template: str) -> list[tuple[bool, str]]:
    out: list[tuple[bool, str]] = []
    rest = template
    while rest:
        i = rest.find("[[")
        if i < 0:
            out.append((False, rest))
            break
        j = rest.find("]]", i + 2)
        if j < 0:
            raise ValueError("unclosed [[ in template")
        if i:
            out.append((False, rest[:i]))
        out.append((True, rest[i + 2 : j]))
        rest = rest[j + 2 :]
    return out


def fill_optional(template: str, values: Mapping[str, ColumnLike]) -> Column:
    """``fill`` with ``[[...]]`` sections dropped when one of their fields is empty/NULL."""
    parts: list[Column] = []
    for optional, piece in _split_optional(template):
        col = fill(piece, values)
        if optional:
            present = F.lit(True)
            for f in template_fields(piece):
                v = _as_col(values[f]).cast("string")
                present = present & v.isNotNull() & (v != F.lit(""))
            col = F.when(present, col).otherwise(F.lit(""))
        parts.append(col)
    return F.concat(*parts) if parts else F.lit("")
