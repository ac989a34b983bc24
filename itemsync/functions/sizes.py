"""Printed size of a document, the measure request limits are stated in.

A request may hold so many characters of the printed form of its documents:
``{'type': 'Tasks', 'id': '7', ...}``. The size is computed from lengths, the
text itself is never built.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Anything printed as an escape of 4, 6 or 10 characters. The first pattern is a
# quick test that lets ordinary ASCII pass.
NOT_PLAIN = r"[^ -~\n\r\t]"
UNPRINTABLE = r"[\p{C}\p{Z}&&[^ \t\n\r]]"
UNPRINTABLE_NARROW = r"[\p{C}\p{Z}&&[^ \t\n\r]&&[\x{0}-\x{ff}]]"
UNPRINTABLE_WIDE = r"[\p{C}\p{Z}&&[\x{10000}-\x{10ffff}]]"


def _without(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def text_size(text: Column) -> Column:
    """Length of the quoted form of ``text``; 4 (``None``) where it is missing."""
    bare = text
    for doubled_char in ("\n", "\r", "\t", "\\"):
        bare = F.replace(bare, F.lit(doubled_char), F.lit(""))
    doubled = F.length(text) - F.length(bare)
    both_quotes = F.contains(text, F.lit("'")) & F.contains(text, F.lit('"'))
    quotes = F.when(both_quotes, F.length(text) - F.length(F.replace(text, F.lit("'"), F.lit("")))).otherwise(0)
    escapes = F.when(
        text.rlike(NOT_PLAIN) & text.rlike(UNPRINTABLE),
        5 * _without(text, UNPRINTABLE) - 2 * _without(text, UNPRINTABLE_NARROW) + 4 * _without(text, UNPRINTABLE_WIDE),
    ).otherwise(0)
    return F.coalesce(F.length(text) + 2 + doubled + quotes + escapes, F.lit(4)).cast("long")


def list_size(texts: Column) -> Column:
    """Length of the printed list of texts."""
    inner = F.aggregate(F.transform(texts, text_size), F.lit(0).cast("long"), lambda total, size: total + size)
    return F.coalesce(inner + 2 + 2 * F.greatest(F.size(texts) - 1, F.lit(0)), F.lit(4)).cast("long")


def record_size(texts: dict[str, Column], lists: dict[str, Column] | None = None, optional: dict[str, Column] | None = None) -> Column:
    """Length of the printed record ``{'key': value, ...}``.

    ``texts`` and ``lists`` are always present; a missing text counts as
    ``None``. A key of ``optional`` is left out of the record where its value is
    missing.
    """
    parts = [F.lit(4 + len(key)) + text_size(value) for key, value in texts.items()]
    parts += [F.lit(4 + len(key)) + list_size(value) for key, value in (lists or {}).items()]
    entries = F.lit(len(parts))
    for key, value in (optional or {}).items():
        parts.append(F.when(value.isNotNull(), F.lit(4 + len(key)) + text_size(value)).otherwise(0))
        entries = entries + value.isNotNull().cast("int")
    total = F.lit(2)
    for part in parts:
        total = total + part
    return (total + 2 * (entries - 1)).cast("long")


def document_size() -> Column:
    """Size of a row of the document schema."""
    return record_size(
        texts={name: F.col(name) for name in ("type", "id", "title", "body")},
        lists={"_allow_permissions": F.col("_allow_permissions")},
        optional={name: F.col(name) for name in ("url", "created_at", "created")},
    )


def size_without_body(size: Column, body: Column) -> Column:
    """Size after the body has been replaced by a missing value."""
    return (size - text_size(body) + 4).cast("long")
