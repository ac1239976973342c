"""Command-line and token expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def fields(text: Column) -> Column:
    """Non-empty tokens between runs of (Unicode) white space."""
    return F.filter(F.split(text, r"(?U)\s+"), lambda t: t != "")


def last_field(text: Column) -> Column:
    return F.try_element_at(fields(text), F.lit(-1))


def first_field_with_prefix(text: Column, prefixes: tuple[str, ...]) -> Column:
    """The first token that starts with one of the prefixes, or NULL."""
    hit = F.filter(
        fields(text),
        lambda t: reduce(lambda a, b: a | b, [t.startswith(p) for p in prefixes]),
    )
    return F.get(hit, F.lit(0))


def contains_any(text: Column, patterns: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(p) for p in patterns])


def strip(text: Column) -> Column:
    """Trim Unicode white space at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def search_tokens(text: Column) -> Column:
    """Lower-case word tokens for full-text matching."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}_]+"), lambda t: t != "")
