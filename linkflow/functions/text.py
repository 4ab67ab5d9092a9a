"""Text functions as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LINE_BREAK = "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c\\x1d\\x1e\\x85\\u2028\\u2029]"


def strip(x: Column) -> Column:
    """Trims Unicode white space."""
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def clean_text(x: Column) -> Column:
    """Lines with single spaces, trimmed; blank lines and repeats of the line before are dropped.

    Character references are not decoded here: text from the DOM functions is decoded already.
    """
    lines = F.transform(F.split(F.coalesce(x, F.lit("")), LINE_BREAK), lambda s: strip(F.regexp_replace(s, r"[\t\r\f\x0b ]+", " ")))
    lines = F.filter(lines, lambda s: s != "")
    # The list is filtered twice with different indexes, so it is bound once.
    kept = F.element_at(F.transform(F.array(lines), lambda a: F.filter(a, lambda s, i: (i == 0) | (s != F.get(a, i - 1)))), 1)
    return F.array_join(kept, "\n")


def n_chars(x: Column) -> Column:
    return F.char_length(F.coalesce(x, F.lit("")))


def sha256(x: Column) -> Column:
    return F.when(F.coalesce(x, F.lit("")) == "", "").otherwise(F.sha2(x.cast("binary"), 256))


def or_else(*xs: Column) -> Column:
    """The first that is neither null nor empty, else ""."""
    return F.coalesce(*[F.nullif(x, F.lit("")) for x in xs], F.lit(""))
