"""Labels and text search."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

LABEL_CHARS = 25


def product_label(name: Column, category: Column) -> Column:
    """Name cut to 25 characters plus the category in brackets."""
    short = F.when(F.length(name) > LABEL_CHARS, F.concat(F.substring(name, 1, LABEL_CHARS), F.lit("..."))).otherwise(name)
    return F.concat(short, F.lit(" ["), category, F.lit("]"))


def contains_ignore_case(col: Column | str, text: str) -> Column:
    """Literal, case-insensitive substring test; NULL never matches."""
    return F.coalesce(F.contains(F.lower(col), F.lower(F.lit(text))), F.lit(False))


def share_label(count: Column, pct: Column) -> Column:
    return F.concat(count.cast("string"), F.lit(" ("), pct.cast("string"), F.lit("%)"))


def thousands(col: Column | str) -> Column:
    """Whole number with thousands separators."""
    return F.format_number(col, 0)
