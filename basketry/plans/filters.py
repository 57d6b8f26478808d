"""Report-wide filters. Conditions stay on the scanned columns, so they are pushed down."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from basketry.functions.calendar import by_date
from basketry.operators.joins import HotKeys, attach


def by_province(df: DataFrame, provinces: Sequence[str] | None) -> DataFrame:
    return df if provinces is None else df.filter(F.col("province").isin(*provinces))


def by_category(lines: DataFrame, product_dim: DataFrame, categories: Sequence[str] | None, hot_products: HotKeys | None = None) -> DataFrame:
    """Lines of the chosen categories. Categories narrow lines only, not users or sessions."""
    if categories is None:
        return lines
    chosen = product_dim.filter(F.col("category").isin(*categories)).select("product_id")
    return attach(lines, chosen, "product_id", hot=hot_products)


def apply_filters(lines: DataFrame, users: DataFrame, sessions: DataFrame, start: date | None = None, end: date | None = None,
                  categories: Sequence[str] | None = None, provinces: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All report filters on denormalised lines, users and sessions: days narrow lines and sessions,
    categories lines only, provinces users and sessions only. ``None`` keeps everything."""
    lines = by_date(lines, start, end)
    if categories is not None:
        lines = lines.filter(F.col("category").isin(*categories))
    return lines, by_province(users, provinces), by_province(by_date(sessions, start, end, "start_time"), provinces)


def of_sessions(rows: DataFrame, sessions: DataFrame, hot_sessions: HotKeys | None = None) -> DataFrame:
    """Page views or cart rows whose session is in ``sessions`` (one row per session)."""
    return attach(rows, sessions.select("session_id"), "session_id", hot=hot_sessions)
