"""Ordering with explicit tie-breaks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_k(df: DataFrame, by: str, k: int, ties: Sequence[str]) -> DataFrame:
    """The ``k`` rows with the largest ``by``; each task keeps only its own best ``k``."""
    return df.orderBy(F.desc(by), *ties).limit(k)


def top_k_per_group(df: DataFrame, group: str, by: str, k: int, ties: Sequence[str]) -> DataFrame:
    """Best ``k`` rows of each group. Spark cuts every group to ``k`` rows per
    task before the shuffle, so a large group never travels whole."""
    w = Window.partitionBy(group).orderBy(F.desc(by), *ties)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= k).drop("_rank")


def over_rows(agg: Column, order: str, rows: int | None = None) -> Column:
    """``agg`` over the last ``rows`` rows, or over all rows so far. Reduced frames only."""
    start = Window.unboundedPreceding if rows is None else 1 - rows
    return agg.over(Window.orderBy(order).rowsBetween(start, 0))
