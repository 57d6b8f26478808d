"""Data-quality checks, one pass per table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def null_profile(df: DataFrame) -> DataFrame:
    """``column_name, null_count`` for the columns that contain nulls."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column_name", "null_count").filter("null_count > 0")


def duplicate_key_check(df: DataFrame, key: str) -> DataFrame:
    """Rows, distinct keys (NULL counts as one value), duplicates and a verdict.

    Rows are counted per key first, so no task ever sees all keys.
    """
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    totals = per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"), F.count("*").alias("distinct_keys"))
    dup = F.col("total_rows") - F.col("distinct_keys")
    return totals.select("total_rows", "distinct_keys", dup.alias("duplicates"),
                         F.when(dup == 0, "OK").otherwise("DUPLICATES").alias("verdict"))


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    counted = [df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
               for name, df in frames.items()]
    return reduce(DataFrame.unionByName, counted)


def schemas(frames: dict[str, DataFrame]) -> dict[str, str]:
    """Schema of each table as DDL text (metadata only)."""
    return {name: df.schema.simpleString() for name, df in frames.items()}


def table_stats(df: DataFrame, key: str) -> DataFrame:
    """Row count, smallest key and the column names of a key-ordered table."""
    return df.agg(F.count("*").alias("row_count"), F.min(F.col(key).cast("string")).alias("sample_key")).select(
        "row_count", "sample_key", F.lit(",".join(df.columns)).alias("column_names")
    )
