"""Mergeable daily states: reports that grow by batches instead of starting over.

A state has rows per day and is partitioned by month and batch (days as partitions would be very many small files).
Adding a batch writes the partitions of its own months and batch and reads or changes no other, so late rows are one
more partition of their month, and a batch that is run again replaces what it had written. Reports merge the rows they
need: sums add up, first and last times are the least and greatest, and sets of users are bitmaps that are united, so
distinct users of any period come from the days. A bitmap is kept as its words of 64 users that are not empty, a row
each, so a day never has more rows than buyers, and words are united without sorting. Distributions are KLL sketches: merged over the days of a period they
tell between which values a quantile lies, and one scan of those days' values makes it exact.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from basketry.functions.numeric import dbl, units
from basketry.operators.quantiles import QUARTILES, between_brackets, bracketed
from basketry.plans import etl
from basketry.session import durable


def add(state: DataFrame, path: str, batch: str) -> None:
    """Write the months of one batch; all other partitions stay as they are."""
    rows = state.withColumns({"month": F.date_format("date", "yyyy-MM"), "batch": F.lit(batch)}).hint("rebalance", "month")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month", "batch").parquet(path)


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The whole state, days once for each batch that has them."""
    places = [T.StructField(c, T.StringType()) for c in ("month", "batch")]
    return spark.read.schema(T.StructType([*schema.fields, *places])).parquet(path)


def between(state: DataFrame, first: date, last: date) -> DataFrame:
    """The days from ``first`` to ``last``; only the folders of their months are opened."""
    return state.filter(F.col("month").between(f"{first:%Y-%m}", f"{last:%Y-%m}") & F.col("date").between(first, last))


def product_days(sales: DataFrame) -> DataFrame:
    """``date, product_id`` with sums of their lines, amounts in cents."""
    return sales.groupBy("date", "product_id").agg(
        F.sum("quantity").alias("quantity"), F.sum("subtotal").alias("revenue"), F.count("*").alias("lines"), F.sum("unit_price").alias("prices"))


def product_daily_metrics(state: DataFrame, products: DataFrame) -> DataFrame:
    """``etl.product_daily_metrics`` from the state."""
    daily = state.groupBy("product_id", "date").agg(
        F.sum("quantity").alias("total_quantity"), units(F.sum("revenue")).alias("total_revenue"), F.sum("lines").alias("num_transactions"),
        units(F.sum("prices")).alias("_prices"))
    return etl.metrics_of_days(daily, products)


def purchase_days(orders: DataFrame) -> DataFrame:
    """``date, user_id, payment_method`` with number, amount in cents, first and last time of their orders."""
    return orders.groupBy("date", "user_id", "payment_method").agg(
        F.count("*").alias("orders"), F.sum("total").alias("spent"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last"))


def purchase_summary(state: DataFrame) -> DataFrame:
    """``etl.purchase_summary`` from the state."""
    return etl.summary_of_methods(state.groupBy("user_id", "payment_method").agg(
        F.sum("orders").alias("n"), units(F.sum("spent")).alias("spent"), F.min("first").alias("first"), F.max("last").alias("last")))


def numbered(rows: DataFrame, key: str, known: DataFrame | None = None) -> DataFrame:
    """``key, number``: every distinct key under a number, without gaps from 0. Numbers in ``known`` stay, new keys follow them.

    Keys are sorted by ranges and numbered where they lie; the driver sees the number of keys of each partition.
    """
    keys = rows.filter(F.col(key).isNotNull()).select(key).distinct()
    first = 0
    if known is not None:
        keys = keys.join(known, key, "left_anti")
        last = known.agg(F.max("number")).first()[0]
        first = 0 if last is None else last + 1
    place = keys.repartitionByRange(key).sortWithinPartitions(key).withColumn("_at", F.monotonically_increasing_id())
    placed = durable(place, "numbered").withColumn("_part", F.shiftright("_at", 33).cast("int"))
    starts, sizes = [], placed.groupBy("_part").count().orderBy("_part").collect()
    for row in sizes:
        starts.append((row["_part"], first))
        first += row["count"]
    start = rows.sparkSession.createDataFrame(starts, "_part int, _start long")  # a row per partition
    new = placed.join(F.broadcast(start), "_part").select(key, (F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).alias("number"))
    return new if known is None else known.unionByName(new)


WORD_BITS = 64


def buyer_days(orders: DataFrame, numbers: DataFrame) -> DataFrame:
    """``date, payment_method, bucket, users``: who ordered, as words of a bitmap over the users' numbers; ``bucket`` is the place of a word."""
    seen = orders.select("date", "payment_method", "user_id").distinct().join(numbers, "user_id")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("number").bitwiseAND(F.lit(WORD_BITS - 1)).cast("int"))
    return seen.groupBy("date", "payment_method", F.shiftright("number", WORD_BITS.bit_length() - 1).alias("bucket")).agg(F.bit_or(bit).alias("users"))


def buyers(state: DataFrame, label: Column) -> DataFrame:
    """``label, buyers``: distinct users under each label, which is any expression over the days and payment methods."""
    united = state.groupBy(label.alias("label"), "bucket").agg(F.bit_or("users").alias("users"))
    return united.groupBy("label").agg(F.sum(F.bit_count("users").cast("bigint")).alias("buyers"))


SKETCH_K = 4096  # size of a sketch: some 60 KB at most, a rank is off by 0.13 % with 99 % confidence
MARGIN = 4 * 2.296 / SKETCH_K**0.9021  # share of the rows left on either side of a rank, four times that error


def value_days(rows: DataFrame, value: str, group: str) -> DataFrame:
    """``date, group, n, min, max, sketch`` of the values of each day; days and groups without a value have none."""
    found = rows.select("date", F.col(group), dbl(value).alias("_v")).filter("_v IS NOT NULL")
    return found.groupBy("date", group).agg(
        F.count("*").alias("n"), F.min("_v").alias("min"), F.max("_v").alias("max"), F.kll_sketch_agg_double("_v", F.lit(SKETCH_K)).alias("sketch"))


def value_summary(state: DataFrame, rows: DataFrame, value: str, group: str, probs: Sequence[float] = QUARTILES, digits: int = 2) -> DataFrame:
    """``summary_by`` of the rows of the state's days, without a pass that narrows: ``rows`` are scanned once, and must be of the same days."""
    merged = state.groupBy(F.col(group).alias("_g")).agg(
        F.sum("n").alias("n"), F.min("min").alias("min"), F.max("max").alias("max"), F.kll_merge_agg_double("sketch", F.lit(SKETCH_K)).alias("_sketch"))
    at = lambda p: F.kll_sketch_get_quantile_double("_sketch", F.lit(p))
    # Where the margin is less than a row or two the whole range is used.
    narrowed = bracketed(merged, ["n", "min", "max"], probs, F.col("n") * MARGIN < 2, [at(max(0.0, p - MARGIN)) for p in probs],
                         [at(min(1.0, p + MARGIN)) for p in probs], grouped=True)
    values = rows.select(F.col(group).alias("_g"), dbl(value).alias("_v"))
    return between_brackets(values, narrowed, ["n", "min", "max"], probs, digits, grouped=True).withColumnRenamed("_g", group)
