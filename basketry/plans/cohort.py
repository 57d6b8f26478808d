"""Registration cohorts: spending and retention by months since registration.

Orders are reduced to one row per user and month before users are joined. A
very active user is then a few rows, and distinct users become a plain count.
The long form is the scalable result; ``pivot_*`` shapes it for display.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from basketry.functions.calendar import months_apart, year_month
from basketry.functions.numeric import mean, pct, sum_money, units
from basketry.operators.joins import HotKeys, attach


def cohorts(users: DataFrame) -> DataFrame:
    return users.select("user_id", year_month("registration_date").alias("cohort"),
                        F.to_date("registration_date").alias("_registered"))


def cohort_activity(orders: DataFrame, users: DataFrame, hot_users: HotKeys | None = None) -> DataFrame:
    """Every transaction with its user's cohort and the months since registration."""
    dated = orders.select("transaction_id", "user_id", "date", "total")
    return attach(dated, cohorts(users), "user_id", hot=hot_users).select(
        "transaction_id", "user_id", "cohort", year_month("date").alias("txn_month"),
        months_apart(F.col("date"), F.col("_registered")).alias("months_since_reg"), units("total").alias("total"),
    )


def _user_months(orders: DataFrame) -> DataFrame:
    return orders.groupBy("user_id", F.trunc("date", "month").alias("_month")).agg(
        sum_money("total").alias("_total"), F.count("*").alias("_n")
    )


def cohort_cells(orders: DataFrame, users: DataFrame) -> DataFrame:
    """``cohort, months_since_reg, revenue, active_users`` for every non-empty cell."""
    placed = _user_months(orders).join(cohorts(users), "user_id")
    return placed.groupBy("cohort", months_apart(F.col("_month"), F.col("_registered")).alias("months_since_reg")).agg(
        F.sum("_total").alias("revenue"), F.count("*").alias("active_users")
    )


def cohort_spending(orders: DataFrame, users: DataFrame) -> DataFrame:
    return cohort_cells(orders, users).select("cohort", "months_since_reg", "revenue").orderBy("cohort", "months_since_reg")


def cohort_retention(orders: DataFrame, users: DataFrame) -> DataFrame:
    return cohort_cells(orders, users).select("cohort", "months_since_reg", "active_users").orderBy("cohort", "months_since_reg")


def cohort_retention_pct(orders: DataFrame, users: DataFrame) -> DataFrame:
    """Share of all registered users of the cohort that bought; cohorts without purchases are absent."""
    sizes = cohorts(users).groupBy("cohort").agg(F.count("user_id").alias("cohort_size"))
    return cohort_cells(orders, users).join(sizes, "cohort").select(
        "cohort", "months_since_reg", "cohort_size", pct("active_users", "cohort_size").alias("retention_pct")
    ).orderBy("cohort", "months_since_reg")


def cohort_summary(orders: DataFrame, users: DataFrame) -> DataFrame:
    per_user = orders.groupBy("user_id").agg(sum_money("total").alias("_total"), F.count("*").alias("_n"))
    return per_user.join(cohorts(users), "user_id").groupBy("cohort").agg(
        F.count("*").alias("active_users"), F.sum("_n").alias("total_transactions"), F.sum("_total").alias("total_revenue")
    ).withColumn("avg_order_value", mean("total_revenue", "total_transactions", 2)).orderBy("cohort")


def cohort_spending_calendar(order_revenue: DataFrame, users: DataFrame) -> DataFrame:
    """Line revenue per cohort and calendar month; users without a date form their own cohort."""
    monthly = order_revenue.groupBy("user_id", year_month("date").alias("activity_month")).agg(F.sum("subtotal").alias("_rev"))
    labelled = monthly.join(cohorts(users), "user_id", "left")
    return labelled.groupBy(F.coalesce("cohort", F.lit("Unknown")).alias("cohort_month"), "activity_month").agg(
        F.sum("_rev").alias("revenue")
    ).orderBy("cohort_month", "activity_month")


def matrix(cells: DataFrame, cohort: str, period: str, value: str) -> DataFrame:
    """One row per cohort with a map from period to value over all its non-empty cells; the schema fits any data.

    A cohort has as many entries as periods, so the map is as long as the history in months.
    """
    entries = F.map_from_entries(F.sort_array(F.collect_list(F.struct(period, value))))
    return cells.groupBy(cohort).agg(entries.alias(value)).orderBy(cohort)


def pivot_offsets(cells: DataFrame, value: str, offsets: Sequence[int] | None = None) -> DataFrame:
    """One column ``m<offset>`` per offset that occurs, or per stated one; empty cells stay NULL."""
    offsets = _occurring(cells, "months_since_reg") if offsets is None else offsets
    wide = cells.groupBy("cohort").pivot("months_since_reg", list(offsets)).agg(F.max(value))
    return wide.withColumnsRenamed({str(o): f"m{o}" for o in offsets}).orderBy("cohort")


def pivot_months(calendar: DataFrame, months: Sequence[str] | None = None) -> DataFrame:
    """One column per month that occurs, or per stated one; empty cells are 0."""
    months = _occurring(calendar, "activity_month") if months is None else months
    wide = calendar.groupBy("cohort_month").pivot("activity_month", list(months)).agg(F.sum("revenue"))
    return wide.na.fill(0, list(months)).orderBy("cohort_month")


def _occurring(cells: DataFrame, column: str) -> list:
    """The values of a column of months or offsets: as many as the history has months."""
    return [r[0] for r in cells.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column).collect()]
