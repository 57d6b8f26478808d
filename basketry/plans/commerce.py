"""Sales, spending and price reports.

Sales are reduced per product before products are joined, so a product holding
most lines is one row (or one per day) when it meets the product table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from basketry.functions.calendar import year_month
from basketry.functions.numeric import half_up, half_up_money, mean, pct, ratio, sample_stddev, sum_money, sum_squares, whole
from basketry.functions.segments import SPEND_BOUNDS, SPEND_LABELS, spend_bucket, spend_label
from basketry.operators.ranking import over_rows, top_k


def product_popularity(completed: DataFrame, product_dim: DataFrame, k: int = 10) -> DataFrame:
    """Best sellers by quantity among completed sales. The limit comes before
    the product join: unknown products shorten the list."""
    best = top_k(
        completed.groupBy("product_id").agg(
            F.sum("quantity").alias("total_qty"), sum_money("subtotal").alias("total_revenue"),
            F.count("*").alias("num_orders"),
        ),
        "total_qty", k, ["product_id"],
    )
    return best.join(product_dim.select("product_id", "name", "category"), "product_id").select(
        "product_id", "name", "category", "total_qty", "total_revenue", "num_orders"
    ).orderBy(F.desc("total_qty"), "product_id")


def revenue_by_subcategory(completed: DataFrame, product_dim: DataFrame) -> DataFrame:
    per_product = completed.groupBy("product_id").agg(
        sum_money("subtotal").alias("revenue"), F.sum("quantity").alias("qty_sold"), F.count("*").alias("order_count")
    )
    return per_product.join(product_dim.select("product_id", "category", "subcategory"), "product_id").groupBy(
        "category", "subcategory"
    ).agg(F.sum("revenue").alias("revenue"), F.sum("qty_sold").alias("qty_sold"), F.sum("order_count").alias("order_count"))


def revenue_by_category(completed: DataFrame, product_dim: DataFrame) -> DataFrame:
    """Category totals with their subcategories as an array, best first.

    The array is bounded by the subcategories of a category.
    """
    by_revenue = F.array_sort(
        F.collect_list(F.struct((-F.col("revenue")).alias("_order"), F.col("subcategory").alias("name"), "revenue", "qty_sold"))
    )
    totals = revenue_by_subcategory(completed, product_dim).groupBy("category").agg(
        F.sum("revenue").alias("total_revenue"), F.sum("qty_sold").alias("total_qty"),
        F.sum("order_count").alias("total_orders"),
        F.transform(by_revenue, lambda s: s.dropFields("_order")).alias("subcategories"),
    )
    return totals.select(
        "category", "total_revenue", "total_qty", "total_orders",
        mean("total_revenue", "total_orders", 2).alias("avg_order_value"), "subcategories",
    ).orderBy(F.desc("total_revenue"), "category")


def spending_tiers(users: DataFrame, bounds: Sequence[float] = SPEND_BOUNDS, labels: Sequence[str] = SPEND_LABELS) -> DataFrame:
    """Users per spend bucket, lowest bucket first; whatever fits no bucket is "Other"."""
    n = F.col("count")
    grouped = users.groupBy(spend_bucket(F.col("total_spent"), bounds).alias("_bucket")).agg(
        F.count("*").alias("count"), F.sum("total_spent").alias("_spent"), F.sum("total_orders").alias("_orders")
    )
    return grouped.orderBy("_bucket").select(
        spend_label(F.col("_bucket"), labels).alias("tier"), "count", mean("_spent", n, 2).alias("avg_spent"),
        F.col("_spent").alias("total_spent"), mean("_orders", n, 1).alias("avg_orders"),
    )


def spending_by_province(users: DataFrame) -> DataFrame:
    """Users with orders only."""
    n = F.col("user_count")
    return users.filter("total_orders > 0").groupBy("province").agg(
        F.count("*").alias("user_count"), F.sum("total_spent").alias("total_spent"), F.sum("total_orders").alias("_orders")
    ).select(
        "province", "user_count", mean("total_spent", n, 2).alias("avg_spent"), "total_spent",
        mean("_orders", n, 1).alias("avg_orders"),
    ).orderBy(F.desc("avg_spent"), "province")


def monthly_revenue(transactions: DataFrame) -> DataFrame:
    """Completed transactions per month; the discount rate is NULL without a subtotal."""
    done = transactions.filter(F.col("status") == "completed")
    totals = done.groupBy(year_month("timestamp").alias("month")).agg(
        F.sum("total").alias("total_revenue"), F.sum("subtotal").alias("_subtotal"),
        F.sum("discount").alias("_discount"), F.count("*").alias("txn_count"),
    )
    return _with_rates(totals).select(
        "month", "total_revenue", "txn_count", "avg_order_value", "total_discount", "discount_rate"
    ).orderBy("month")


def payment_methods(transactions: DataFrame) -> DataFrame:
    """Completed transactions per payment method, with exact distinct users.

    Combined per (method, user) first: counting distinct users needs no
    exploded copy of the rows, and one method's users are never in one task.
    """
    done = transactions.filter(F.col("status") == "completed")
    per_user = done.groupBy("payment_method", "user_id").agg(
        F.sum("total").alias("total"), F.sum("subtotal").alias("subtotal"), F.sum("discount").alias("discount"),
        F.count("*").alias("n"),
    )
    totals = per_user.groupBy("payment_method").agg(
        F.sum("total").alias("total_revenue"), F.sum("subtotal").alias("_subtotal"),
        F.sum("discount").alias("_discount"), F.sum("n").alias("txn_count"), F.count("user_id").alias("unique_users"),
    )
    return _with_rates(totals).select(
        "payment_method", "total_revenue", "txn_count", "avg_order_value", "total_discount", "discount_rate", "unique_users"
    ).orderBy(F.desc("total_revenue"), "payment_method")


def _with_rates(totals: DataFrame) -> DataFrame:
    return totals.withColumns(
        {
            "avg_order_value": mean("total_revenue", "txn_count", 2),
            "total_discount": F.round("_discount", 2),
            "discount_rate": pct("_discount", "_subtotal", 2),
        }
    )


def top_products(items: DataFrame, product_dim: DataFrame, k: int = 15) -> DataFrame:
    """Best products by revenue over all statuses, with the estimated profit."""
    sold = items.groupBy("product_id").agg(
        F.count("*").alias("times_sold"), F.sum("quantity").alias("units_sold"), sum_money("subtotal").alias("total_revenue")
    )
    known = sold.join(product_dim, "product_id").select(
        "product_id", F.col("name").alias("product_name"), F.col("category").alias("category_name"),
        F.col("subcategory").alias("subcategory_name"), "profit_margin", "times_sold", "units_sold", "total_revenue",
        F.round(F.col("total_revenue") * F.col("profit_margin"), 2).alias("est_profit"),
    )
    return top_k(known, "total_revenue", k, ["product_id"])


def daily_revenue(orders: DataFrame) -> DataFrame:
    """Per day, with the mean of the last seven rows and the running total.

    The windows run over one row per day, never over transactions.
    """
    daily = orders.groupBy(F.col("date").alias("sale_date")).agg(
        F.count("*").alias("num_transactions"), sum_money("total").alias("daily_revenue")
    )
    recent, days = over_rows(F.sum("daily_revenue"), "sale_date", 7), over_rows(F.count("daily_revenue"), "sale_date", 7)
    return daily.select(
        "sale_date", "num_transactions", "daily_revenue", half_up(ratio(recent, days), 2).alias("moving_avg_7d"),
        over_rows(F.sum("daily_revenue"), "sale_date").alias("cumulative_revenue"),
    ).orderBy("sale_date")


def price_variability(sales: DataFrame, product_dim: DataFrame, k: int = 20, min_days: int = 3) -> DataFrame:
    """Relative spread of daily units over relative spread of daily prices.

    Per product and day first, then per product; each figure is rounded before
    the ratio is taken. Only products with a price history take part.
    """
    daily = sales.groupBy("product_id", "date").agg(
        F.sum("quantity").alias("_units"), half_up_money(ratio(sum_money("unit_price"), F.count("unit_price"))).alias("_price")
    )
    n = F.col("active_days")
    stats = daily.groupBy("product_id").agg(
        F.count("*").alias("active_days"), F.sum("_units").alias("total_units"), sum_squares("_units").alias("_units_sq"), F.sum("_price").alias("_prices"),
        F.sum(F.col("_price") * F.col("_price")).alias("_prices_sq"),
    ).filter(n >= min_days).select(
        "product_id", "total_units", "active_days",
        mean("_prices", n, 2).alias("mean_price"),
        half_up(sample_stddev(n, F.col("_prices"), F.col("_prices_sq")), 2).alias("price_stddev"),
        mean("total_units", n, 2).alias("mean_daily_units"),
        half_up(sample_stddev(n, whole("total_units"), F.col("_units_sq")), 2).alias("units_stddev"),
    )
    priced = product_dim.filter("has_price_history").select("product_id", F.col("name").alias("product_name"), "base_price")
    spread = F.try_divide(F.try_divide("units_stddev", "mean_daily_units"), F.try_divide("price_stddev", "mean_price"))
    return top_k(
        stats.join(priced, "product_id").select(
            "product_id", "product_name", "base_price", "mean_price", "price_stddev", "mean_daily_units", "units_stddev",
            "total_units", "active_days",
            F.when((F.col("price_stddev") > 0) & (F.col("mean_daily_units") > 0), half_up(spread, 3)).alias("price_variability_ratio"),
        ),
        "total_units", k, ["product_id"],
    )
