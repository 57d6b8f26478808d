"""Figures and data sets behind the customer, product, cart and overview reports.

Line-level inputs are reduced per product, day or transaction first; shares,
ranks and windows are taken on the reduced frames only. Rows without a grouping
value are left out, as the charts do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from basketry.functions.calendar import week_start, year_month
from basketry.functions.numeric import dbl, half_up, mean, pct, ratio, sum_money, units
from basketry.functions.segments import SEGMENT_BOUNDS, SEGMENT_LABELS, segment, segment_rank
from basketry.functions.text import product_label, share_label, thousands
from basketry.operators.joins import HotKeys, attach
from basketry.operators.quantiles import summary_by
from basketry.operators.ranking import over_rows, top_k

# Order statuses shown in the share report (fixed values).
STATUSES = ("completed", "shipped", "processing", "refunded")


# --- sales per category, product and period ---------------------------------


def product_revenue(items: DataFrame) -> DataFrame:
    return items.groupBy("product_id").agg(
        sum_money("subtotal").alias("revenue"), F.sum("quantity").alias("quantity"), F.count("*").alias("orders")
    )


def _by_product_and(sales: DataFrame, period: Column, product_dim: DataFrame) -> DataFrame:
    """Revenue per product and period, with the product's category."""
    reduced = sales.groupBy("product_id", period).agg(sum_money("subtotal").alias("revenue"))
    return _categorised(reduced, product_dim)


def _categorised(reduced: DataFrame, product_dim: DataFrame) -> DataFrame:
    named = reduced.join(product_dim.select("product_id", F.col("name").alias("product_name"), "category"), "product_id", "left")
    return named.withColumns(
        {
            "product_name": F.coalesce("product_name", F.col("product_id").cast("string")),
            "category": F.coalesce("category", F.lit("Unknown")),
        }
    )


def weekly_category_revenue(sales: DataFrame, product_dim: DataFrame, top: int = 5) -> DataFrame:
    """Weeks (from Monday) of the ``top`` categories by total revenue."""
    weekly = _by_product_and(sales, week_start("date").alias("week"), product_dim).groupBy("category", "week").agg(
        F.sum("revenue").alias("revenue")
    )
    leaders = top_k(weekly.groupBy("category").agg(F.sum("revenue").alias("_total")), "_total", top, ["category"])
    return weekly.join(leaders, "category", "left_semi").select("week", "category", "revenue").orderBy("week", "category")


def weekly_revenue(order_revenue: DataFrame) -> DataFrame:
    return order_revenue.groupBy(week_start("date").alias("week")).agg(F.sum("subtotal").alias("revenue")).orderBy("week")


def category_revenue(items: DataFrame, product_dim: DataFrame) -> DataFrame:
    return _categorised(product_revenue(items), product_dim).groupBy("category").agg(F.sum("revenue").alias("revenue")).orderBy(
        F.desc("revenue"), "category"
    )


def category_concentration(items: DataFrame, product_dim: DataFrame, top: int = 5) -> DataFrame:
    """Leading category, its share, the share of the ``top`` categories and the total."""
    totals = category_revenue(items, product_dim)
    ranked = totals.withColumn("_rank", F.row_number().over(Window.orderBy(F.desc("revenue"), "category")))
    total, lead = F.sum("revenue"), F.max(F.when(F.col("_rank") == 1, F.col("revenue")))
    return ranked.agg(
        F.max(F.when(F.col("_rank") == 1, F.col("category"))).alias("top_category"), lead.alias("top_revenue"),
        pct(lead, total).alias("top_share_pct"),
        pct(F.sum(F.when(F.col("_rank") <= top, F.col("revenue"))), total).alias("top5_share_pct"),
        total.alias("total_revenue"),
    )


def daily_revenue_lines(order_revenue: DataFrame) -> DataFrame:
    """Line revenue per day with the mean of the last seven rows."""
    daily = order_revenue.groupBy("date").agg(F.sum("subtotal").alias("revenue"))
    return daily.select(
        "date", "revenue",
        half_up(ratio(over_rows(F.sum("revenue"), "date", 7), over_rows(F.count("revenue"), "date", 7)), 4).alias("avg_7d"),
    ).orderBy("date")


def payment_revenue(order_revenue: DataFrame) -> DataFrame:
    return order_revenue.groupBy("payment_method").agg(F.sum("subtotal").alias("revenue")).orderBy("payment_method")


def status_payment_revenue(order_revenue: DataFrame) -> DataFrame:
    """Revenue by (status, method) with totals per status and overall (NULL = all).

    The totals are rolled up from the few (status, method) cells, not from the orders.
    """
    cells = order_revenue.groupBy("status", "payment_method").agg(F.sum("subtotal").alias("revenue"))
    return cells.rollup("status", "payment_method").agg(F.sum("revenue").alias("revenue"))


def monthly_changes(order_revenue: DataFrame) -> DataFrame:
    """Revenue per month, its change to the month before (the first is absolute), and a
    closing row: where the changes add up to."""
    monthly = order_revenue.groupBy(year_month("date").alias("month")).agg(F.sum("subtotal").alias("revenue"))
    months = Window.orderBy("month")
    revenue, before = F.col("revenue"), F.lag("revenue").over(months)
    step = F.struct(
        F.col("month"), revenue.alias("revenue"), (revenue - F.coalesce(before, F.lit(0))).alias("delta"),
        F.when(before.isNull(), "absolute").otherwise("relative").alias("measure"),
    )
    closing = F.struct(F.lit("Total").alias("month"), revenue.alias("revenue"), (revenue - revenue).alias("delta"), F.lit("total").alias("measure"))
    is_last = F.lead("month").over(months).isNull()
    return monthly.select(step.alias("step"), F.when(is_last, closing).alias("closing")).select(
        F.explode(F.filter(F.array("step", "closing"), lambda r: r.isNotNull())).alias("r")
    ).select("r.*")


def monthly_volume(order_revenue: DataFrame) -> DataFrame:
    """Revenue and order lines per month."""
    return order_revenue.groupBy(year_month("date").alias("month")).agg(
        F.sum("subtotal").alias("revenue"), F.sum("lines").alias("order_lines")
    ).orderBy("month")


def overview_kpis(order_revenue: DataFrame, items: DataFrame, users: DataFrame, sessions: DataFrame, target_factor: float = 1.2) -> DataFrame:
    """One row of headline figures; the last 30 days are measured from the last day of sale."""
    daily = order_revenue.groupBy("date").agg(F.sum("subtotal").alias("revenue"))
    last = daily.withColumn("_last", F.max("date").over(Window.partitionBy(F.lit(1))))
    recent = F.col("date") >= F.date_sub("_last", 30)
    prior = (F.col("date") >= F.date_sub("_last", 60)) & ~recent
    zero = F.lit(0).cast("decimal(18,2)")
    revenue = last.agg(
        F.sum("revenue").alias("total_revenue"),
        F.coalesce(F.sum(F.when(recent, F.col("revenue"))), zero).alias("last_30d"),
        F.coalesce(F.sum(F.when(prior, F.col("revenue"))), zero).alias("prior_30d"),
    )
    products = items.select("product_id").distinct().agg(F.count("product_id").alias("n"))
    people = users.select("user_id").distinct().agg(F.count("user_id").alias("n"))
    visits = sessions.agg(F.struct(
        F.count("*").alias("n"),
        half_up(ratio(F.count_if(F.col("conversion_status") == "converted"), F.count("*")) * 100.0, 4).alias("rate"),
    ).alias("v"))
    return revenue.withColumn("_visits", visits.scalar()).select(
        "total_revenue", "last_30d", "prior_30d", (F.col("last_30d") - F.col("prior_30d")).alias("revenue_delta"),
        people.scalar().alias("unique_customers"), products.scalar().alias("products_sold"),
        F.col("_visits.n").alias("sessions"), F.col("_visits.rate").alias("conversion_rate"),
        half_up(dbl("total_revenue") * target_factor, 2).alias("revenue_target"),
    )


# --- products ----------------------------------------------------------------


def product_stats(items: DataFrame, product_dim: DataFrame) -> DataFrame:
    return _categorised(product_revenue(items), product_dim).select(
        "product_id", "product_name", "category", "revenue", "quantity", "orders"
    )


def product_performance(items: DataFrame, product_dim: DataFrame) -> DataFrame:
    """Every sold product with its chart label."""
    return product_stats(items, product_dim).select(
        "product_id", product_label(F.col("product_name"), F.col("category")).alias("label"), "category", "revenue", "quantity"
    )


def best_products(stats: DataFrame, by: str, k: int = 15) -> DataFrame:
    """Top products by ``revenue`` or ``quantity``."""
    return top_k(stats, by, k, ["product_id"])


def product_insight(items: DataFrame, product_dim: DataFrame, k: int = 15) -> DataFrame:
    """Best product by revenue and by units, revenue share of the top ``k``, and how many products were sold."""
    stats = product_revenue(items)
    # Reads the same columns as the totals below, so both share one shuffle of the items.
    best = top_k(stats, "revenue", k, ["product_id"]).agg(F.struct(F.sum("revenue").alias("r"), F.sum("quantity").alias("q")).alias("b"))
    first = {m: F.min_by(F.struct("product_id", m), F.struct(-F.col(m), "product_id")) for m in ("revenue", "quantity")}
    row = stats.agg(
        first["revenue"].alias("_earner"), first["quantity"].alias("_mover"),
        F.sum("revenue").alias("_all"), F.count("*").alias("products_sold"),
    ).select(
        F.col("_earner.product_id").alias("_p1"), F.col("_earner.revenue").alias("top_revenue"),
        F.col("_mover.product_id").alias("_p2"), F.col("_mover.quantity").alias("top_quantity"),
        pct(best.scalar()["r"], "_all").alias("top_share_pct"), "products_sold",
    )
    for key, name in (("_p1", "top_revenue_product"), ("_p2", "top_quantity_product")):
        row = row.join(product_dim.select(F.col("product_id").alias(key), F.col("name").alias(name)), key, "left")
    return row.drop("_p1", "_p2")


def subcategory_revenue(items: DataFrame, product_dim: DataFrame) -> DataFrame:
    """Revenue and margin per subcategory."""
    dim = product_dim.select("product_id", "category", "subcategory", "profit_margin")
    unknown = F.lit("Unknown")
    return product_revenue(items).join(dim, "product_id", "left").groupBy(
        F.coalesce("category", unknown).alias("category"), F.coalesce("subcategory", unknown).alias("subcategory")
    ).agg(F.max(F.coalesce("profit_margin", F.lit(0).cast("decimal(4,2)"))).alias("profit_margin"), F.sum("revenue").alias("revenue"))


def subcategory_totals(subcategories: DataFrame) -> DataFrame:
    """Subcategory revenue with totals per category and overall (NULL = all)."""
    return subcategories.rollup("category", "subcategory").agg(F.sum("revenue").alias("revenue"))


def top_subcategories(subcategories: DataFrame, k: int = 20) -> DataFrame:
    """Best ``k`` with the margin scaled to the revenue axis."""
    best = top_k(subcategories, "revenue", k, ["category", "subcategory"])
    whole = Window.partitionBy(F.lit(1))
    scaled = F.try_divide(dbl("profit_margin") * dbl(F.max("revenue").over(whole)), dbl(F.max("profit_margin").over(whole)))
    return best.select("category", "subcategory", "profit_margin", "revenue", half_up(scaled, 2).alias("scaled_margin"))


def leading_products(items: DataFrame, k: int = 10) -> DataFrame:
    """Ids of the ``k`` products with the most revenue."""
    return top_k(product_revenue(items), "revenue", k, ["product_id"]).select("product_id")


def price_timeline(price_points: DataFrame, leaders: DataFrame, product_dim: DataFrame) -> DataFrame:
    """Price history of the leading products."""
    names = product_dim.select("product_id", F.col("name").alias("product_name"))
    chosen = leaders.join(names, "product_id", "left")
    return price_points.join(chosen, "product_id").select("product_id", "product_name", units("price").alias("price"), "date").orderBy("product_id", "date")


def category_stats(items: DataFrame, product_dim: DataFrame) -> DataFrame:
    """Revenue, units, lines, distinct products and mean unit price per category."""
    reduced = items.groupBy("product_id").agg(
        sum_money("subtotal").alias("revenue"), F.sum("quantity").alias("quantity"), F.count("*").alias("orders"),
        sum_money("unit_price").alias("_prices"),
    )
    return _categorised(reduced, product_dim).groupBy("category").agg(
        F.sum("revenue").alias("revenue"), F.sum("quantity").alias("quantity"), F.sum("orders").alias("orders"),
        F.count("*").alias("products"), half_up(ratio(F.sum("_prices"), F.sum("orders")), 4).alias("avg_price"),
    ).orderBy(F.desc("revenue"), "category")


# --- customers ---------------------------------------------------------------


def customer_tiers(users: DataFrame, bounds: Sequence[float] = SEGMENT_BOUNDS) -> DataFrame:
    return users.withColumn("tier", segment(F.col("total_spent"), F.col("total_orders"), bounds))


def tier_summary(tiered: DataFrame, tiers: Sequence[str] | None = None) -> DataFrame:
    """Count, spend and share per tier in tier order, optionally for chosen tiers only."""
    chosen = tiered if tiers is None else tiered.filter(F.col("tier").isin(*tiers))
    n = F.count("*")
    grouped = chosen.groupBy("tier").agg(
        n.alias("count"), half_up(ratio(F.sum("total_spent"), n), 4).alias("avg_spent"), F.sum("total_spent").alias("total_revenue")
    )
    share = pct("count", F.sum("count").over(Window.partitionBy(F.lit(1))))
    with_share = grouped.withColumn("pct", share)
    return with_share.withColumn("label", share_label(F.col("count"), F.col("pct"))).orderBy(segment_rank(F.col("tier")))


def tiers_by_province(tiered: DataFrame) -> DataFrame:
    return tiered.groupBy("province", "tier").agg(F.count("*").alias("count"))


def tiers_by_province_wide(tiered: DataFrame) -> DataFrame:
    """One column per tier in tier order, 0 where a province has none."""
    wide = tiered.groupBy("province").pivot("tier", list(SEGMENT_LABELS)).agg(F.count(F.lit(1)))
    return wide.na.fill(0).orderBy("province")


def segment_insight(tiered: DataFrame) -> DataFrame:
    n, vip, idle = F.count("*"), F.count_if(F.col("tier") == "VIP"), F.count_if(F.col("tier") == "Inactive")
    vip_revenue = F.coalesce(F.sum(F.when(F.col("tier") == "VIP", F.col("total_spent"))), F.lit(0).cast("decimal(18,2)"))
    return tiered.agg(
        vip.alias("vip_count"), pct(vip, n).alias("vip_user_pct"), vip_revenue.alias("vip_revenue"),
        pct(vip_revenue, F.sum("total_spent")).alias("vip_revenue_pct"),
        idle.alias("inactive_count"), pct(idle, n).alias("inactive_pct"),
    )


def active_users(tiered: DataFrame) -> DataFrame:
    return tiered.filter("total_orders > 0").select("user_id", "name", "province", "tier", "total_orders", "total_spent")


def spend_distribution(tiered: DataFrame) -> DataFrame:
    """Extremes and exact quartiles of spend per tier, active users only."""
    return summary_by(tiered.filter("total_orders > 0"), "total_spent", "tier")


def registrations(users: DataFrame) -> DataFrame:
    return users.na.drop(subset=["registration_date"]).groupBy(year_month("registration_date").alias("reg_month"), "province").agg(
        F.count("*").alias("count")
    ).orderBy("reg_month", "province")


def top_provinces(users: DataFrame, k: int = 10) -> DataFrame:
    return top_k(users.groupBy("province").agg(F.sum("total_spent").alias("revenue")), "revenue", k, ["province"])


def top_customers(tiered: DataFrame, k: int = 15) -> DataFrame:
    """Biggest spenders; ``spent_label`` is the amount with thousands separators."""
    return top_k(tiered, "total_spent", k, ["user_id"]).select(
        "user_id", "name", "province", "total_orders", "total_spent", "avg_order_value", "tier",
        thousands("total_spent").alias("spent_label"),
    )


# --- carts and orders --------------------------------------------------------


def cart_totals(carts: DataFrame) -> DataFrame:
    """Value and units per session with a cart."""
    return carts.groupBy("session_id").agg(
        sum_money(F.col("quantity") * F.col("price")).alias("cart_total"), F.sum("quantity").alias("cart_quantity")
    )


def orders_with_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders that have at least one item. Items are reduced to distinct orders before the join."""
    return orders.join(items.select("transaction_id").distinct(), "transaction_id")


def cart_kpis(carts: DataFrame, sessions: DataFrame, ordered: DataFrame) -> DataFrame:
    """Mean cart value and units, abandonment (every cart not converted) and refund rate."""
    n = F.count("*")
    bought = F.count_if(F.col("conversion_status") == "converted")
    abandoned = sessions.filter("cart_items > 0").agg(half_up((F.lit(1.0) - ratio(bought, n)) * 100.0, 1).alias("r"))
    refunded = ordered.agg(pct(F.count_if(F.col("status") == "refunded"), n).alias("r"))
    zero = F.lit(0.0)
    return cart_totals(carts).agg(
        F.coalesce(mean(F.sum("cart_total"), n, 2), zero).alias("avg_cart_value"),
        F.coalesce(mean(F.sum("cart_quantity"), n, 1), zero).alias("avg_cart_items"),
    ).select(
        "avg_cart_value", "avg_cart_items", F.coalesce(abandoned.scalar(), zero).alias("abandonment_rate_pct"),
        F.coalesce(refunded.scalar(), zero).alias("refund_rate_pct"),
    )


def status_share(ordered: DataFrame) -> DataFrame:
    """Orders per status and their share; the four known statuses always appear."""
    n = F.count("*")
    counts = ordered.agg(n.alias("_all"), *[F.count_if(F.col("status") == s).alias(s) for s in STATUSES])
    long = counts.unpivot(["_all"], list(STATUSES), "status", "count")
    return long.select("status", "count", F.coalesce(pct("count", "_all"), F.lit(0.0)).alias("pct"))


def cart_value_histogram(carts: DataFrame, bins: int = 40) -> DataFrame:
    """Equal-width bins over the cart totals; empty bins are left out."""
    totals = cart_totals(carts).select(dbl("cart_total").alias("v"))
    bounds = totals.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi")).alias("b"))
    lo, hi = F.col("b.lo"), F.col("b.hi")
    width = (hi - lo) / float(bins)
    bin_no = F.when(hi > lo, F.least(F.floor((F.col("v") - lo) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    placed = totals.withColumn("b", bounds.scalar()).groupBy(bin_no.cast("int").alias("bin"), "b").agg(F.count("*").alias("sessions"))
    return placed.select(
        "bin", half_up(lo + F.col("bin") * width, 4).alias("bin_from"),
        half_up(lo + (F.col("bin") + 1) * width, 4).alias("bin_to"), "sessions",
    ).orderBy("bin")


def cart_value_quartiles(carts: DataFrame) -> DataFrame:
    return summary_by(cart_totals(carts), "cart_total").withColumn("scope", F.lit("all"))


def discount_bridge(order_revenue: DataFrame) -> DataFrame:
    """Gross, discount, net and discount share over orders with items."""
    gross, discount = F.sum("subtotal"), F.sum("discount")
    return order_revenue.agg(
        gross.alias("gross"), F.round(discount, 2).alias("discount"), F.sum("total").alias("net"),
        pct(discount, gross).alias("discount_pct"),
    )


def refund_rate_by_category(items: DataFrame, orders: DataFrame, product_dim: DataFrame, hot_products: HotKeys | None = None) -> DataFrame:
    """Share of refunded orders among the orders of a category; categories without refunds are absent.

    Lines become distinct (order, category) pairs before orders are joined, so
    an order with very many lines is at most one row per category.
    """
    lines = items.select("transaction_id", "product_id")
    labelled = attach(lines, product_dim.select("product_id", "category"), "product_id", "left", hot_products)
    pairs = labelled.select("transaction_id", F.coalesce("category", F.lit("Unknown")).alias("category")).distinct()
    refunded = F.count_if(F.col("status") == "refunded")
    return pairs.join(orders.select("transaction_id", "status"), "transaction_id").groupBy("category").agg(
        refunded.alias("count"), F.count("*").alias("total"),
        half_up(ratio(refunded, F.count("*")) * 100.0, 4).alias("refund_rate"),
    ).filter(F.col("count") > 0).orderBy("category")


def abandonment_by_referrer_device(sessions: DataFrame) -> DataFrame:
    """Carts that did not convert, by referrer and device."""
    return sessions.filter("cart_items > 0").groupBy("referrer", "device_type").agg(
        F.count_if(F.col("conversion_status") != "converted").alias("abandoned")
    )
