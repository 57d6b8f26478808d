"""Denormalised and pre-aggregated tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from basketry.functions.calendar import session_row_key
from basketry.functions.numeric import half_up, ratio, sum_money, units
from basketry.operators.joins import HotKeys, attach
from basketry.sources.retail import ITEM_SPREAD, Retail
from basketry.sources.store import Layout, Store, hot_join

# Session activity kept as JSON text in the wide table.
ACTIVITY = {
    "viewed_products": "ARRAY<STRING>",
    "page_views": "ARRAY<STRUCT<timestamp: STRING, page_type: STRING, product_id: STRING, category_id: STRING, view_duration: INT>>",
    "cart_contents": "MAP<STRING, STRUCT<quantity: INT, price: DOUBLE>>",
}

LINE_COLUMNS = (
    "date", "user_id", "transaction_id", "product_id", "product_name", "category", "subcategory", "profit_margin",
    "quantity", "unit_price", "subtotal", "total", "discount", "payment_method", "status",
)


def products_enriched(products: DataFrame, subcategories: DataFrame) -> DataFrame:
    """Products with an embedded ``category`` struct; its fields are null when the subcategory is unknown."""
    fields = ["category_id", F.col("category_name").alias("name"), "subcategory_id", "subcategory_name", "profit_margin"]
    embedded = subcategories.select(
        F.col("category_id"), F.col("subcategory_id"), F.struct(*fields).alias("category")
    )
    return products.join(embedded, ["category_id", "subcategory_id"], "left")


def purchase_summary(orders: DataFrame) -> DataFrame:
    """Totals and favourite payment method per user, all statuses.

    Combined per (user, method) first: the second step sees a handful of rows
    per user, and the most frequent method needs no extra pass.
    """
    return summary_of_methods(orders.groupBy("user_id", "payment_method").agg(
        F.count("*").alias("n"), sum_money("total").alias("spent"),
        F.min("timestamp").alias("first"), F.max("timestamp").alias("last"),
    ))


def summary_of_methods(per_method: DataFrame) -> DataFrame:
    """The purchase summary from one row per user and payment method."""
    per_user = per_method.groupBy("user_id").agg(
        F.sum("n").alias("total_orders"), F.sum("spent").alias("total_spent"),
        F.min("first").alias("first_purchase"), F.max("last").alias("last_purchase"),
        F.min_by("payment_method", F.struct(-F.col("n"), "payment_method")).alias("favorite_payment_method"),
    )
    return per_user.select(
        "user_id", "total_orders", "total_spent",
        half_up(ratio("total_spent", "total_orders"), 2).alias("avg_order_value"),
        "first_purchase", "last_purchase", "favorite_payment_method",
    )


def order_totals(orders: DataFrame) -> DataFrame:
    """The numeric part of the purchase summary in one aggregation."""
    per_user = orders.groupBy("user_id").agg(F.count("*").alias("total_orders"), sum_money("total").alias("total_spent"))
    return per_user.withColumn("avg_order_value", half_up(ratio("total_spent", "total_orders"), 2))


def with_totals(users: DataFrame, totals: DataFrame) -> DataFrame:
    """Left join with zero defaults for users without orders."""
    zero = F.lit(0).cast("decimal(18,2)")
    return users.join(totals, "user_id", "left").withColumns(
        {
            "total_orders": F.coalesce("total_orders", F.lit(0).cast("bigint")),
            "total_spent": F.coalesce("total_spent", zero),
            "avg_order_value": F.coalesce("avg_order_value", F.lit(0.0)),
        }
    )


def totals_or_orders(profiles: DataFrame, orders: DataFrame) -> DataFrame:
    """Profiles as they are when any of them shows spending; otherwise totals are taken from the orders."""
    known = profiles.agg(F.coalesce(F.max("total_spent") > 0, F.lit(False)).alias("known")).scalar()
    names = ("total_orders", "total_spent", "avg_order_value")
    computed = order_totals(orders).select("user_id", *[F.col(c).alias(f"_{c}") for c in names])
    return profiles.join(computed, "user_id", "left").withColumns(
        {c: F.when(known, F.col(c)).otherwise(F.coalesce(F.col(f"_{c}"), F.col(c))) for c in names}
    ).drop(*[f"_{c}" for c in names])


def users_enriched(users: DataFrame, summary: DataFrame) -> DataFrame:
    return with_totals(users, summary)


def users_flat(users: DataFrame, totals: DataFrame) -> DataFrame:
    """User list with place (Unknown when missing) and totals."""
    return with_totals(users, totals).select(
        "user_id", "name", F.coalesce("province", F.lit("Unknown")).alias("province"),
        F.coalesce("city", F.lit("Unknown")).alias("city"),
        *[c for c in ("registration_date",) if c in users.columns],
        "total_orders", "total_spent", "avg_order_value",
    )


def product_daily_metrics(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Per product and day, all statuses; ``num_transactions`` counts lines."""
    daily = sales.groupBy("product_id", "date").agg(
        F.sum("quantity").alias("total_quantity"), sum_money("subtotal").alias("total_revenue"),
        F.count("*").alias("num_transactions"), sum_money("unit_price").alias("_prices"),
    )
    return metrics_of_days(daily, products)


def metrics_of_days(daily: DataFrame, products: DataFrame) -> DataFrame:
    """Daily sums with the mean price and the shelf data of the product."""
    shelf = products.select("product_id", "current_stock", "base_price", "is_active")
    return daily.join(shelf, "product_id", "left").select(
        "product_id", "date", "total_quantity", "total_revenue", "num_transactions",
        half_up(ratio("_prices", "num_transactions"), 2).alias("avg_unit_price"),
        F.coalesce("current_stock", F.lit(0)).alias("current_stock"),
        F.coalesce("base_price", F.lit(0).cast("decimal(18,2)")).alias("base_price"),
        F.coalesce("is_active", F.lit(False)).alias("is_active"),
    )


def sessions_flat(sessions: DataFrame) -> DataFrame:
    """One wide row per session with its descending-time row key; activity as JSON text."""
    return sessions.select(
        session_row_key("user_id", "start_time").alias("row_key"), "session_id", "user_id", "start_time", "end_time",
        "duration_seconds", "conversion_status", "referrer", "device_type", "device_os",
        F.col("browser").alias("device_browser"), F.col("city").alias("geo_city"),
        F.col("province").alias("geo_state"), F.col("country").alias("geo_country"),
        F.to_json(F.struct("page_views", "viewed_products", "cart_items")).alias("activity"),
    )


def keyed_sessions(sessions: DataFrame) -> DataFrame:
    """Sessions under their descending-time row key with all attributes that key reads return."""
    return sessions.withColumn("row_key", session_row_key("user_id", "start_time"))


def document_sessions_flat(sessions: DataFrame) -> DataFrame:
    """The same for nested session documents: lists and the cart become JSON text."""
    device, geo = "device_profile", "geo_data"
    return sessions.select(
        session_row_key("user_id", "start_time").alias("row_key"), "session_id", "user_id", "start_time", "end_time",
        "duration_seconds", "conversion_status", "referrer",
        F.col(f"{device}.type").alias("device_type"), F.col(f"{device}.os").alias("device_os"),
        F.col(f"{device}.browser").alias("device_browser"), F.col(f"{geo}.city").alias("geo_city"),
        F.col(f"{geo}.state").alias("geo_state"), F.col(f"{geo}.country").alias("geo_country"),
        F.col(f"{geo}.ip_address").alias("geo_ip"),
        *[F.to_json(c).alias(c) for c in ACTIVITY],
    )


def parse_activity(flat: DataFrame) -> DataFrame:
    """The JSON texts of a flat session row as lists and a map again; unreadable text becomes NULL."""
    return flat.withColumns({c: F.from_json(c, ddl) for c, ddl in ACTIVITY.items()})


def fill_activity(primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """Empty or missing activity texts of ``primary`` taken from ``fallback`` by session."""
    names = tuple(ACTIVITY)
    other = fallback.select("session_id", *[F.col(c).alias(f"_{c}") for c in names])

    def present(c: str):
        return F.when(~F.col(c).isin("[]", "{}", ""), F.col(c))

    return primary.join(other, "session_id", "left").withColumns(
        {c: F.coalesce(present(c), F.col(f"_{c}"), F.col(c)) for c in names}
    ).drop(*[f"_{c}" for c in names])


def txn_lines(r: Retail) -> DataFrame:
    """One row per item with order and product attributes; the base of the dashboard data sets.

    Orders and products are attached row by row, so very frequent orders and
    products are salted.
    """
    header = r.transactions().select("transaction_id", "user_id", "date", "total", "discount", "payment_method", "status")
    items = r.items.select("transaction_id", "product_id", "quantity", units("unit_price").alias("unit_price"),
                           units("subtotal").alias("subtotal"))
    lines = attach(items, header, "transaction_id", hot=r.hot_keys("items", "transaction_id"), by=ITEM_SPREAD["transaction_id"])
    return with_product(lines, r.product_dim(), r.hot_keys("items", "product_id")).select(*LINE_COLUMNS)


def with_product(lines: DataFrame, product_dim: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Product name, category, subcategory and margin; unknown products keep their id as name."""
    dim = product_dim.select("product_id", F.col("name").alias("product_name"), "category", "subcategory", "profit_margin")
    unknown = F.lit("Unknown")
    return attach(lines, dim, "product_id", "left", hot, by=ITEM_SPREAD["product_id"]).withColumns(
        {
            "product_name": F.coalesce("product_name", F.col("product_id").cast("string")),
            "category": F.coalesce("category", unknown),
            "subcategory": F.coalesce("subcategory", unknown),
            "profit_margin": F.coalesce("profit_margin", F.lit(0).cast("decimal(4,2)")),
        }
    )


def sessions_summary(sessions: DataFrame) -> DataFrame:
    return sessions.select(
        "session_id", "user_id", "start_time", "duration_seconds", "conversion_status", "referrer",
        "device_type", "device_os", "browser", "city", "province", "viewed_products", "cart_items",
        F.to_date("start_time").alias("date"), F.hour("start_time").alias("hour"),
    )


def cart_lines(carts: DataFrame, sessions: DataFrame, product_dim: DataFrame, hot_products: HotKeys | None = None,
               hot_sessions: HotKeys | None = None) -> DataFrame:
    """One row per product in a cart, with the session's outcome."""
    outcome = sessions.select("session_id", "conversion_status")
    joined = attach(carts, outcome, "session_id", hot=hot_sessions, by=("product_id",))
    named = attach(joined, product_dim.select("product_id", F.col("name").alias("product_name"), "category"),
                   "product_id", "left", hot_products, by=("session_id",))
    return named.select(
        "session_id", "product_id", F.coalesce("product_name", F.col("product_id").cast("string")).alias("product_name"),
        F.coalesce("category", F.lit("Unknown")).alias("category"), "quantity", units("price").alias("price"),
        units(F.col("quantity") * F.col("price")).alias("line_total"), "conversion_status",
    )


def warehouse(r: Retail) -> dict[str, tuple[DataFrame, list[str]]]:
    """The tables worth keeping, each with the key it is ordered by: what key reads and reports start from."""
    return {
        "products": (products_enriched(r.products, r.subcategories), ["product_id"]),
        "users": (users_enriched(r.users, purchase_summary(r.orders)), ["user_id"]),
        "transactions": (r.transactions(), ["date", "transaction_id"]),
        "sessions": (keyed_sessions(r.sessions), ["row_key", "session_id"]),
        "product_metrics": (product_daily_metrics(r.sales("date"), r.products), ["product_id", "date"]),
    }


def store_tables(r: Retail) -> dict[str, DataFrame]:
    """The tables of the bucketed store: those of the warehouse, and the lines of transactions."""
    lines = r.items.select("transaction_id", "product_id", "quantity", units("unit_price").alias("unit_price"), units("subtotal").alias("subtotal"))
    return {name: df for name, (df, _) in warehouse(r).items()} | {"lines": lines}


def store_layouts(r: Retail) -> dict[str, Layout]:
    """Transactions and their lines share their buckets, and so do users and their sessions."""
    return {
        "products": Layout("product_id"), "users": Layout("user_id"), "product_metrics": Layout("product_id", ("date",)),
        "sessions": Layout("user_id", ("row_key",)), "transactions": Layout("transaction_id"),
        "lines": Layout("transaction_id", hot=r.hot_keys("items", "transaction_id")),
    }


# Lines a bucket of the store holds on average at most; the task that joins it sorts them.
BUCKET_LINES = 1 << 18


def store_buckets(r: Retail, least: int, most: int = BUCKET_LINES) -> int:
    """The number of buckets for the measured number of lines, the largest table of the store."""
    return max(least, -(-r.hot_keys("items", "transaction_id").total // most))


def stored_txn_lines(store: Store, product_dim: DataFrame, hot_products: HotKeys | None = None) -> DataFrame:
    """``txn_lines`` from the store: lines are scanned once and meet their transaction, whose amounts are kept, without a shuffle."""
    header = store.read("transactions").select("transaction_id", "user_id", "date", "total", "discount", "payment_method", "status")
    lines = hot_join(store.read("lines"), header, "transaction_id", store.layouts["lines"].hot)
    return with_product(lines, product_dim, hot_products).select(*LINE_COLUMNS)


def price_history(price_points: DataFrame, product_dim: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    names = product_dim.select("product_id", F.col("name").alias("product_name"))
    return attach(price_points, names, "product_id", "left", hot).select(
        "product_id", F.coalesce("product_name", F.col("product_id").cast("string")).alias("product_name"), units("price").alias("price"), "date"
    )
