"""Every analysis wired to the star-schema tables under a stable name.

Thresholds follow the amounts of those tables (order totals reach 500,000), so
all tiers occur; the defaults of the functions are the retail ones.
"""

from __future__ import annotations

import posixpath
from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from basketry.functions.calendar import iso_text, plain_text
from basketry.functions.numeric import sum_money
from basketry.operators import baskets, name_index, profiling
from basketry.operators.joins import attach
from basketry.plans import clv, cohort, commerce, etl, filters, funnel, insights, lookup, recommend, rollups, sessions
from basketry.session import scratch_path
from basketry.sources import documents, results
from basketry.sources.retail import ITEM_SPREAD
from basketry.sources.star import StarRetail, SYSTEMS
from basketry.sources.store import Store

CLV_BOUNDS = (1200000, 900000, 600000)
SPEND_BOUNDS = (0, 1, 1000000, 2000000, 3000000, 4000000)
SEGMENT_BOUNDS = (2500000, 1500000)
# Arguments of the key reads (one user, one product, first rows in key order): reading by key is what they do.
ONE_USER, ONE_PRODUCT, SCAN_ROWS = 7, 42, 25
SEARCH = "RING"
NEEDLES = ("", "g", "RI", "ing", "d Bolt", "small widget", "ringring")
DATES = (date(1996, 1, 1), date(1997, 12, 31))
SESSION_DATES = (date(2024, 1, 5), date(2024, 1, 20))
CATEGORIES = ("ECONOMY", "LARGE")
PROVINCES = ("ASIA", "EUROPE")
PAGE_TYPES = ("view", "click", "purchase")

Query = Callable[[StarRetail], DataFrame]
_stores: dict[tuple[str, str], StarRetail] = {}


def store(spark: SparkSession, path: str) -> StarRetail:
    """The tables of a folder; table handles and hot-key statistics are kept per session, data is not."""
    key = (spark.sparkContext.applicationId, path)
    if key not in _stores:
        _stores[key] = StarRetail(spark, path)
    return _stores[key]


def portable(df: DataFrame) -> DataFrame:
    """Plain column types for comparison across engines: amounts as doubles, dates and times as ISO text."""
    def plain(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            return c.cast("double").alias(f.name)
        if isinstance(f.dataType, T.DateType):
            return c.cast("string").alias(f.name)
        if isinstance(f.dataType, T.TimestampNTZType):
            return plain_text(c).alias(f.name)
        return c

    return df.select(*[plain(f) for f in df.schema.fields])


# --- inputs shared by several queries ----------------------------------------


def user_totals(r: StarRetail) -> DataFrame:
    return etl.with_totals(r.customers, etl.order_totals(r.orders))


def tiered(r: StarRetail) -> DataFrame:
    return insights.customer_tiers(user_totals(r), SEGMENT_BOUNDS)


def clv_table(r: StarRetail) -> DataFrame:
    return clv.clv(r.customers, clv.txn_metrics(r.orders), clv.session_metrics(r.sessions), bounds=CLV_BOUNDS)


def flags(r: StarRetail) -> DataFrame:
    return funnel.funnel_flags(r.sessions)


def pairs(r: StarRetail) -> DataFrame:
    return baskets.pair_counts(r.items, r.hot_keys("items", "transaction_id"))


def recommendations(r: StarRetail) -> DataFrame:
    return recommend.also_bought(r.items, r.product_dim(), hot=r.hot_keys("items", "transaction_id"))


def name_postings(r: StarRetail) -> DataFrame:
    """The index of product names, written in the order of its grams and read back."""
    path = _scratch(r, "name-index")
    results.write_key_ordered(name_index.postings(r.products, "product_id", "name"), path, ["gram", "product_id"])
    return r.spark.read.parquet(path)


def indexed_search(r: StarRetail) -> DataFrame:
    best = baskets.best_partners(r.items, 3, r.hot_keys("items", "transaction_id"))
    return recommend.search_by_index(best, r.product_dim(), name_postings(r), SEARCH)


def metrics(r: StarRetail) -> DataFrame:
    return etl.product_daily_metrics(r.sales("date"), r.products)


def metrics_of(r: StarRetail, product_id: int) -> DataFrame:
    """Metrics of one product: the key filter is applied to the lines, nothing is measured."""
    return etl.product_daily_metrics(r.sales_of(product_id, "date"), r.products)


def completed(r: StarRetail) -> DataFrame:
    return r.sales("date", only="completed")


def subcategories(r: StarRetail) -> DataFrame:
    return insights.subcategory_revenue(r.items, r.product_dim())


def categories_flat(r: StarRetail) -> DataFrame:
    """Category totals; the subcategory array as text, best first."""
    rows = commerce.revenue_by_category(completed(r), r.product_dim())
    text = F.array_join(F.transform("subcategories", lambda s: F.concat_ws(
        "=", s["name"], s["revenue"].cast("decimal(18,2)").cast("string"), s["qty_sold"].cast("string"))), ";")
    return rows.withColumn("subcategories", text)


def matrix_text(cells: DataFrame, key: str, period: str, value: str) -> DataFrame:
    """A cohort matrix with each row's cells as text, in the order of the periods."""
    rows = cohort.matrix(cells.withColumn(value, F.col(value).cast("decimal(18,2)")), key, period, value)
    text = F.array_join(F.transform(F.map_entries(value), lambda e: F.concat_ws("=", e["key"].cast("string"), e["value"].cast("string"))), ";")
    return rows.select(key, F.size(value).alias("cells"), text.alias(value))


def device_os_text(r: StarRetail) -> DataFrame:
    """The map of each device type as text, in the order of the systems."""
    text = F.array_join(F.transform(F.map_entries("rate"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("decimal(18,2)").cast("string"))), ";")
    return sessions.device_os_map(r.sessions).select("device_type", F.size("rate").alias("systems"), text.alias("rates"))


def enriched_flat(r: StarRetail) -> DataFrame:
    return _flat_products(etl.products_enriched(r.products, r.subcategories))


def _flat_products(rows: DataFrame) -> DataFrame:
    return rows.select("product_id", "name", "base_price", "current_stock", "is_active", "category.category_id",
                       F.col("category.name").alias("category_name"), "category.subcategory_id", "category.subcategory_name", "category.profit_margin")


def price_timeline(r: StarRetail) -> DataFrame:
    leaders = insights.leading_products(r.items)
    return insights.price_timeline(r.price_points_of(leaders), leaders, r.product_dim())


def filtered_lines(r: StarRetail) -> DataFrame:
    """Revenue per day and category-filtered product of the lines that pass the report filters."""
    orders = filters.by_date(r.orders, *DATES, column="timestamp").select("transaction_id", "date")
    lines = attach(r.items, orders, "transaction_id", hot=r.hot_keys("items", "transaction_id"), by=ITEM_SPREAD["transaction_id"])
    kept = filters.by_category(lines, r.product_dim(), CATEGORIES, r.hot_keys("items", "product_id"))
    return kept.groupBy("date", "product_id").agg(sum_money("subtotal").alias("revenue"), F.count("*").alias("lines"))


def filtered_sessions(r: StarRetail) -> DataFrame:
    return filters.by_province(r.sessions_between(*SESSION_DATES), PROVINCES)


def filtered_page_views(r: StarRetail) -> DataFrame:
    views = filters.by_date(r.page_views, *SESSION_DATES, column="timestamp")
    kept = filters.of_sessions(views, filtered_sessions(r), r.hot_keys("page_views", "session_id"))
    return kept.groupBy("page_type").agg(F.count("*").alias("views"))


def materialised(r: StarRetail) -> DataFrame:
    """Write a result to the shared folder and read it back."""
    path = _scratch(r, "results")
    results.materialise({"daily_revenue": commerce.daily_revenue(r.orders)}, path)
    return results.load_results(r.spark, path, ["daily_revenue"])["daily_revenue"]


def rolled_up(r: StarRetail, name: str, build: Callable[[DataFrame], DataFrame], rows: DataFrame | None = None, key: str = "transaction_id") -> DataFrame:
    """A state built from two batches of rows (the orders), the second of which brings late ones for the days of the first."""
    path, rows = _scratch(r, name), r.orders if rows is None else rows
    late = F.pmod(F.xxhash64(key), F.lit(3)) == 0
    for batch, part in (("first", ~late), ("late", late)):
        rollups.add(build(rows.filter(part)), path, batch)
    return rollups.read(r.spark, path, build(rows).schema)


VIEW_DAYS = (date(2024, 1, 5), date(2024, 1, 20))


def rollup_view_durations(r: StarRetail) -> DataFrame:
    state = rolled_up(r, "view-days", lambda views: rollups.value_days(views, "view_duration", "page_type"), r.page_views, "view_id")
    views = r.page_views.filter(F.col("date").between(*VIEW_DAYS))
    return rollups.value_summary(rollups.between(state, *VIEW_DAYS), views, "view_duration", "page_type")


def rollup_metrics(r: StarRetail) -> DataFrame:
    hot = r.hot_keys("items", "transaction_id")
    build = lambda orders: rollups.product_days(attach(
        r.items, orders.select("transaction_id", "date"), "transaction_id", hot=hot, by=ITEM_SPREAD["transaction_id"]))
    return rollups.product_daily_metrics(rolled_up(r, "product-days", build), r.products)


def rollup_buyers(r: StarRetail) -> DataFrame:
    numbers = rollups.numbered(r.orders, "user_id")
    state = rolled_up(r, "buyer-days", lambda orders: rollups.buyer_days(orders, numbers))
    periods = {"month": F.date_format("date", "yyyy-MM"), "quarter": F.concat_ws("-Q", F.year("date"), F.quarter("date")), "all": F.lit("all"),
               "method": F.col("payment_method")}
    return reduce(DataFrame.unionByName, (rollups.buyers(state, label).select(F.lit(period).alias("period"), "label", "buyers") for period, label in periods.items()))


STORE_BUCKETS = 8


def bucketed(r: StarRetail, *names: str) -> Store:
    """The named tables of the bucketed store, written to the shared folder."""
    store = Store(r.spark, _scratch(r, "store"), etl.store_layouts(r), etl.store_buckets(r, STORE_BUCKETS))
    tables = etl.store_tables(r)
    store.write({name: tables[name] for name in names})
    return store


def store_txn_lines(r: StarRetail) -> DataFrame:
    return etl.stored_txn_lines(bucketed(r, "lines", "transactions"), r.product_dim(), r.hot_keys("items", "product_id"))


def store_products(r: StarRetail) -> DataFrame:
    return _flat_products(bucketed(r, "products").read("products"))


def stored_sessions(r: StarRetail) -> DataFrame:
    """The session table of the warehouse, written in key order and read back."""
    path = _scratch(r, "sessions")
    df, keys = etl.warehouse(r)["sessions"]
    results.write_key_ordered(df, path, keys)
    return r.spark.read.parquet(path)


def _scratch(r: StarRetail, name: str) -> str:
    return scratch_path(r.spark, name)


def as_documents(r: StarRetail, *entities: str) -> documents.DocumentRetail:
    """The tables written as nested JSON documents and loaded through the other adapter."""
    path = _scratch(r, "documents")
    for name, df in documents.documents_of(r).items():
        if name in entities:
            documents.write_json(df, posixpath.join(path, f"{name}.json"))
    return documents.DocumentRetail({name: documents.read_entity(r.spark, path, name, multi_line=False) for name in entities})


ARRAY_FILES = 3


def as_arrays(r: StarRetail, *entities: str) -> documents.DocumentRetail:
    """The same, as files that hold one pretty-printed array each."""
    path = _scratch(r, "arrays")
    for name, df in documents.documents_of(r).items():
        if name in entities:
            documents.write_array(df, posixpath.join(path, f"{name}.json"), df.columns[0], ARRAY_FILES)
    return documents.DocumentRetail({name: documents.read_entity(r.spark, path, name) for name in entities})


def users_of(loaded: DataFrame) -> DataFrame:
    return loaded.select("user_id", "name", "geo_data.city", "geo_data.province", "registration_date")


def document_cart_lines(r: StarRetail) -> DataFrame:
    """Cart lines exploded from the carts of session documents, products by their text ids."""
    d = as_documents(r, "sessions")
    names = r.product_dim().withColumn("product_id", F.col("product_id").cast("string"))
    return etl.cart_lines(d.carts, d.sessions, names).withColumn("product_id", F.col("product_id").cast("bigint"))


def document_activity_filled(r: StarRetail) -> DataFrame:
    """Activity from two sources: the first has none for some sessions, no carts for others, the second has all."""
    full = etl.document_sessions_flat(as_documents(r, "sessions").entities["sessions"])
    kind = F.pmod(F.xxhash64("session_id"), F.lit(4))
    first = full.withColumns({
        "page_views": F.when(kind == 0, "[]").when(kind == 1, F.lit(None)).otherwise(F.col("page_views")),
        "viewed_products": F.when(kind == 0, "").otherwise(F.col("viewed_products")),
        "cart_contents": F.when(kind.isin(0, 2), "{}").otherwise(F.col("cart_contents"))})
    return held_activity(etl.fill_activity(first, full))


def document_activity(r: StarRetail) -> DataFrame:
    """Activity of session documents kept as JSON text in the wide table and decoded again, with what it holds."""
    return held_activity(etl.document_sessions_flat(as_documents(r, "sessions").entities["sessions"]))


def held_activity(flat: DataFrame) -> DataFrame:
    size = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("bigint").alias(c)
    units = F.coalesce(F.aggregate(F.map_values("cart_contents"), F.lit(0).cast("bigint"), lambda a, x: a + x["quantity"]), F.lit(0).cast("bigint"))
    return etl.parse_activity(flat).select("session_id", "user_id", size("page_views"), size("viewed_products"), size("cart_contents"), units.alias("units"))


def users_from_json(r: StarRetail) -> DataFrame:
    """Users written as JSON documents in several files and loaded with the declared schema."""
    path = _scratch(r, "users")
    documents.write_json(r.users.select(
        F.col("user_id").cast("string").alias("user_id"), "name", F.struct("city", "province").alias("geo_data"), iso_text("registration_date").alias("registration_date"),
    ), posixpath.join(path, "users.json"))
    return users_of(documents.read_entity(r.spark, path, "users", multi_line=False))


def subcategories_from_json(r: StarRetail) -> DataFrame:
    """Categories with their (few) subcategories as nested documents, loaded and exploded again."""
    sub = F.struct("subcategory_id", F.col("subcategory_name").alias("name"), F.col("profit_margin").cast("double").alias("profit_margin"))
    path = _scratch(r, "categories")
    documents.write_json(r.subcategories.groupBy("category_id", F.col("category_name").alias("name")).agg(
        F.collect_list(sub).alias("subcategories")), posixpath.join(path, "categories.json"))
    return documents.explode_subcategories(documents.read_entity(r.spark, path, "categories", multi_line=False))


CATALOG: dict[str, Query] = {
    # load, clean, profile
    "users_from_json": users_from_json,
    "subcategories_from_json": subcategories_from_json,
    "documents_daily_revenue": lambda r: commerce.daily_revenue(as_documents(r, "transactions").orders),
    "documents_category_revenue": lambda r: (lambda d: insights.category_revenue(d.items, d.product_dim()))(as_documents(r, "transactions", "products", "categories")),
    "documents_funnel_stages": lambda r: funnel.funnel_stages(funnel.funnel_flags(as_documents(r, "sessions").sessions)),
    "documents_page_transitions": lambda r: sessions.nested_page_transitions(as_documents(r, "sessions").entities["sessions"]),
    "document_activity": document_activity,
    "document_activity_filled": document_activity_filled,
    "document_cart_lines": document_cart_lines,
    "arrays_users": lambda r: users_of(as_arrays(r, "users").entities["users"]),
    "arrays_subcategories": lambda r: as_arrays(r, "categories").subcategories,
    "arrays_products": lambda r: as_arrays(r, "products").entities["products"].select(F.col("product_id").cast("bigint").alias("product_id"), "name", "current_stock", "is_active"),
    "arrays_daily_revenue": lambda r: commerce.daily_revenue(as_arrays(r, "transactions").orders),
    "arrays_funnel_stages": lambda r: funnel.funnel_stages(funnel.funnel_flags(as_arrays(r, "sessions").sessions)),
    "clean_products": lambda r: documents.clean_products(r.products).select("product_id", "name", "current_stock", "is_active"),
    "subcategories": lambda r: r.subcategories,
    "null_profile": lambda r: profiling.null_profile(r.page_views),
    "duplicate_key_check_lines": lambda r: profiling.duplicate_key_check(r.items, "transaction_id"),
    "duplicate_key_check_orders": lambda r: profiling.duplicate_key_check(r.orders, "transaction_id"),
    "row_counts": lambda r: profiling.row_counts(
        {"users": r.customers, "products": r.products, "orders": r.orders, "items": r.items, "page_views": r.page_views}),
    "table_stats": lambda r: profiling.table_stats(etl.sessions_flat(r.sessions), "row_key"),
    # denormalise and materialise
    "products_enriched": enriched_flat,
    "purchase_summary": lambda r: etl.purchase_summary(r.orders),
    "users_enriched": lambda r: etl.users_enriched(r.customers, etl.purchase_summary(r.orders)),
    "product_daily_metrics": metrics,
    "sessions_flat": lambda r: etl.sessions_flat(r.sessions),
    "txn_lines": etl.txn_lines,
    "users_flat": lambda r: etl.users_flat(r.users, etl.order_totals(r.orders)),
    "sessions_summary": lambda r: etl.sessions_summary(r.sessions),
    "page_views": lambda r: r.page_views.withColumn("product_id", F.col("product_id").cast("string")),
    "cart_lines": lambda r: etl.cart_lines(
        r.carts, r.sessions, r.product_dim(), r.hot_keys("cart_events", "product_id"), r.hot_keys("cart_events", "session_id")),
    "price_history": lambda r: etl.price_history(r.price_points, r.product_dim()),
    "materialised_daily_revenue": materialised,
    # the same from mergeable states
    "rollup_product_daily_metrics": rollup_metrics,
    "rollup_purchase_summary": lambda r: rollups.purchase_summary(rolled_up(r, "purchases", rollups.purchase_days)),
    "rollup_buyers": rollup_buyers,
    "rollup_view_durations": rollup_view_durations,
    # document-store style reports
    "product_popularity": lambda r: commerce.product_popularity(completed(r), r.product_dim()),
    "revenue_by_category": categories_flat,
    "revenue_by_subcategory": lambda r: commerce.revenue_by_subcategory(completed(r), r.product_dim()),
    "spending_tiers": lambda r: commerce.spending_tiers(user_totals(r), SPEND_BOUNDS),
    "spending_by_province": lambda r: commerce.spending_by_province(user_totals(r)),
    "monthly_revenue": lambda r: commerce.monthly_revenue(r.transactions(only="completed")),
    "payment_methods": lambda r: commerce.payment_methods(r.transactions(only="completed")),
    # key access
    "user_sessions": lambda r: lookup.user_sessions(r.sessions_of(ONE_USER), ONE_USER),
    "sessions_by_key": lambda r: lookup.sessions_by_key(r.sessions, SCAN_ROWS),
    "stored_user_sessions": lambda r: lookup.stored_user_sessions(stored_sessions(r), ONE_USER),
    "stored_sessions_by_key": lambda r: lookup.stored_sessions_by_key(stored_sessions(r), SCAN_ROWS),
    "store_user_sessions": lambda r: lookup.bucketed_user_sessions(bucketed(r, "sessions").read("sessions"), ONE_USER),
    "store_product_metrics_for": lambda r: lookup.product_metrics_for(bucketed(r, "product_metrics").read("product_metrics"), ONE_PRODUCT),
    "store_txn_lines": store_txn_lines,
    "store_monthly_revenue": lambda r: commerce.monthly_revenue(bucketed(r, "transactions").read("transactions").filter("status = 'completed'")),
    "store_products": store_products,
    "store_users": lambda r: bucketed(r, "users").read("users").drop("registration_date"),
    "recent_sessions": lambda r: lookup.recent_sessions(r.sessions, SCAN_ROWS),
    "product_metrics_for": lambda r: lookup.product_metrics_for(metrics_of(r, ONE_PRODUCT), ONE_PRODUCT),
    "product_metrics_summary": lambda r: lookup.product_metrics_summary(metrics_of(r, ONE_PRODUCT), ONE_PRODUCT),
    # recommendation
    "co_purchase_pairs": pairs,
    "top_pairs": lambda r: recommend.top_pairs(r.items, r.product_dim(), hot=r.hot_keys("items", "transaction_id")),
    "also_bought": recommendations,
    "search_recommendations": lambda r: recommend.search_recommendations(recommendations(r), SEARCH),
    "indexed_search_recommendations": indexed_search,
    "product_search": lambda r: name_index.find(name_postings(r), "product_id", NEEDLES),
    # cohorts
    "cohort_activity": lambda r: cohort.cohort_activity(r.orders, r.registrations, r.hot_keys("orders", "user_id")),
    "cohort_spending": lambda r: cohort.cohort_spending(r.orders, r.registrations),
    "cohort_spending_matrix": lambda r: matrix_text(cohort.cohort_cells(r.orders, r.registrations), "cohort", "months_since_reg", "revenue"),
    "cohort_summary": lambda r: cohort.cohort_summary(r.orders, r.registrations),
    "cohort_retention": lambda r: cohort.cohort_retention(r.orders, r.registrations),
    "cohort_retention_matrix": lambda r: matrix_text(cohort.cohort_cells(r.orders, r.registrations), "cohort", "months_since_reg", "active_users"),
    "cohort_retention_pct": lambda r: cohort.cohort_retention_pct(r.orders, r.registrations),
    "cohort_spending_calendar": lambda r: cohort.cohort_spending_calendar(r.order_revenue("user_id", "date"), r.registrations),
    "cohort_spending_calendar_matrix": lambda r: matrix_text(
        cohort.cohort_spending_calendar(r.order_revenue("user_id", "date"), r.registrations), "cohort_month", "activity_month", "revenue"),
    # sales and session reports
    "top_products": lambda r: commerce.top_products(r.items, r.product_dim()),
    "device_behaviour": lambda r: sessions.device_behaviour(r.sessions),
    "funnel_overview": lambda r: sessions.funnel_overview(r.sessions),
    "daily_revenue": lambda r: commerce.daily_revenue(r.orders),
    "price_variability": lambda r: commerce.price_variability(r.sales("date"), r.product_dim()),
    # lifetime value
    "txn_metrics": lambda r: clv.txn_metrics(r.orders),
    "session_metrics": lambda r: clv.session_metrics(r.sessions),
    "clv": clv_table,
    "clv_tier_summary": lambda r: clv.clv_tier_summary(clv_table(r)),
    "top_customers_by_clv": lambda r: clv.top_customers_by_clv(clv_table(r)),
    "engagement_by_tier": lambda r: clv.engagement_by_tier(clv_table(r)),
    "clv_by_province": lambda r: clv.clv_by_province(clv_table(r)),
    # funnel
    "funnel_flags": flags,
    "session_purchases": lambda r: funnel.with_purchases(flags(r), r.session_purchases).select(
        "session_id", "conversion_status", "purchase_amount", "items_purchased"),
    "funnel_stages": lambda r: funnel.funnel_stages(flags(r)),
    "funnel_by_device_type": lambda r: funnel.funnel_by(flags(r), "device_type"),
    "funnel_by_referrer": lambda r: funnel.funnel_by(flags(r), "referrer"),
    "funnel_by_time_of_day": lambda r: funnel.funnel_by(flags(r), "time_of_day"),
    "funnel_rates_long": lambda r: funnel.funnel_rates_long(funnel.funnel_by(flags(r), "device_type"), "device_type"),
    "avg_purchase": lambda r: funnel.avg_purchase(flags(r), r.session_purchases),
    "cart_abandonment": lambda r: funnel.cart_abandonment(flags(r)),
    "cart_abandonment_by_device": lambda r: funnel.cart_abandonment_by_device(flags(r)),
    # chart data sets
    "weekly_category_revenue": lambda r: insights.weekly_category_revenue(r.sales("date"), r.product_dim()),
    "weekly_revenue": lambda r: insights.weekly_revenue(r.order_revenue("date")),
    "category_concentration": lambda r: insights.category_concentration(r.items, r.product_dim()),
    "customer_tiers": lambda r: tiered(r).select("user_id", "province", "total_spent", "total_orders", "tier"),
    "tiers_by_province": lambda r: insights.tiers_by_province(tiered(r)),
    "tiers_by_province_wide": lambda r: insights.tiers_by_province_wide(tiered(r)),
    "segment_insight": lambda r: insights.segment_insight(tiered(r)),
    "product_performance": lambda r: insights.product_performance(r.items, r.product_dim()),
    "product_insight": lambda r: insights.product_insight(r.items, r.product_dim()),
    "device_funnel": lambda r: funnel.device_funnel(r.sessions),
    "device_funnel_insight": lambda r: funnel.device_funnel_insight(r.sessions),
    # dashboard data sets
    "filtered_lines": filtered_lines,
    "filtered_users": lambda r: filters.by_province(r.customers, PROVINCES),
    "filtered_sessions": lambda r: filtered_sessions(r).select("session_id", "province", "start_time"),
    "filtered_page_views": filtered_page_views,
    "overview_kpis": lambda r: insights.overview_kpis(r.order_revenue("date"), r.items, r.customers, r.sessions),
    "daily_revenue_lines": lambda r: insights.daily_revenue_lines(r.order_revenue("date")),
    "category_revenue": lambda r: insights.category_revenue(r.items, r.product_dim()),
    "payment_revenue": lambda r: insights.payment_revenue(r.order_revenue("payment_method")),
    "status_payment_revenue": lambda r: insights.status_payment_revenue(r.order_revenue("status", "payment_method")),
    "monthly_changes": lambda r: insights.monthly_changes(r.order_revenue("date")),
    "monthly_volume": lambda r: insights.monthly_volume(r.order_revenue("date")),
    "tier_summary": lambda r: insights.tier_summary(tiered(r)),
    "filtered_tier_summary": lambda r: insights.tier_summary(tiered(r), ["VIP", "Regular", "Low"]),
    "registrations": lambda r: insights.registrations(r.users),
    "top_provinces": lambda r: insights.top_provinces(user_totals(r)),
    "top_customers": lambda r: insights.top_customers(tiered(r)),
    "active_users": lambda r: insights.active_users(tiered(r)),
    "spend_distribution": lambda r: insights.spend_distribution(tiered(r)),
    "product_stats": lambda r: insights.product_stats(r.items, r.product_dim()),
    "best_products_by_revenue": lambda r: insights.best_products(insights.product_stats(r.items, r.product_dim()), "revenue"),
    "best_products_by_quantity": lambda r: insights.best_products(insights.product_stats(r.items, r.product_dim()), "quantity"),
    "subcategory_revenue": subcategories,
    "subcategory_totals": lambda r: insights.subcategory_totals(subcategories(r)),
    "top_subcategories": lambda r: insights.top_subcategories(subcategories(r)),
    "price_timeline": price_timeline,
    "category_stats": lambda r: insights.category_stats(r.items, r.product_dim()),
    "status_counts": lambda r: sessions.status_counts(r.sessions),
    "filtered_status_counts": lambda r: sessions.status_counts(sessions.session_filter(r.sessions, ["mobile", "desktop"], ["direct", "email"])),
    "stage_counts": lambda r: sessions.stage_counts(r.sessions),
    "conversion_by_device_type": lambda r: sessions.conversion_by(r.sessions, "device_type"),
    "conversion_by_referrer": lambda r: sessions.conversion_by(r.sessions, "referrer", with_duration=True),
    "conversion_by_browser": lambda r: sessions.conversion_by(r.sessions, "browser"),
    "conversion_by_hour": lambda r: sessions.conversion_by(r.sessions, "hour"),
    "session_flow": lambda r: sessions.session_flow(r.sessions),
    "session_flow_edges": lambda r: sessions.session_flow_edges(r.sessions),
    "device_os_matrix": lambda r: sessions.device_os_matrix(r.sessions, SYSTEMS),
    "device_os_map": device_os_text,
    "page_view_kpis": lambda r: sessions.page_view_kpis(r.page_views),
    "filtered_page_view_kpis": lambda r: sessions.page_view_kpis(sessions.page_type_filter(r.page_views, PAGE_TYPES)),
    "page_type_stats": lambda r: sessions.page_type_stats(r.page_views),
    "daily_page_views": lambda r: sessions.daily_page_views(r.page_views),
    "page_transitions": lambda r: sessions.page_transitions(r.page_views),
    "cart_kpis": lambda r: insights.cart_kpis(r.carts, r.sessions, insights.orders_with_items(r.orders, r.items)),
    "status_share": lambda r: insights.status_share(insights.orders_with_items(r.orders, r.items)),
    "cart_value_histogram": lambda r: insights.cart_value_histogram(r.carts),
    "cart_value_quartiles": lambda r: insights.cart_value_quartiles(r.carts),
    "discount_bridge": lambda r: insights.discount_bridge(r.order_revenue("total")),
    "refund_rate_by_category": lambda r: insights.refund_rate_by_category(
        r.items, r.orders, r.product_dim(), r.hot_keys("items", "product_id")),
    "abandonment_by_referrer_device": lambda r: insights.abandonment_by_referrer_device(r.sessions),
}


def run(name: str, spark: SparkSession, path: str) -> DataFrame:
    return portable(CATALOG[name](store(spark, path)))
