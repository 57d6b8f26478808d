"""Nested documents: loading, flattening and the analyses on hand-written edge rows."""

import datetime as dt

from pyspark.sql import functions as F

from basketry.functions.calendar import iso_text
from basketry.operators import baskets, profiling
from basketry.plans import clv, cohort, commerce, etl, filters, funnel, insights, lookup, recommend, sessions
from basketry.sources import documents as docs
from basketry.sources import results


def test_load_types_and_defaults(documents, rows):
    assert documents["sessions"].count() == 6
    assert dict(documents["sessions"].dtypes)["cart_contents"].startswith("map<string,")
    assert dict(documents["transactions"].dtypes)["timestamp"] == "timestamp_ntz"
    got = rows(documents["products"].orderBy("product_id"), "product_id", "current_stock", "is_active")
    assert got == [("p1", 0, True), ("p2", 5, False), ("p3", 1, True)]


def test_json_lines_split_and_reload(spark, documents, tmp_path):
    raw = documents["users"].withColumns({c: iso_text(c) for c in ("registration_date", "last_active")})
    docs.write_json(raw, str(tmp_path / "users_out.json"), 3)
    again = docs.read_entity(spark, str(tmp_path), "users", multi_line=False)
    assert sorted(map(str, again.collect())) == sorted(map(str, documents["users"].collect()))


def test_unreadable_timestamp_becomes_null(spark):
    df = spark.createDataFrame([("u", "not a date")], "user_id string, registration_date string").withColumn("last_active", F.lit("2024-01-01T00:00:00Z"))
    row = docs.clean(df, "users").first()
    assert row["registration_date"] is None and row["last_active"] == dt.datetime(2024, 1, 1)


def test_profile(documents, retail, rows):
    assert rows(profiling.null_profile(documents["users"].drop("purchase_summary"))) == [("geo_data", 1)]
    assert rows(profiling.duplicate_key_check(retail.items, "transaction_id")) == [(10, 5, 5, "DUPLICATES")]
    keys = documents["users"].select(F.when(F.col("user_id") != "u1", F.col("user_id")).alias("k"))
    assert rows(profiling.duplicate_key_check(keys, "k")) == [(3, 3, 0, "OK")]
    assert sorted(rows(profiling.row_counts({"a": documents["users"], "b": documents["sessions"]}))) == [("a", 3), ("b", 6)]
    assert "user_id:string" in profiling.schemas(documents)["users"]


def test_subcategories_and_products(retail, rows):
    assert len(rows(retail.subcategories)) == 3
    dim = {r[0]: r[1:] for r in rows(retail.product_dim(), "product_id", "category", "subcategory", "profit_margin")}
    assert dim == {"p1": ("Kitchen", "Pans", 0.2), "p2": ("Kitchen", "Knives", 0.35), "p3": ("Garden", "Unknown", 0.0)}
    enriched = {r["product_id"]: r["category"] for r in etl.products_enriched(retail.products, retail.subcategories).collect()}
    assert enriched["p1"]["subcategory_name"] == "Pans" and enriched["p3"] is None


def test_txn_lines_unknown_product(retail, rows):
    lines = etl.txn_lines(retail)
    assert lines.columns == list(etl.LINE_COLUMNS) and lines.count() == 10
    assert rows(lines.filter("product_id = 'p9'"), "product_name", "category", "subcategory", "profit_margin") == [("p9", "Unknown", "Unknown", 0.0)]


def test_purchase_summary_ties_and_defaults(retail, rows):
    summary = etl.purchase_summary(retail.orders)
    got = {r[0]: r[1:] for r in rows(summary, "user_id", "total_orders", "total_spent", "avg_order_value", "favorite_payment_method")}
    assert got == {"u1": (2, 440.0, 220.0, "card"), "u2": (3, 350.0, 116.67, "card")}
    flat = {r[0]: r[1:] for r in rows(etl.users_flat(retail.users, summary), "user_id", "province", "total_orders", "total_spent")}
    assert flat == {"u1": ("North", 2, 440.0), "u2": ("Unknown", 3, 350.0), "u3": ("South", 0, 0.0)}


def test_daily_metrics(retail, rows):
    got = rows(etl.product_daily_metrics(retail.sales("date"), retail.products).filter("date = '2024-02-20'").orderBy("product_id"),
               "product_id", "total_quantity", "total_revenue", "num_transactions", "avg_unit_price", "current_stock", "is_active")
    assert got == [("p1", 2, 160.0, 2, 80.0, 0, True), ("p2", 3, 180.0, 1, 60.0, 5, False), ("p9", 1, 10.0, 1, 10.0, 0, False)]


def test_sessions_flat_and_lookup(documents, retail, rows):
    wide = etl.document_sessions_flat(documents["sessions"])
    row = wide.filter("session_id = 'x2'").first()
    assert row["row_key"] == "u1_" + str(9999999999999 - 1705298400000)
    assert (row["viewed_products"], row["cart_contents"]) == ("[]", "{}")
    again = etl.parse_activity(wide).select("session_id", *etl.ACTIVITY)
    assert sorted(map(str, again.collect())) == sorted(map(str, documents["sessions"].select("session_id", *etl.ACTIVITY).collect()))
    by_key = rows(lookup.sessions_by_key(retail.sessions, 3), "session_id", "user_id")
    assert by_key == [("x2", "u1"), ("x1", "u1"), ("x6", "u2")]
    assert rows(lookup.user_sessions(retail.sessions, "u2", 2), "session_id") == [("x6",), ("x5",)]
    assert rows(lookup.recent_sessions(retail.sessions, 1), "session_id") == [("x6",)]
    stats = profiling.table_stats(wide, "row_key").first()
    assert stats["row_count"] == 6 and stats["column_names"].startswith("row_key,session_id")


def test_fill_activity(documents, rows):
    wide = etl.document_sessions_flat(documents["sessions"])
    empty = wide.withColumns({"page_views": F.lit("[]"), "cart_contents": F.lit(None).cast("string")})
    filled = etl.fill_activity(empty, wide)
    assert sorted(rows(filled, "session_id", "page_views", "viewed_products")) == sorted(rows(wide, "session_id", "page_views", "viewed_products"))


def test_page_views_and_carts(documents, retail, rows):
    assert retail.page_views.count() == 8
    carts = {r[:2]: r[2:] for r in rows(etl.cart_lines(retail.carts, retail.sessions, retail.product_dim()),
                                        "session_id", "product_id", "category", "line_total", "conversion_status")}
    assert carts[("x1", "p1")] == ("Kitchen", 200.0, "converted") and carts[("x4", "p9")] == ("Unknown", 10.0, "abandoned")
    assert rows(etl.price_history(retail.price_points, retail.product_dim()).orderBy("product_id", "date"), "product_id", "price") == [
        ("p1", 90.0), ("p1", 100.0), ("p2", 50.0)]


def test_transitions_nested_and_flat(documents, retail, rows):
    expected = [("home", "home", 1), ("home", "product", 1), ("product", "checkout", 1)]
    assert sorted(rows(sessions.nested_page_transitions(documents["sessions"]))) == expected
    assert sorted(rows(sessions.page_transitions(retail.page_views))) == expected


def test_completed_only_reports(retail, rows):
    done = retail.sales("date", only="completed")
    assert rows(commerce.product_popularity(done, retail.product_dim()), "product_id", "total_qty", "num_orders") == [("p1", 2, 2), ("p2", 1, 1)]
    kitchen = commerce.revenue_by_category(done, retail.product_dim()).first()
    assert (kitchen["category"], float(kitchen["total_revenue"]), kitchen["total_orders"], kitchen["avg_order_value"]) == ("Kitchen", 250.0, 3, 83.33)
    assert [s["name"] for s in kitchen["subcategories"]] == ["Pans", "Knives"]
    months = rows(commerce.monthly_revenue(retail.transactions()), "month", "total_revenue", "discount_rate")
    assert months == [("2024-01", 225.0, 10.0), ("2024-04", 0.0, None)]  # no subtotal, no rate
    assert rows(commerce.payment_methods(retail.transactions()), "payment_method", "txn_count", "unique_users") == [("card", 2, 2)]


def test_popularity_limit_comes_before_the_join(retail, rows):
    sales = retail.sales("date", "status")
    unknown_first = sales.withColumn("quantity", F.when(F.col("product_id") == "p9", 1000).otherwise(F.col("quantity")))
    assert rows(commerce.product_popularity(unknown_first, retail.product_dim(), k=2), "product_id") == [("p1",)]


def test_spend_buckets(spark, rows):
    spent = [0.0, 1.0, 5000.0, 20000.0, 50000.0, 1000000.0, -1.0, None, 4999.99]
    users = spark.createDataFrame([(str(i), s, 1) for i, s in enumerate(spent)], "user_id string, s double, total_orders long").withColumn(
        "total_spent", F.col("s").cast("decimal(18,2)"))
    assert rows(commerce.spending_tiers(users), "tier", "count") == [
        ("Inactive", 1), ("Low", 2), ("Regular", 1), ("High", 1), ("VIP", 1), ("Other", 3)]


def test_segments(spark, rows):
    cases = [("a", 1999.99, 1), ("b", 2000.0, 1), ("c", 4999.99, 1), ("d", 5000.0, 1), ("e", 9000.0, 0)]
    users = spark.createDataFrame(cases, "user_id string, total_spent double, total_orders long")
    assert rows(insights.customer_tiers(users).orderBy("user_id"), "tier") == [("Low",), ("Regular",), ("Regular",), ("VIP",), ("Inactive",)]
    tiered = insights.customer_tiers(users.withColumn("total_spent", F.col("total_spent").cast("decimal(18,2)")).withColumn("province", F.lit("N")))
    assert rows(insights.tier_summary(tiered, ["Inactive", "VIP"]), "tier", "label") == [("VIP", "1 (50.0%)"), ("Inactive", "1 (50.0%)")]
    assert rows(insights.tiers_by_province_wide(tiered)) == [("N", 1, 2, 1, 1)]
    assert rows(insights.segment_insight(tiered), "vip_count", "inactive_count", "inactive_pct") == [(1, 1, 20.0)]


def test_co_purchase(retail, rows):
    pairs = baskets.pair_counts(retail.items)
    assert sorted(rows(pairs)) == [("p1", "p2", 2), ("p1", "p3", 1), ("p1", "p9", 1), ("p2", "p3", 1)]
    assert rows(recommend.top_pairs(retail.items, retail.product_dim(), 2), "product_a", "product_b") == [("p1", "p2"), ("p1", "p3")]
    recs = recommend.also_bought(retail.items, retail.product_dim(), 1)
    assert sorted(rows(recs, "source_product", "recommended_product")) == [("p1", "p2"), ("p2", "p1"), ("p3", "p1")]
    assert rows(recommend.search_recommendations(recs, "kNi"), "source_product") == [("p1",), ("p2",)]
    assert recommend.search_recommendations(recs, ".*").count() == 0  # literal, not a pattern


def test_cohorts(retail, rows):
    assert rows(cohort.cohort_spending(retail.orders, retail.users)) == [
        ("2024-01", 0, 225.0), ("2024-01", 1, 215.0), ("2024-02", 0, 350.0), ("2024-02", 2, 0.0)]
    assert rows(cohort.cohort_retention_pct(retail.orders, retail.users), "cohort", "months_since_reg", "retention_pct")[0] == ("2024-01", 0, 100.0)
    wide = cohort.pivot_offsets(cohort.cohort_cells(retail.orders, retail.users), "revenue", [0, 1, 2])
    assert rows(wide) == [("2024-01", 225.0, 215.0, None), ("2024-02", 350.0, None, 0.0)]
    orphan = retail.users.withColumn("registration_date", F.when(F.col("user_id") == "u1", F.col("registration_date")))
    calendar = cohort.cohort_spending_calendar(retail.order_revenue("user_id", "date"), orphan)
    assert ("Unknown", "2024-02", 350.0) in rows(calendar)
    assert rows(cohort.pivot_months(calendar, ["2024-01", "2024-05"])) == [("2024-01", 250.0, 0.0), ("Unknown", 0.0, 0.0)]


def test_sales_reports(retail, rows):
    best = rows(commerce.top_products(retail.items, retail.product_dim(), 2), "product_id", "times_sold", "total_revenue", "est_profit")
    assert best == [("p1", 5, 450.0, 90.0), ("p2", 3, 285.0, 99.75)]
    daily = rows(commerce.daily_revenue(retail.orders), "daily_revenue", "moving_avg_7d", "cumulative_revenue")
    assert daily == [(225.0, 225.0, 225.0), (215.0, 220.0, 440.0), (350.0, 263.33, 790.0), (0.0, 197.5, 790.0)]
    variability = rows(commerce.price_variability(retail.sales("date"), retail.product_dim(), min_days=3), "product_id", "active_days", "total_units")
    assert variability == [("p1", 4, 5), ("p2", 3, 5)]  # p3: too few days and no price history


def test_constant_price_has_no_ratio(retail, rows):
    flat = retail.sales("date").withColumn("unit_price", F.lit(500))
    got = rows(commerce.price_variability(flat, retail.product_dim()), "price_stddev", "price_variability_ratio")
    assert got == [(0.0, None), (0.0, None)]


def test_clv(retail, rows):
    table = clv.clv(retail.users, clv.txn_metrics(retail.orders), clv.session_metrics(retail.sessions))
    got = {r[0]: r[1:] for r in rows(table, "user_id", "txn_count", "lifespan_days", "session_count", "clv_tier")}
    assert got == {"u1": (2, 31, 2, "Platinum"), "u2": (3, 41, 4, "Platinum"), "u3": (0, 0, 0, "Bronze")}
    one_day = clv.txn_metrics(retail.orders.filter("transaction_id = 't1'")).first()
    assert one_day["purchase_frequency"] == 1.0
    profile = retail.users.withColumns({"total_orders": F.lit(1), "total_spent": F.lit(1.0), "avg_order_value": F.lit(None).cast("double")})
    assert {r["clv_tier"] for r in clv.clv(profile, clv.txn_metrics(retail.orders), clv.session_metrics(retail.sessions)).collect()} == {"Bronze"}


def test_funnel(retail, rows):
    flags = funnel.funnel_flags(retail.sessions)
    assert [r[0] for r in rows(flags.orderBy("session_id"), "time_of_day")] == ["night", "morning", "afternoon", "evening", "evening", "night"]
    assert rows(funnel.funnel_stages(flags)) == [
        ("Browse", 6, 100.0, 100.0), ("View Product", 4, 66.7, 66.7), ("Add to Cart", 3, 50.0, 75.0), ("Purchase", 1, 16.7, 33.3)]
    assert rows(funnel.cart_abandonment(flags)) == [(3, 1, 1, 33.3)]  # a cart that is only browsing is not abandoned here
    assert rows(insights.cart_kpis(retail.carts, retail.sessions, insights.orders_with_items(retail.orders, retail.items)),
                "abandonment_rate_pct", "refund_rate_pct") == [(66.7, 20.0)]  # but it is here
    assert rows(funnel.avg_purchase(flags, retail.session_purchases), "purchases", "avg_amount", "avg_items") == [(1, 225.0, 2.0)]
    assert rows(sessions.funnel_overview(retail.sessions), "total_sessions", "added_to_cart", "cart_to_purchase_pct") == [(6, 2, 50.0)]
    assert ("overall", 6) in rows(funnel.device_funnel(retail.sessions), "device", "total_sessions")


def test_orders_and_discounts(retail, rows):
    assert rows(insights.discount_bridge(retail.order_revenue("total"))) == [(815.0, 25.0, 790.0, 3.1)]
    shares = rows(insights.status_share(insights.orders_with_items(retail.orders, retail.items)))
    assert shares == [("completed", 2, 40.0), ("shipped", 1, 20.0), ("processing", 1, 20.0), ("refunded", 1, 20.0)]
    refunds = rows(insights.refund_rate_by_category(retail.items, retail.orders, retail.product_dim()), "category", "count", "total")
    assert refunds == [("Kitchen", 1, 5), ("Unknown", 1, 1)]


def test_product_label(retail, rows):
    labels = dict(rows(insights.product_performance(retail.items, retail.product_dim()), "product_id", "label"))
    assert labels["p1"] == "Pan with a very long desc... [Kitchen]" and labels["p9"] == "p9 [Unknown]"


def test_filters(retail, rows):
    day = dt.date(2024, 2, 20)
    assert filters.by_date(retail.orders, day, day, "timestamp").count() == 2
    assert filters.by_date(retail.orders, None, day).count() == 4
    assert filters.by_category(retail.items, retail.product_dim(), ["Garden"]).count() == 1
    kept = filters.by_province(retail.sessions, ["South"])
    assert filters.of_sessions(retail.page_views, kept).count() == 0
    chosen = sessions.session_filter(retail.sessions, devices=["desktop"], referrers=["email"])
    assert rows(sessions.status_counts(chosen), "total", "browsing", "browsing_pct") == [(2, 2, 100.0)]


def test_empty_inputs_keep_their_columns(retail, rows):
    none = retail.sessions.filter("false")
    assert rows(funnel.funnel_stages(funnel.funnel_flags(none)))[0] == ("Browse", 0, 0.0, 0.0)
    assert rows(sessions.funnel_overview(none), "total_sessions", "conversion_rate_pct") == [(0, None)]
    assert sessions.page_transitions(retail.page_views.filter("false")).count() == 0
    assert commerce.daily_revenue(retail.orders.filter("false")).columns[-1] == "cumulative_revenue"
    assert insights.cart_value_histogram(retail.carts.filter("false")).count() == 0
    assert insights.spend_distribution(insights.customer_tiers(etl.with_totals(retail.users, etl.order_totals(retail.orders.filter("false"))))).count() == 0


def test_results_round_trip(spark, retail, tmp_path, rows):
    named = {"a": commerce.daily_revenue(retail.orders), "b": funnel.funnel_stages(funnel.funnel_flags(retail.sessions))}
    for _ in range(2):  # running it again replaces the results
        results.materialise(named, str(tmp_path))
    back = results.load_results(spark, str(tmp_path), named)
    assert sorted(rows(back["a"])) == sorted(rows(named["a"])) and back["b"].count() == 4
    results.write_key_ordered(retail.sessions, str(tmp_path / "ordered"), ["user_id", "start_time"])
    assert spark.read.parquet(str(tmp_path / "ordered")).count() == 6


def test_enriched_documents(spark, documents, retail, rows):
    """Products with an embedded category and users with an embedded summary."""
    products = documents["products"].withColumns({
        "category": F.struct("category_id", F.lit("x").alias("name"), "subcategory_id", F.lit("x").alias("subcategory_name"), F.lit(0.0).alias("profit_margin")),
        "category_id": F.lit(None).cast("string"), "subcategory_id": F.lit(None).cast("string")})
    other = docs.DocumentRetail({**documents, "products": products})
    assert sorted(rows(other.product_dim(), "product_id", "category", "subcategory")) == sorted(rows(retail.product_dim(), "product_id", "category", "subcategory"))

    plain = etl.totals_or_orders(retail.profiles, retail.orders).orderBy("user_id")
    assert rows(plain, "user_id", "total_orders", "total_spent") == [("u1", 2, 440.0), ("u2", 3, 350.0), ("u3", 0, 0.0)]
    summary = F.when(F.col("user_id") == "u1", F.struct(F.lit(9).cast("bigint").alias("total_orders"), F.lit(99.5).alias("total_spent"), F.lit(11.06).alias("avg_order_value")))
    kept = docs.DocumentRetail({**documents, "users": documents["users"].withColumn("purchase_summary", summary)})
    assert rows(etl.totals_or_orders(kept.profiles, kept.orders).orderBy("user_id"), "user_id", "total_orders", "total_spent") == [
        ("u1", 9, 99.5), ("u2", 0, 0.0), ("u3", 0, 0.0)]


def test_apply_filters(retail, rows):
    lines, users, visits = filters.apply_filters(
        etl.txn_lines(retail), retail.users, retail.sessions, dt.date(2024, 1, 1), dt.date(2024, 1, 16), ["Kitchen"], ["North"])
    assert (lines.count(), users.count(), visits.count()) == (2, 1, 3)
    everything = filters.apply_filters(etl.txn_lines(retail), retail.users, retail.sessions)
    assert [df.count() for df in everything] == [10, 3, 6]


def test_warehouse(spark, retail, tmp_path, rows):
    for _ in range(2):
        results.write_warehouse(etl.warehouse(retail), str(tmp_path))
    stored = results.load_results(spark, str(tmp_path), ["products", "users", "transactions", "sessions", "product_metrics"])
    assert {name: df.count() for name, df in stored.items()} == {
        "products": 3, "users": 3, "transactions": 5, "sessions": 6, "product_metrics": 9}
    assert rows(lookup.product_metrics_summary(stored["product_metrics"], "p1"), "days", "total_units") == [(4, 5)]
    assert rows(lookup.product_metrics_for(stored["product_metrics"], "p1"), "total_quantity") == [(2,), (1,), (2,), (0,)]
