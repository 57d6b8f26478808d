"""Plan shape of the registered queries with broadcasts switched off, as for large tables."""

import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from basketry.catalog.queries import CATALOG, run, store
from basketry.plans import cohort, funnel, insights, sessions

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_no_cross_joins_and_no_python(spark, no_broadcast):
    for name in CATALOG:
        text = plan(run(name, spark, FOLDER))
        for word in ("CartesianProduct", "NestedLoop", "EvalPython", "InPandas", "InArrow"):
            assert word not in text, (name, word)


def test_filters_reach_the_scan(spark):
    wanted = {
        "user_sessions": "EqualTo(user_id,7)",
        "product_popularity": "EqualTo(o_orderstatus,F)",
        "product_metrics_for": "EqualTo(l_partkey,42)",
        "filtered_sessions": "GreaterThanOrEqual(ts",
        "filtered_lines": "GreaterThanOrEqual(o_orderdate",
    }
    for name, text in wanted.items():
        assert text in run(name, spark, FOLDER)._jdf.queryExecution().executedPlan().toString(), name


def test_only_needed_columns_are_read(spark):
    text = plan(run("payment_revenue", spark, FOLDER))
    assert sorted(re.findall(r"ReadSchema: struct<([^>]*)>", text)) == [
        "l_orderkey:bigint,l_extendedprice:double", "o_orderkey:bigint,o_orderpriority:string"]


def test_unpartitioned_windows_see_reduced_rows_only(spark, no_broadcast):
    for name in CATALOG:
        for line in plan(run(name, spark, FOLDER)).splitlines():
            if "Exchange SinglePartition" in line:
                break
        else:
            continue
        text = plan(run(name, spark, FOLDER))
        below = text[text.index("Exchange SinglePartition"):]
        assert "HashAggregate" in below, name


def test_invariants(spark):
    r = store(spark, FOLDER)
    stages = {x["stage"]: x["count"] for x in funnel.funnel_stages(funnel.funnel_flags(r.sessions)).collect()}
    assert stages["Browse"] >= stages["Add to Cart"] >= stages["Purchase"]
    total = Decimal(r.items.agg({"subtotal": "sum"}).first()[0]) / 100
    assert sum(x["revenue"] for x in insights.category_revenue(r.items, r.product_dim()).collect()) == total
    assert sum(x["revenue"] for x in insights.weekly_revenue(r.order_revenue("date")).collect()) == total
    assert all(0 <= x["retention_pct"] <= 100 for x in cohort.cohort_retention_pct(r.orders, r.registrations).collect())
    steps = sessions.page_transitions(r.page_views).agg({"count": "sum"}).first()[0]
    assert steps == r.page_views.count() - r.sessions.count()


def test_spread_of_products_with_very_many_units(spark):
    """A billion units a day: squares and their sums leave the range of a BIGINT."""
    from datetime import date

    from basketry.plans import commerce
    days = [(1, date(2024, 1, d + 1), 10**9 + d, 100 + d) for d in range(4)]
    sales = spark.createDataFrame(days, "product_id long, date date, quantity long, unit_price long")
    dim = spark.createDataFrame([(1, "p", True)], "product_id long, name string, has_price_history boolean").withColumn("base_price", F.lit(1).cast("decimal(18,2)"))
    row = commerce.price_variability(sales, dim).first()
    assert (row["total_units"], row["units_stddev"], row["active_days"]) == (4 * 10**9 + 6, 1.29, 4)


@pytest.mark.parametrize("report", ["clv_tier_summary", "engagement_by_tier", "clv_by_province"])
def test_reports_do_not_depend_on_the_order_of_rows(spark, no_broadcast, report):
    from basketry.catalog.queries import clv_table
    from basketry.plans import clv
    users = clv_table(store(spark, FOLDER))
    results = set()
    for n in (1, 4, 64):
        totals = clv.Totals(users.repartition(n, "user_id"), "clv_tier")
        results.add(str(sorted(map(tuple, totals.rows.collect()))))
        results.add(str(sorted(map(tuple, clv.Totals(users.repartition(n), "clv_tier").rows.collect()))))
    assert len(results) == 1 and getattr(clv, report)(users).count() > 0


def test_matrices_hold_every_cell(spark):
    r = store(spark, FOLDER)
    cells = cohort.cohort_cells(r.orders, r.registrations)
    assert sum(len(x["revenue"]) for x in cohort.matrix(cells, "cohort", "months_since_reg", "revenue").collect()) == cells.count()
    wide = cohort.pivot_offsets(cells, "revenue")
    assert sum(v is not None for x in wide.collect() for v in x) - wide.count() == cells.count()


def test_key_reads_skip_row_groups(spark):
    text = run("stored_user_sessions", spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(row_key,7_)" in text


def test_grouped_quantiles_meet_no_group_in_one_task(spark, no_broadcast):
    for name in ("page_type_stats", "spend_distribution"):
        text = run(name, spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
        assert "_salt" in text


def test_every_operating_system_has_its_rate(spark):
    rows = [("phone", "ios", "converted"), ("phone", "ios", "browsing"), ("phone", "beos", "abandoned"), ("phone", None, "converted"),
            ("phone", "Unknown", "browsing"), ("desk", "beos", "converted")]
    found = sessions.device_os_map(spark.createDataFrame(rows, "device_type string, device_os string, conversion_status string")).collect()
    assert [(r["device_type"], r["rate"]) for r in found] == [("desk", {"beos": 100.0}), ("phone", {"Unknown": 50.0, "beos": 0.0, "ios": 50.0})]
