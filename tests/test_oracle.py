"""Every registered query against its SQL, on the plain tables and on a skewed copy."""

import duckdb
import pyarrow.parquet as pq
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from basketry.catalog.oracles import statements
from basketry.catalog.queries import CATALOG
from check import compare, connect

FOLDER = "/root/testdata/sf0.001"


def verify(spark, folder, name):
    mine = queries()[name](spark, folder).toPandas()
    theirs = connect(folder).execute(oracle_sql()[name]).df()
    assert compare(mine, theirs) == "ok"


@pytest.mark.parametrize("name", list(CATALOG))
def test_matches_sql(spark, name):
    verify(spark, FOLDER, name)


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """A third of the lines in one order, another third on one product, a third of the
    orders by one user, and a third of the events in one user's day."""
    out = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    changed = {
        "lineitem": """SELECT * REPLACE (CASE WHEN i % 3 = 0 THEN 1 ELSE l_orderkey END AS l_orderkey,
                                         CASE WHEN i % 3 = 1 THEN 5 ELSE l_partkey END AS l_partkey)""",
        "orders": "SELECT * REPLACE (CASE WHEN i % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey)",
        "events": """SELECT * REPLACE (CASE WHEN i % 3 = 0 THEN 3 ELSE user_id END AS user_id,
                                       CASE WHEN i % 3 = 0 THEN TIMESTAMP '2024-01-09' + (ts - date_trunc('day', ts)) ELSE ts END AS ts)""",
    }
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        source = f"'{FOLDER}/{name}.parquet'"
        if name in changed:
            con.execute(f"""COPY ({changed[name]} EXCLUDE (i) FROM
                (SELECT *, row_number() OVER () AS i FROM {source})) TO '{out}/{name}.parquet'""".replace(
                "SELECT * REPLACE", "SELECT * EXCLUDE (i) REPLACE").replace(" EXCLUDE (i) FROM", " FROM"))
        else:
            pq.write_table(pq.read_table(f"{FOLDER}/{name}.parquet"), out / f"{name}.parquet")
    for name in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        (out / f"{name}.parquet").symlink_to(f"{FOLDER}/{name}.parquet")
    return str(out)


def test_hot_keys_are_found(spark, skewed):
    from basketry.catalog.queries import store
    r = store(spark, skewed)
    assert set(r.hot_keys("items", "transaction_id").counts) == {1}
    assert set(r.hot_keys("items", "product_id").counts) == {5}
    assert set(r.hot_keys("orders", "user_id").counts) == {7}


@pytest.mark.parametrize("name", list(CATALOG))
def test_matches_sql_on_skewed_tables(spark, skewed, name):
    verify(spark, skewed, name)


def test_entry_and_registry(spark):
    assert entry(spark).count() > 0
    assert set(statements()) == set(CATALOG) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name,text", [("product_popularity", "EqualTo(o_orderstatus,F)"), ("product_metrics_for", "EqualTo(l_partkey,42)"),
                                       ("product_metrics_summary", "EqualTo(l_partkey,42)"), ("monthly_revenue", "EqualTo(o_orderstatus,F)"),
                                       ("payment_methods", "EqualTo(o_orderstatus,F)"), ("filtered_lines", "GreaterThanOrEqual(o_orderdate")])
def test_filters_reach_the_scan_of_skewed_tables(spark, skewed, name, text):
    assert text in queries()[name](spark, skewed)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["product_popularity", "revenue_by_category", "product_daily_metrics", "weekly_category_revenue"])
def test_only_needed_columns_of_skewed_tables_are_read(spark, skewed, name):
    plan = queries()[name](spark, skewed)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" in plan and "l_discount" not in plan and "l_tax" not in plan


def test_few_jobs_while_a_plan_is_built(spark, skewed):
    from basketry.catalog.queries import CATALOG as catalog
    from basketry.sources.star import StarRetail

    def jobs_of(name):
        r = StarRetail(spark, skewed)
        for table in ("items", "orders", "products", "sessions", "carts"):
            getattr(r, table)  # schemas are read
        jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
        before = jobs()
        catalog[name](r)
        return jobs() - before

    assert jobs_of("product_metrics_for") <= 1  # reads a schema at most
    assert jobs_of("txn_lines") <= 4 and jobs_of("cart_lines") <= 4
