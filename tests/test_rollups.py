"""Daily states: batches, late days, reruns, and distinct users from bitmaps."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from basketry.operators.quantiles import summary_by
from basketry.plans import etl, rollups

SCHEMA = "transaction_id long, user_id long, timestamp timestamp_ntz, date date, total long, payment_method string"


@pytest.fixture(scope="module")
def orders(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.randrange(40) if i % 50 else None, f"2024-0{1 + i % 3}-{1 + rnd.randrange(9):02d} 10:{i % 60:02d}:00", rnd.randrange(10000), rnd.choice("abc")) for i in range(600)]
    df = spark.createDataFrame(rows, "transaction_id long, user_id long, t string, total long, payment_method string")
    return df.select("transaction_id", "user_id", F.col("t").cast("timestamp_ntz").alias("timestamp"), F.to_date("t").alias("date"), "total", "payment_method")


def files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in path.rglob("part-*.parquet")}


def test_batches_give_the_rows_of_one_and_change_only_their_months(spark, orders, tmp_path):
    add = lambda rows, batch: rollups.add(rollups.purchase_days(rows), str(tmp_path), batch)
    add(orders.filter("date < '2024-03-01' AND transaction_id % 5 <> 0"), "one")
    before = files(tmp_path)
    add(orders.filter("date >= '2024-03-01' OR transaction_id % 5 = 0"), "two")  # late days among them
    after = files(tmp_path)
    assert before.items() <= after.items() and all("batch=two" in f for f in after.keys() - before.keys())
    state = rollups.read(spark, str(tmp_path), rollups.purchase_days(orders).schema)
    want = sorted(map(str, etl.purchase_summary(orders).collect()))
    assert sorted(map(str, rollups.purchase_summary(state).collect())) == want
    add(orders.filter("date >= '2024-03-01' OR transaction_id % 5 = 0"), "two")  # run again
    assert sorted(map(str, rollups.purchase_summary(state.sparkSession.read.schema(state.schema).parquet(str(tmp_path))).collect())) == want
    assert {f: t for f, t in files(tmp_path).items() if "batch=one" in f} == before


def test_days_open_the_folders_of_their_months_only(spark, orders, tmp_path):
    rollups.add(rollups.purchase_days(orders), str(tmp_path), "one")
    state = rollups.read(spark, str(tmp_path), rollups.purchase_days(orders).schema)
    for f in tmp_path.rglob("part-*.parquet"):
        if "month=2024-02" not in str(f):
            f.write_bytes(b"spoilt")
    days = rollups.between(state, date(2024, 2, 3), date(2024, 2, 5))
    assert days.agg(F.sum("orders")).first()[0] == orders.filter("date BETWEEN DATE '2024-02-03' AND DATE '2024-02-05'").count() > 0


def test_distinct_users_of_any_period(spark, orders, tmp_path):
    known = rollups.numbered(orders.filter("date < '2024-02-01'"), "user_id")
    numbers = rollups.numbered(orders, "user_id", known)
    found = {r["user_id"]: r["number"] for r in numbers.collect()}
    assert sorted(found.values()) == list(range(len(found))) and all(found[r["user_id"]] == r["number"] for r in known.collect())
    for batch, part in (("one", "transaction_id % 2 = 0"), ("two", "transaction_id % 2 = 1")):
        rollups.add(rollups.buyer_days(orders.filter(part), numbers), str(tmp_path), batch)
    state = rollups.read(spark, str(tmp_path), rollups.buyer_days(orders, numbers).schema)
    for label in (F.date_format("date", "yyyy-MM"), F.lit("all"), F.col("payment_method"), F.col("date").cast("string")):
        want = {r[0]: r[1] for r in orders.groupBy(label).agg(F.count_distinct("user_id")).collect()}
        assert {r["label"]: r["buyers"] for r in rollups.buyers(state, label).collect()} == want


def test_a_day_has_no_more_rows_than_buyers_and_each_is_small(spark, orders):
    """Few buyers among many users: the state grows with the orders, not with days times users."""
    far = spark.createDataFrame([(u, 1_000_003 * u) for u in range(40)], "user_id long, number long")
    days = rollups.buyer_days(orders, far)
    assert dict(days.dtypes)["users"] == "bigint"
    assert days.count() == orders.filter("user_id IS NOT NULL").select("date", "payment_method", "user_id").distinct().count()
    assert rollups.buyers(days, F.lit("all")).first()["buyers"] == 40
    full = spark.range(640).selectExpr("id AS user_id", "id AS number")  # all 64 bits of a word, the sign among them
    days = rollups.buyer_days(full.selectExpr("user_id", "DATE '2024-01-01' AS date", "'a' AS payment_method"), full)
    assert days.count() == 10 and rollups.buyers(days, F.col("payment_method")).first()["buyers"] == 640


def test_empty_keys(spark, orders):
    none = rollups.numbered(orders.filter("false"), "user_id")
    assert none.count() == 0 and rollups.numbered(orders, "user_id", none).count() == 40


def test_new_keys_never_take_a_number_of_known_ones(spark):
    keys = lambda n: spark.range(n).withColumnRenamed("id", "user_id")
    numbers = rollups.numbered(keys(1), "user_id")
    for n in (1, 2, 5):
        numbers = rollups.numbered(keys(n), "user_id", numbers)
        assert sorted(r["number"] for r in numbers.collect()) == list(range(n))


def test_exact_quartiles_of_any_days(spark, tmp_path):
    values = spark.range(60000).select(
        F.expr("date_add(DATE '2024-01-25', cast(id % 14 AS int))").alias("date"), F.when(F.col("id") % 3 > 0, "a").when(F.col("id") % 1000 > 0, "b").otherwise("c").alias("kind"),
        F.when(F.col("id") % 17 > 0, F.round(F.log(F.lit(1.5) + F.pmod(F.xxhash64("id"), F.lit(10**6))) * 10, 2)).alias("v"), "id")
    for batch, part in (("one", "id % 4 > 0"), ("two", "id % 4 = 0")):
        rollups.add(rollups.value_days(values.filter(part), "v", "kind"), str(tmp_path), batch)
    state = rollups.read(spark, str(tmp_path), rollups.value_days(values, "v", "kind").schema)
    for days in ((date(2024, 1, 25), date(2024, 2, 7)), (date(2024, 1, 30), date(2024, 2, 2)), (date(2024, 2, 3), date(2024, 2, 3)), (date(2025, 1, 1), date(2025, 1, 2))):
        rows = values.filter(F.col("date").between(*days))
        want = sorted(map(tuple, summary_by(rows, "v", "kind").collect()))
        assert sorted(map(tuple, rollups.value_summary(rollups.between(state, *days), rows, "v", "kind").collect())) == want and (len(want) >= 2) == (days[0].year == 2024)


def test_sketches_narrow_what_is_ordered(spark):
    values = spark.range(100000).select(F.lit(date(2024, 1, 1)).alias("date"), F.lit("a").alias("kind"), F.pmod(F.xxhash64("id"), F.lit(10**9)).alias("v"))
    (s,) = rollups.value_days(values, "v", "kind").collect()
    assert s["n"] == 100000 and len(s["sketch"]) < 200_000
    low, high = spark.createDataFrame([(s["sketch"],)], "s binary").select(*[F.kll_sketch_get_quantile_double("s", F.lit(0.5 + m)) for m in (-rollups.MARGIN, rollups.MARGIN)]).first()
    inside = values.filter(F.col("v").between(low, high)).count()
    assert 0 < inside < 3 * rollups.MARGIN * 100000 and values.filter(F.col("v") < low).count() < 50000 < values.filter(F.col("v") <= high).count()
