"""Operators against brute force, with and without hot keys."""

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.operators import adjacency, baskets
from basketry.operators.adjacency import chunk_records, transition_counts
from basketry.operators.baskets import pair_counts
from basketry.operators.joins import HotKeys, attach, find_hot_keys, measure_hot_keys
from basketry.operators.quantiles import summary_by
from basketry.operators.ranking import top_k, top_k_per_group


def test_hot_keys(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    hot = find_hot_keys(df, "k")
    assert hot.counts == {-1: 1000} and hot.total == 3000
    assert hot.splits(300) == {-1: 200}
    assert not find_hot_keys(spark.range(3000).withColumnRenamed("id", "k"), "k").counts
    assert not find_hot_keys(df.filter("false"), "k").counts
    missing = find_hot_keys(spark.range(900).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("k")), "k")
    assert (missing.counts, missing.nulls) == ({}, 300)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(spark, how):
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 5 > 0, F.col("id") % 50)
    fact = spark.range(600).select(key.alias("k"), (F.col("id") % 7).alias("v"))
    dim = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("d"))
    hot = find_hot_keys(fact, "k")
    assert 0 in hot.counts and hot.nulls
    salted = attach(fact, dim, "k", how, hot)
    assert sorted(map(str, salted.collect())) == sorted(map(str, attach(fact, dim, "k", how).collect()))


def test_several_keys_are_measured_in_one_pass(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("a"), (F.col("id") % 2).cast("string").alias("b"))
    before = jobs(spark)
    found = measure_hot_keys(df, ["a", "b"])
    assert jobs(spark) - before <= 2 and found["a"].counts == {-1: 1000} and found["b"].counts == {"0": 1500, "1": 1500}


def jobs(spark):
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))


def test_salt_spreads_one_key_and_lets_filters_and_pruning_through(spark, tmp_path):
    rows = spark.range(0, 4000, 1, 8).select(F.lit(1).alias("k"), (F.col("id") % 100).alias("v"), F.lit("wide").alias("w"))
    rows.write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    dim = spark.createDataFrame([(1, "d")], "k int, d string")
    joined = attach(fact, dim, "k", hot=HotKeys({1: 4000}, 4000), by=["v"])
    assert joined.count() == 4000
    plan = joined.filter("v = 7").select("k", "d")._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan and "EqualTo(v,7)" in plan and "w:string" not in plan
    salts = fact.select(F.pmod(F.xxhash64("v"), F.lit(16))).distinct().count()
    assert salts == 16


def brute_pairs(rows):
    baskets = {}
    for t, p in rows:
        baskets.setdefault(t, set()).add(p)
    return Counter(pair for b in baskets.values() for pair in combinations(sorted(b), 2))


@pytest.mark.parametrize("hot", [None, HotKeys({0: 400, 1: 100}, 1000)])
def test_pair_counts(spark, hot):
    rnd = random.Random(1)
    rows = [(0, rnd.randrange(60)) for _ in range(400)] + [(1, rnd.randrange(60)) for _ in range(100)]
    rows += [(rnd.randrange(2, 100), rnd.randrange(60)) for _ in range(500)]
    df = spark.createDataFrame(rows, "transaction_id long, product_id long")
    got = {(r[0], r[1]): r[2] for r in pair_counts(df, hot).collect()}
    assert got == dict(brute_pairs(rows))


def test_pairs_are_listed_by_as_many_tasks_as_they_ask_for(spark, monkeypatch):
    """A part is dealt once and counted where it lies; pairs of parts meet in as many tasks."""
    rnd = random.Random(4)
    rows = [(t, rnd.randrange(40)) for t in range(300) for _ in range(6)] + [(7, rnd.randrange(90)) for _ in range(400)]
    df = spark.createDataFrame(rows, "transaction_id long, product_id long")
    monkeypatch.setattr(baskets, "TASK_PAIRS", 100)
    for large in (20, 1000):
        assert {(r[0], r[1]): r[2] for r in pair_counts(df, None, large).collect()} == dict(brute_pairs(rows))
    tasks = baskets._large(df, 1000)[2]
    dealt = baskets._dealt(df, tasks)
    held = [len(part) for part in dealt.rdd.glom().collect()]
    assert tasks > 20 and len(held) == tasks and max(held) < len(rows) / 2
    plan = pair_counts(df)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(transaction_id" not in plan and "hashpartitioning(product_a" in plan and f", {tasks})" in plan


def best_by_brute_force(rows, k):
    want = brute_pairs(rows)
    partners = {}
    for (a, b), n in want.items():
        partners.setdefault(a, []).append((-n, b))
        partners.setdefault(b, []).append((-n, a))
    return [(*p, want[p]) for p in sorted(want, key=lambda p: (-want[p], p))[:k]], {(s, p, -n) for s, found in partners.items() for n, p in sorted(found)[:k]}


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("heavy, share", [(0, 0.6), (1, 0.6), (3, 0.9), (12, 0.6), (12, 1.0), (25, 0.5)])
def test_best_pairs_with_large_transactions(spark, monkeypatch, seed, heavy, share):
    """Large transactions are never listed, yet the best pairs and partners are the brute-force ones."""
    rnd = random.Random(seed)
    rows = [(t, p) for t in range(heavy) for p in range(40) if rnd.random() < share]
    rows += [(100 + rnd.randrange(60), rnd.randrange(40)) for _ in range(150 + 50 * seed)]
    df = spark.createDataFrame(rows, "transaction_id long, product_id long")
    listed = []
    listing = baskets.basket_pairs
    monkeypatch.setattr(baskets, "basket_pairs", lambda items, hot=None: listed.append(items) or listing(items, hot))
    for k in (1, 5):
        pairs, partners = best_by_brute_force(rows, k)
        got = baskets.best_pairs(df, k, large=15).select("product_a", "product_b", "co_purchase_count").collect()
        assert [tuple(r) for r in got] == pairs
        assert not listed[-1].groupBy("transaction_id").count().filter("count > 15").count()
        got = baskets.best_partners(df, k, large=15).select("source_product", "recommended_product", "co_purchase_count")
        assert {tuple(r) for r in got.collect()} == partners
        assert not listed[-1].groupBy("transaction_id").count().filter("count > 15").count()
        assert share < 1 or not listed[-1].filter(F.col("transaction_id") < 100).count()


def test_rare_products_drop_out_before_pairs_are_listed(spark, monkeypatch):
    rnd = random.Random(3)
    rows = [(t, int(rnd.paretovariate(0.7))) for t in range(300) for _ in range(12)]
    df = spark.createDataFrame([r for r in rows if r[1] < 5000], "transaction_id long, product_id long")
    rows = [tuple(r) for r in df.collect()]
    listed = []
    listing = baskets.basket_pairs
    monkeypatch.setattr(baskets, "basket_pairs", lambda items, hot=None: listed.append(items) or listing(items, hot))
    got = baskets.best_pairs(df, 5)
    assert [tuple(r) for r in got.select("product_a", "product_b", "co_purchase_count").collect()] == best_by_brute_force(rows, 5)[0]
    size = lambda items: items.groupBy("transaction_id").count().selectExpr("sum(count * (count - 1) / 2)").first()[0]
    assert size(listed[-1]) < size(df.distinct()) / 2


def test_transitions_across_chunks(spark):
    rnd = random.Random(2)
    rows = [("hot" if i % 3 else f"s{rnd.randrange(40)}", i, rnd.choice("abc")) for i in range(6000)]
    df = spark.createDataFrame(rows, "session string, pos long, page string")
    by_session = {}
    for s, _, p in rows:
        by_session.setdefault(s, []).append(p)
    want = Counter(pair for pages in by_session.values() for pair in zip(pages, pages[1:]))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(r[0], r[1]): r[2] for r in transition_counts(df, "session", ["pos"], "page").collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == dict(want)


def test_transitions_leave_two_rows_a_chunk(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice([None, *(f"s{i}" for i in range(900))]), i, rnd.choice(["a", "b", None])) for i in range(4000)]
    df = spark.createDataFrame(rows, "session string, pos long, page string")
    by_session = {}
    for s, _, p in rows:
        by_session.setdefault(s, []).append(p)
    want = Counter(pair for pages in by_session.values() for pair in zip(pages, pages[1:]))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ends = chunk_records(df, "session", ["pos"], "page").filter(F.col("side") != adjacency.STEP).collect()
        got = {(r[0], r[1]): r[2] for r in transition_counts(df, "session", ["pos"], "page").collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    chunks = {r["chunk"] for r in ends}
    assert 1 < len(chunks) <= 4 and len(ends) == 2 * len(chunks) and all(r["n"] == 1 for r in ends)
    assert got == dict(want)
    assert transition_counts(df.filter("false"), "session", ["pos"], "page").count() == 0
    one = df.filter("pos = 5")
    assert transition_counts(one, "session", ["pos"], "page").count() == 0


@pytest.mark.parametrize("n", [1, 2, 7, 30000])
def test_quantiles(spark, n):
    rnd = np.random.default_rng(n)
    values = np.round(rnd.exponential(100, n), 2)
    groups = ["a" if i % 3 else "b" for i in range(n)]
    df = spark.createDataFrame([(g, float(v)) for g, v in zip(groups, values)] + [("a", None)], "g string, v double")
    for r in summary_by(df, "v", "g", extra={"rows": F.count("*")}).collect():
        mine = values[[g == r["g"] for g in groups]]
        assert r["n"] == len(mine) and r["min"] == mine.min() and r["max"] == mine.max()
        assert r["rows"] == len(mine) + (r["g"] == "a")
        assert [r["q25"], r["q50"], r["q75"]] == pytest.approx(np.quantile(mine, [0.25, 0.5, 0.75]), abs=0.0051)
    whole = summary_by(df, "v").first()
    assert whole["q50"] == pytest.approx(np.quantile(values, 0.5), abs=0.0051)


def test_quantiles_of_one_repeated_value(spark):
    row = summary_by(spark.range(20000).select(F.lit(5.0).alias("v")), "v").first()
    assert (row["n"], row["q25"], row["q75"]) == (20000, 5.0, 5.0)


def test_ranking_ties(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 1), ("a", "z", 2), ("b", "y", 1)], "g string, v string, n long")
    assert [r["v"] for r in top_k(df, "n", 2, ["g", "v"]).collect()] == ["z", "x"]
    assert sorted(r["v"] for r in top_k_per_group(df, "g", "n", 2, ["v"]).collect()) == ["x", "y", "z"]


def test_sizing_follows_the_shuffle():
    from basketry.session import sizing

    assert sizing(1 << 30)["spark.sql.shuffle.partitions"] == "200"
    assert sizing(1 << 40)["spark.sql.shuffle.partitions"] == "4096"
    big = sizing(100 << 40)
    assert big["spark.sql.shuffle.partitions"] == "32000" and int(big["spark.sql.adaptive.advisoryPartitionSizeInBytes"]) > 3 << 30
