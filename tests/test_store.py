"""Versions of results, and the bucketed store."""

import posixpath

import pytest

from basketry.operators.joins import find_hot_keys
from basketry.plans import etl, lookup
from basketry.session import folders, scratch_path
from basketry.sources import results
from basketry.sources.star import StarRetail
from basketry.sources.store import Layout, Store, hot_join


def values(df):
    return sorted(r[0] for r in df.collect())


def test_a_reader_finishes_on_the_version_it_began_with(spark, tmp_path):
    path = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        results.load_results(spark, path, ["a"])
    results.materialise({"a": spark.range(3), "b": spark.range(1)}, path)
    began = results.load_results(spark, path, ["a"])["a"]
    results.materialise({"a": spark.range(5), "b": spark.range(2)}, path)
    assert values(began) == [0, 1, 2] and results.load_results(spark, path, ["b"])["b"].count() == 2
    results.materialise({"a": spark.range(7), "b": spark.range(2)}, path)
    assert len(folders(spark, posixpath.join(path, "versions"))) == 2
    assert values(results.load_results(spark, path, ["a"])["a"]) == list(range(7))


def test_an_aborted_write_changes_nothing_and_leaves_nothing(spark, tmp_path):
    path = str(tmp_path)
    results.materialise({"a": spark.range(3)}, path)
    with pytest.raises(Exception):
        results.materialise({"a": spark.range(9), "b": spark.range(3).selectExpr("raise_error('stop') AS x")}, path)
    assert values(results.load_results(spark, path, ["a"])["a"]) == [0, 1, 2]
    results.materialise({"a": spark.range(4)}, path, keep=1)
    assert len(folders(spark, posixpath.join(path, "versions"))) == 1


@pytest.fixture(scope="module")
def retail(spark):
    return StarRetail(spark, "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def store(spark, retail, tmp_path_factory):
    made = Store(spark, str(tmp_path_factory.mktemp("store")), etl.store_layouts(retail), 8)
    tables = etl.store_tables(retail)
    for _ in range(2):
        made.write({name: tables[name] for name in ("lines", "transactions", "sessions", "product_metrics")})
    return made


def plan(df):
    df.collect()
    return df._jdf.queryExecution().toString()


def test_lines_meet_their_transaction_without_a_shuffle(spark, store, retail):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = plan(etl.stored_txn_lines(store, retail.product_dim()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    physical = got[got.index("== Physical Plan =="):]
    assert "SortMergeJoin [transaction_id" in physical and "hashpartitioning(transaction_id" not in physical
    assert got[got.index("== Optimized Logical Plan =="):got.index("== Physical Plan ==")].count("store_lines") <= 1


def test_a_key_read_opens_the_files_of_one_bucket(spark, retail, tmp_path):
    """The files of all other buckets are spoilt, and the read does not notice."""
    made = Store(spark, str(tmp_path), etl.store_layouts(retail), 8)
    tables = etl.store_tables(retail)
    made.write({name: tables[name] for name in ("sessions", "product_metrics")})
    reads = {"sessions": lambda t: lookup.bucketed_user_sessions(t, 7), "product_metrics": lambda t: lookup.product_metrics_for(t, 42)}
    for name, read in reads.items():
        want = read(tables[name]).collect()
        own = {posixpath.basename(r[0]) for r in made.read(name).filter("user_id = 7" if name == "sessions" else "product_id = 42").selectExpr("input_file_name()").collect()}
        files = [f for f in tmp_path.rglob("part-*.parquet") if f.parent.name == name]
        spoilt = [f for f in files if f.name not in own]
        assert len(own) == 1 and len(spoilt) >= 5
        for f in spoilt:
            f.write_bytes(b"spoilt")
        assert want and read(made.read(name)).collect() == want
        with pytest.raises(Exception):
            made.read(name).selectExpr("count(DISTINCT struct(*))").collect()


def test_another_session_finds_the_buckets(spark, store):
    again = Store(spark.newSession(), store.path, store.layouts, 8)
    assert again.read("lines").count() == store.read("lines").count()


def test_frequent_keys_are_dealt_and_joined_apart(spark):
    fact = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN -1 ELSE id % 50 END AS k", "id AS v")
    dim = fact.selectExpr("k", "k * 2 AS w").distinct()
    hot = find_hot_keys(fact, "k", 0.2)
    made = Store(spark, scratch_path(spark, "test"), {"fact": Layout("k", ("v",), hot), "dim": Layout("k")}, 4)
    made.write({"fact": fact, "dim": dim})
    got = hot_join(made.read("fact"), made.read("dim"), "k", hot)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, fact.join(dim, "k").collect()))
    files = made.read("fact").filter("k = -1").selectExpr("input_file_name()").distinct().count()
    assert set(hot.counts) == {-1} and files > 1


def test_buckets_follow_the_lines(retail):
    lines = retail.items.count()
    assert etl.store_buckets(retail, 8) == 8 and etl.store_buckets(retail, 8, 500) == -(-lines // 500) > 8
