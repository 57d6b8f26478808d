import math

import pytest
from pyspark.sql import functions as F

from basketry.llm import mixing
from tests.llm.conftest import AWKWARD, prose


def brute_targets(sizes, weights=(3, 1, 2), budget=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = {}, set(names), budget * sum(sizes.values())
    while free:
        total = sum(weight[s] for s in free)
        full = {s for s in free if left * weight[s] / total > most * sizes[s]}
        if not full:
            return target | {s: left * weight[s] / total for s in free}
        for s in full:
            target[s] = most * sizes[s]
        left -= sum(target[s] for s in full)
        free -= full
    return target


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, None: 30}, {"a": 0, "b": 10}, {"a": 1, "b": 1000, "c": 5, "d": 700, "é": 3, "Z": 40}, {"a": 0}, {}])
def test_targets(spark, sizes):
    got = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"))
    want = brute_targets(sizes)
    for r in got.collect():
        assert r["target"] == pytest.approx(want[r["source"]], rel=1e-12, abs=1e-12)
    assert got.count() == len(sizes)


def many(docs):
    return docs([(i, prose(i, 5 + i * i % 211), "en", f"s{i % 7 if i % 3 else 0}", 0) for i in range(600)])


def test_rates_tilt_exponentially_and_meet_the_targets(docs):
    rows = mixing.mix(many(docs)).collect()
    source = {i: f"s{i % 7 if i % 3 else 0}" for i in range(600)}
    for name in set(source.values()):
        own = [r for r in rows if source[r["doc_id"]] == name]
        target = own[0]["target"]
        assert sum(r["rate"] * r["size"] for r in own) == pytest.approx(target, rel=1e-4)
        assert abs(sum(r["taken"] for r in own) - target) <= 0.01 * target
        # log odds of the rate against 2 are proportional to the size
        tilts = {round(math.log(r["rate"] / (2 - r["rate"])) / r["size"], 6) for r in own if 1e-3 < r["rate"] < 1.999}
        assert len(tilts) <= 1
        assert all(r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 2 and abs(r["copies"] - r["rate"]) < 1 for r in own)
        assert own[0]["source_size"] == sum(r["size"] for r in own)


def test_reruns_agree_whatever_the_partitions(docs, spark):
    first = sorted(map(tuple, mixing.mix(many(docs)).collect()))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert sorted(map(tuple, mixing.mix(many(docs).repartition(5)).collect())) == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_mixed_repeats_rows(docs, awkward, empty):
    table = many(docs)
    taken = {r["doc_id"]: r["copies"] for r in mixing.mix(table).collect()}
    counts = {r["doc_id"]: r["count"] for r in mixing.mixed(table).groupBy("doc_id").count().collect()}
    assert counts == {d: n for d, n in taken.items() if n}
    out = mixing.mixed(awkward)
    assert out.columns == awkward.columns and out.filter(F.col("text").isNull()).count() == 2
    assert mixing.mix(awkward).count() == len(AWKWARD)
    assert mixing.mix(empty).count() == mixing.mixed(empty).count() == 0


@pytest.mark.parametrize("ids", [None, 3])
def test_many_equal_rows_meet_the_target(docs, ids):
    rows = [(ids, prose(1, 40), "en", "b", 0)] * 2500 + [(i, prose(i, 30), "en", "a", 0) for i in range(300)]
    table = docs(rows)
    found = mixing.mix(table).collect()
    assert len(found) == len(rows)
    taken, target = {}, {}
    for r in found:
        taken[r["source_size"]] = taken.get(r["source_size"], 0) + r["taken"]
        target[r["source_size"]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 40 for s in taken) and all(0 <= r["copies"] <= 2 for r in found)
    copies = sum(r["copies"] for r in found if r["size"] == 40)
    assert mixing.mixed(table).filter("source = 'b'").count() == copies and 0 < copies % 2500


def test_targets_that_are_not_met_are_an_error(docs, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_STEPS", 1)
    with pytest.raises(RuntimeError):
        mixing.mix(many(docs))
