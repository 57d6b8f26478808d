import zlib
from collections import defaultdict

import pytest

from basketry.llm import sharding
from tests.llm.conftest import AWKWARD, prose


def optimum(sizes, shards):
    def fits(c):
        used, at = 1, 0
        for s in sizes:
            if s > c:
                return False
            if at + s > c:
                used, at = used + 1, 0
            at += s
        return used <= shards
    low, high = 1, max(1, sum(sizes))
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if fits(mid) else (mid + 1, high)
    return low


def check(df, shards):
    rows = sharding.assign(df, shards).collect()
    key = {zlib.crc32((r["text"] or "").encode()): k["key"] for r, k in zip(df.collect(), df.select(sharding.group_key(df["text"]).alias("key")).collect())}
    groups, where, slots, total = defaultdict(int), {}, defaultdict(list), defaultdict(int)
    for r in rows:
        groups[key[r["text_crc32"]]] += r["size"]
        assert where.setdefault(r["text_crc32"], r["shard"]) == r["shard"] and 0 <= r["shard"] < shards
        assert r["law"] == "bytes" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
        total[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(total.values()) == optimum([groups[k] for k in sorted(groups)], shards)
    return rows


@pytest.mark.parametrize("bits", [(12, 8), (2, 1), (4, 3)])
def test_smallest_largest_shard(spark, docs, small, monkeypatch, bits):
    monkeypatch.setattr(sharding, "FIRST_BITS", bits[0])
    monkeypatch.setattr(sharding, "MORE_BITS", bits[1])
    check(spark.read.parquet(f"{small}/documents.parquet"), 24)
    hot = docs([(i, "the same" * 9 if i % 3 == 0 else prose(i, i % 50), "en", "s", 0) for i in range(300)])
    check(hot, 7)


def test_awkward_rows(awkward, empty):
    rows = check(awkward, 24)
    assert len(rows) == len(AWKWARD)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["size"] == 8 and by_id[1]["text_crc32"] == 0 and by_id[9]["size"] == len(AWKWARD[-1][1].encode()) + 8
    assert sharding.assign(empty).count() == 0


def test_write_makes_a_folder_per_shard(docs, spark, tmp_path):
    df = docs([(i, prose(i, 20), "en", "s", 0) for i in range(50)], ("size",))
    sharding.write(df, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 50 and {r[0] for r in back.select("shard").distinct().collect()} == {0, 1, 2, 3}
