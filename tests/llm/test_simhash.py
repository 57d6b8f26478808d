import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from basketry.llm import graph, simhash
from tests.llm.conftest import AWKWARD, prose


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + n]), 42) for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    prints = [brute_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 2 and group[i] != group[j]:
                group = [group[j] if g == group[i] else g for g in group]
    least = {g: min((rows[i][0] for i in range(len(rows)) if group[i] == g and rows[i][0] is not None), default=None) for g in group}
    return sorted(((d, f"{p:016x}", least[g]) for (d, _), p, g in zip(rows, prints, group)), key=str)


def test_components_match_brute_force(docs, spark, small):
    base = prose(1, 300).split()
    near = [" ".join(base[:k] + ["changed"] + base[k + 1:]) for k in range(0, 300, 15)]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate([" ".join(base), *near, prose(9, 40), prose(9, 40).upper(), "two words"])] + AWKWARD
    got = sorted(map(tuple, simhash.near_duplicates(docs(rows, ("fingerprint", "fp"))).collect()), key=str)
    assert got == brute([(r[0], r[1]) for r in rows])
    table = spark.read.parquet(f"{small}/documents.parquet")
    got = sorted(map(tuple, simhash.near_duplicates(table).collect()), key=str)
    assert got == brute([(r["doc_id"], r["text"]) for r in table.collect()])


def test_links_find_every_pair_within_the_radius(spark):
    rnd = random.Random(3)
    seeds = [rnd.getrandbits(64) for _ in range(20)]
    prints = {s ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 4))) for s in seeds for _ in range(12)} | {0, 1, 1 << 63}
    signed = [int(np.uint64(p).astype(np.int64)) for p in prints]
    linked = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"))
    got = {r["node"]: r["root"] for r in graph.components(linked).collect()}
    group = {p: p for p in prints}
    for a in prints:
        for b in prints:
            if bin(a ^ b).count("1") <= 2 and group[a] != group[b]:
                old, new = group[a], group[b]
                group = {k: new if g == old else g for k, g in group.items()}
    to = {p: int(np.uint64(p).astype(np.int64)) for p in prints}
    for a in prints:
        for b in prints:
            assert (got.get(to[a], to[a]) == got.get(to[b], to[b])) == (group[a] == group[b])


def test_long_chain_has_one_root(spark):
    chain = spark.range(40).select((F.col("id") * 37 % 41).alias("a"), ((F.col("id") + 1) * 37 % 41).alias("b"))
    assert {r["root"] for r in graph.components(chain).collect()} == {0}
    assert graph.components(chain.filter("a < 0")).count() == 0


def test_one_row_of_each_group_stays(docs, awkward, empty):
    rows = [(i, prose(1 if i < 5 else i, 80), "en", "s", i) for i in range(3, 9)]
    out = simhash.keep_one(docs(rows, ("_id", "component_id")))
    assert sorted(r["doc_id"] for r in out.collect()) == [3, 5, 6, 7, 8] and out.columns[:2] == ["doc_id", "text"]
    kept = simhash.keep_one(awkward).collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == [1, 4, 5, 6, 8, 9]
    assert simhash.keep_one(empty).count() == simhash.near_duplicates(empty).count() == 0


def test_rows_without_id_and_repeated_ids_stay_apart(docs):
    rows = [(None, prose(1, 80), "en", "s", 0), (None, prose(2, 80), "en", "s", 0), (7, prose(3, 80), "en", "s", 0), (7, prose(4, 80), "en", "s", 0),
            (5, prose(6, 80), "en", "s", 0), (None, prose(6, 80), "de", "s", 0), (None, prose(2, 80), "en", "s", 0)]
    out = simhash.keep_one(docs(rows, ("_none", "fp", "root"))).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in out) == sorted((str(r[0]), r[1]) for r in rows[:5])
