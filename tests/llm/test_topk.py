import math
import random

import pytest

from basketry.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, step=50, k=5):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    asked = set()
    for q, a in good:
        if q % step == 0 and (q, tuple(a)) not in asked:
            asked.add((q, tuple(a)))
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q and len(a) == len(b))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [(512, 16, 1024), (8, 2, 3), (1, 1, 1)])
def test_top_k_matches_brute_force(spark, monkeypatch, sizes):
    for name, n in zip(("BLOCK", "CELL_BLOCKS", "CELL_QUERIES"), sizes):
        monkeypatch.setattr(topk, name, n)
    rnd = random.Random(1)
    rows = [(i, [rnd.choice([-1.0, -0.5, 0.0, 0.25, 1.0]) for _ in range(6)]) for i in range(260)]
    rows += [(i, [1.0] * 6) for i in range(260, 330)] + [(400, [0.5] * 3), (401, [0.25] * 3), (450, [])]
    rows += [(500, None), (None, [1.0] * 6), (550, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (600, [float("nan")] * 6), (650, [float("inf")] * 6), (-50, [-1.0] * 6)]
    rows += [(100, [0.25, 0.5, 1.0, -1.0, 0.0, 0.5])] * (300 if sizes[0] > 1 else 3) + [(150, [1.0] * 6)] * 2  # queries that stand several times
    rows = [(i, v) for i, v in rows if sizes != (1, 1, 1) or i is None or i < 120 or i in (400, 401)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    assert sorted(map(tuple, topk.top_k(df).collect())) == brute(rows)


def test_empty_and_large_numbers(spark):
    assert topk.top_k(spark.createDataFrame([], SCHEMA)).count() == 0
    big = [(i, [2.0**19 * (i % 7 + 1), 2.0**21, -float(i)]) for i in (0, 1, 2, 3, 50)]
    df = spark.createDataFrame([(i, v, 0) for i, v in big], SCHEMA)
    assert sorted(map(tuple, topk.top_k(df).collect())) == brute(big)
    huge = spark.createDataFrame([(i, [3e12 * (-1) ** i] * 6, 0) for i in range(4)], SCHEMA)
    assert [tuple(r) for r in topk.top_k(huge).orderBy("rank").collect()] == [(0, 1, 2, 2**63 - 1), (0, 2, 1, -(2**63)), (0, 3, 3, -(2**63))]
