import math

import numpy as np
import pyarrow as pa
import pytest

from basketry.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, step=100, k=10):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, a in good:
        if q % step == 0:
            far = sorted((float(np.sqrt(((a - b) ** 2).sum())), i) for i, b in good if i != q and len(a) == len(b))[:k]
            out[q, tuple(a)] = [(q, n + 1, i, s) for n, (s, i) in enumerate(far)]
    return sorted(r for found in out.values() for r in found)


def recall(got, want):
    hits = {(r[0], r[2]) for r in got}
    return sum((q, i) in hits for q, _, i, _ in want) / max(1, len(want))


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in rows], SCHEMA)


def vectors(seed, n, groups=0, dim=16):
    rnd = np.random.default_rng(seed)
    out = rnd.normal(0, 1, (n, dim))
    return (out * 0.2 + rnd.normal(0, 1, (groups, dim))[rnd.integers(0, groups, n)] if groups else out).astype(np.float32).tolist()


@pytest.mark.parametrize("groups", [0, 30])
def test_recall_and_exact_scores(spark, monkeypatch, groups):
    for name, n in (("LIST_ROWS", 40), ("BLOCK", 16), ("ASKED", 7), ("CELLS", 512)):
        monkeypatch.setattr(ann, name, n)
    rows = list(enumerate(vectors(1, 3000, groups)))
    got, want = sorted(map(tuple, ann.nearest(table(spark, rows)).collect())), brute(rows)
    assert len(got) == len(want) == 300 and recall(got, want) >= 0.9
    at = dict(rows)
    for q, rank, i, score in got:
        assert score == pytest.approx(math.dist(at[q], at[i]), rel=1e-12)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    for a, b in zip(got, got[1:]):
        assert a[0] != b[0] or (a[3], a[2]) < (b[3], b[2])


def test_awkward_rows_are_exact(spark):
    rows = list(enumerate(vectors(2, 120, dim=4)))
    rows += [(i, [1.0, 0, 0, 0]) for i in range(200, 260)] + [(300, [1.0, 0, 0, 0])] * 40 + [(301, [1.0, 0, 0, 0])] * 12 + [(400, [0.5, 1.0])] * 3 + [(401, [2.0, 1.0]), (500, [7.0] * 3)]
    rows += [(600, None), (None, [1.0] * 4), (700, [1.0, None, 0, 0]), (800, [float("nan")] * 4), (900, [float("inf")] * 4), (1000, [0.0] * 4), (1100, []), (-100, [-1.0] * 4), (0, [9.0] * 4)]
    assert sorted(map(tuple, ann.nearest(table(spark, rows)).collect())) == brute(rows)
    assert ann.nearest(table(spark, [])).count() == 0
    assert ann.nearest(table(spark, [(0, [1.0])])).count() == 0


def test_one_vector_with_most_rows(spark, monkeypatch):
    monkeypatch.setattr(ann, "LIST_ROWS", 20)
    rows = list(enumerate(vectors(3, 200))) + [(i, [1.0] * 16) for i in range(200, 700)]
    got, want = sorted(map(tuple, ann.nearest(table(spark, rows)).collect())), brute(rows)
    assert recall(got, want) >= 0.9
    assert [r for r in got if r[0] == 600] == [r for r in want if r[0] == 600]


def test_boundary_vectors_have_copies_and_every_list_is_found():
    points = np.array(vectors(4, 2000))
    index = ann.fit(points, 50)
    p, lists = index.homes(points)
    each = np.bincount(p, minlength=len(points))
    assert each.min() == 1 and each.max() == ann.MOST_COPIES and len(set(zip(p, lists))) == len(p)
    exact = ann.distances(points, index.centroids)
    assert (exact.argmin(axis=1)[:, None] == np.array([lists[p == i][0] for i in range(2000)])[:, None]).mean() > 0.99
    q, read = index.read(points[:50])
    want = exact[:50] <= index.ratio * exact[:50].min(axis=1, keepdims=True)
    assert len(q) >= 0.99 * want.sum()


def test_registered_query(spark, small):
    from basketry.llm import queries
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    got = sorted(map(tuple, queries.QUERIES["op13_neighbours"](spark, small).collect()))
    assert recall(got, brute(rows)) >= 0.9


def test_rows_between_the_steps_hold_one_vector(spark, monkeypatch):
    """Blocks of entries or chunks of queries as rows made a reader hold thousands of them at once."""
    tables, written = {}, ann.written
    monkeypatch.setattr(ann, "written", lambda df, name: tables.setdefault(name, written(df, name)))
    rows = list(enumerate(vectors(5, 1200)))
    assert recall(map(tuple, ann.nearest(table(spark, rows)).collect()), brute(rows)) >= 0.9
    assert len(tables) > 3
    for df in tables.values():
        assert not [c for c, kind in df.dtypes if "array<struct" in kind or "array<array" in kind]


def test_shelves_and_their_queries_are_bounded(spark, monkeypatch):
    """Long lists, a length that the sample lacks and many queries: same rows, and no task holds more than it may."""
    rows = list(enumerate(vectors(6, 1500, 12))) + [(i, [1.0, i + 1.0]) for i in range(2000, 2400)] + [(i, [float(i % 7)] * 3) for i in range(3000, 3100)]
    whole = sorted(map(tuple, ann.nearest(table(spark, rows), 3).collect()))
    assert recall(whole, brute(rows, 3)) >= 0.9
    for name, n in (("BLOCK", 16), ("ASKED", 7), ("SHELVES", 10000), ("SHELF", 40 * 32), ("MOST_ASKED", 30 * 32), ("CELLS", 4096)):
        monkeypatch.setattr(ann, name, n)
    fit_indexes, sent = ann.fit_indexes, {}
    monkeypatch.setattr(ann, "fit_indexes", lambda distinct: {dim: index for dim, index in fit_indexes(distinct).items() if dim != 2})
    for step in ("on_shelves", "cells_of"):
        monkeypatch.setattr(ann, step, lambda *a, step=step, own=getattr(ann, step): sent.setdefault(step, own(*a)))
    assert sorted(map(tuple, ann.nearest(table(spark, rows), 3).collect())) == whole
    held = {tuple(r[:2]): r[2] for r in sent["on_shelves"].groupBy("dim", "shelf").count().collect()}
    assert max(held.values()) <= 80 and len([k for k in held if k[0] == 2]) > 3
    assert max(r["parts"] for r in sent["cells_of"].collect()) > 1


def test_packed_lists():
    first, of = ann.packed([3, 4, 25, 0, 2, 10, 1], 10)
    assert (first.tolist(), of.tolist()) == ([0, 0, 1, 4, 4, 5, 6], [1, 1, 3, 1, 1, 1, 1])


@pytest.mark.parametrize("cut", [1, 3, 1000])
def test_cells_meet_their_queries_whatever_the_batches(cut):
    """Against plain loops: vectors in several lists, lists that are not read, cells without entries, equal distances."""
    rnd = np.random.default_rng(7)
    points = rnd.integers(0, 4, (40, 3)).astype(float).tolist()
    rows, want = [], []
    for cell in range(6):
        held = [(n, int(lists)) for n in range(40) for lists in rnd.choice(5, 2, replace=False)] if cell != 3 else []
        asks = [(100 + q, sorted(rnd.choice(6, 3, replace=False).tolist()), rnd.integers(0, 4, 3).astype(float).tolist()) for q in range(9 if cell != 4 else 0)]
        rows += [(cell, False, [one], n, n, -n, points[n]) for n, one in held] + [(cell, True, lists, q, cell, q, v) for q, lists, v in asks]
        for q, lists, v in asks:
            found = sorted({(math.dist(points[n], v), n) for n, one in held if one in lists})[:4]
            want += [(q, cell, q, n, -n, n, far) for far, n in found]
    kind = pa.schema([("cell", pa.int32()), ("asks", pa.bool_()), ("lists", pa.list_(pa.int32())), ("id", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("v", pa.list_(pa.float32()))])
    batches = pa.Table.from_pylist([dict(zip(kind.names, r)) for r in rows], kind).to_batches(max_chunksize=cut)
    got = [tuple(r.values()) for batch in ann.meet(iter(batches), 4) for r in batch.to_pylist()]
    assert [g[:6] for g in sorted(got)] == [w[:6] for w in sorted(want)]
    assert [g[6] for g in sorted(got)] == pytest.approx([w[6] for w in sorted(want)])
