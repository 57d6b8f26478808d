"""Approximate nearest neighbours over balanced posting lists.

A bounded sample is halved along the line between two means, at the median, until the parts are small: balanced
clusters, whose means are the centroids of the posting lists. Centroids are searched by an in-memory graph that links
each to its nearest ones. Every vector goes to the list of its nearest centroid and, near a boundary, is replicated
to up to ``MOST_COPIES`` that are about as near. A query reads the lists whose centroid is at most ``ratio`` times as
far as the nearest; the ratio is measured on the sample, so that ``RECALL`` of the true neighbours there lie in a list
that is read. On vectors without structure that is a large share of all lists. Distances are exact, on the original
vectors, in double precision.

All rows are indexed, equal vectors as one entry with its smallest ids; no more of them can be among the nearest.
Lists lie on shelves: neighbouring short lists share one, a long list is cut over several by a hash. A shelf meets its
queries in one task, or in several if they are many. The task holds the shelf, at most ``SHELF`` numbers or so, and the queries
pass by in batches, so neither a long list nor a popular one is ever held whole, and a query is sent once to a shelf, not to
each list. Sent to all tasks is the index of centroids alone, at most ``MOST_LISTS`` of them for each length of vector in the
sample, and which shelf each is on.

Nulls: vectors that are null, empty or zero, or hold a null or non-finite component, and rows without id, take no
part. Only vectors of equal length meet; a length that the sample does not hold has one list. Repeated rows are
candidates each, and a query that stands several times is asked once; a row with the query's id is never its own
result. Ties go to the smaller id. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from basketry.llm.common import written

K, QUERY_STEP = 10, 100
# The bound of what is fitted on the driver: vectors in the sample, lists, and sample queries that set the ratio.
SAMPLE, MOST_LISTS, TRIAL_QUERIES = 16384, 4096, 256
LIST_ROWS, RECALL, MOST_COPIES, CLOSE = 512, 0.97, 4, 1.05
LINKS, BEAM = 16, 8
# Entries of a shelf: BLOCK at least, and more if there would be over SHELVES shelves, up to SHELF numbers. Queries that meet a
# shelf in one task: ASKED at least, up to MOST_ASKED numbers. A row holds a vector and BESIDES. No more than MOST_TASKS tasks are asked for.
BLOCK, ASKED, BESIDES = 1024, 512, 16
SHELF, MOST_ASKED, SHELVES, MOST_TASKS = 1 << 22, 1 << 22, 64, 32000
SALTS = 64
CELLS = 1 << 20  # numbers in a matrix of distances
GROUP = 64  # distances of which the least stands for all


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Between all rows of two matrices, rounded."""
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T, 0))


def balanced_means(points: np.ndarray, lists: int, seed: int = 5) -> np.ndarray:
    """The means of about ``lists`` parts of equal size."""
    random, open_parts, means = np.random.default_rng(seed), [(points, lists)], []
    while open_parts:
        part, wanted = open_parts.pop()
        if wanted < 2 or len(part) < 4:
            means.append(part.mean(axis=0))
            continue
        pair = part[random.choice(len(part), 2, replace=False)]
        for _ in range(8):
            along = part @ (pair[1] - pair[0])
            high = along > np.median(along)
            if not high.any():
                break
            pair = np.stack([part[~high].mean(axis=0), part[high].mean(axis=0)])
        order = np.argsort(part @ (pair[1] - pair[0]), kind="stable")
        cut = len(part) * (wanted // 2) // wanted
        open_parts += [(part[order[:cut]], wanted // 2), (part[order[cut:]], wanted - wanted // 2)]
    return np.array(means)


def graph_of(centroids: np.ndarray, links: int = LINKS) -> np.ndarray:
    """Per centroid the numbers of its nearest others, and two on a ring through all, so that each can be reached."""
    n, rows = len(centroids), max(1, CELLS // len(centroids))
    ring = np.stack([np.roll(np.arange(n), 1), np.roll(np.arange(n), -1)], axis=1)
    out = [np.argsort(distances(centroids[s:s + rows], centroids), axis=1, kind="stable")[:, 1:links + 1] for s in range(0, n, rows)]
    return np.concatenate([np.concatenate(out), ring], axis=1)


@dataclass(frozen=True)
class Index:
    """Centroids of the lists, the graph between them, and how much farther than the nearest a list may lie."""

    centroids: np.ndarray
    graph: np.ndarray
    ratio: float

    def near(self, points: np.ndarray, ratio: float) -> np.ndarray:
        """Distances from points to centroids; infinite where the search in the graph did not come by.

        Every centroid found within the limit, or among the ``BEAM`` nearest so far, is asked for its links until none is left.
        """
        found, asked = np.full((len(points), len(self.centroids)), np.inf), np.zeros((len(points), len(self.centroids)), bool)
        starts = np.arange(0, len(self.centroids), max(1, len(self.centroids) // 8))
        found[:, starts] = distances(points, self.centroids[starts])
        width = min(BEAM, len(self.centroids)) - 1
        while True:
            limit = np.maximum(found.min(axis=1) * ratio, np.partition(found, width, axis=1)[:, width])
            p, c = np.nonzero((found <= limit[:, None]) & ~asked & np.isfinite(found))
            if not len(p):
                return found
            asked[p, c] = True
            seen = np.zeros_like(asked)
            seen[np.repeat(p, self.graph.shape[1]), self.graph[c].reshape(-1)] = True
            p, c = np.nonzero(seen & ~np.isfinite(found))
            step = max(1, CELLS // points.shape[1])
            for s in range(0, len(p), step):
                a, b = p[s:s + step], c[s:s + step]
                found[a, b] = np.sqrt(((points[a] - self.centroids[b]) ** 2).sum(axis=1))

    def slices(self, points: np.ndarray) -> Iterator[slice]:
        rows = max(1, CELLS // (len(self.centroids) + points.shape[1]))
        return (slice(s, s + rows) for s in range(0, len(points), rows))

    def homes(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (number of a point, its list): the nearest, and near a boundary others about as near."""
        rows, lists = [], []
        for s in self.slices(points):
            found = self.near(points[s], CLOSE)
            order = np.argsort(found, axis=1, kind="stable")[:, :MOST_COPIES]
            far = np.take_along_axis(found, order, axis=1)
            close = far <= CLOSE * far[:, :1]
            close[:, 0] = True
            p, k = np.nonzero(close)
            rows.append(p + s.start)
            lists.append(order[p, k])
        return np.concatenate([np.zeros(0, int), *rows]), np.concatenate([np.zeros(0, int), *lists])

    def read(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (number of a query, list to be read), pruned by the ratio of distances."""
        rows, lists = [], []
        for s in self.slices(points):
            found = self.near(points[s], self.ratio)
            p, c = np.nonzero(found <= self.ratio * found.min(axis=1, keepdims=True))
            rows.append(p + s.start)
            lists.append(c)
        return np.concatenate([np.zeros(0, int), *rows]), np.concatenate([np.zeros(0, int), *lists])


def fit(sample: np.ndarray, lists: int, k: int = K) -> Index:
    """An index from a sample, with the ratio that finds ``RECALL`` of the sample's own nearest neighbours."""
    centroids = balanced_means(sample, min(lists, MOST_LISTS, max(1, len(sample) // 4)))
    index = Index(centroids, graph_of(centroids), 1.0)
    p, home = index.homes(sample)
    order = np.argsort(p, kind="stable")
    bounds = np.searchsorted(p[order], np.arange(len(sample) + 1))
    needed = []
    for q in range(0, len(sample), max(1, len(sample) // TRIAL_QUERIES)):
        far = ((sample - sample[q]) ** 2).sum(axis=1)
        far[q] = np.inf
        to = np.sqrt(((centroids - sample[q]) ** 2).sum(axis=1))
        for n in np.argsort(far, kind="stable")[:min(k, len(sample) - 1)]:
            needed.append(to[home[order[bounds[n]:bounds[n + 1]]]].min() / max(to.min(), 1e-300))
    return Index(centroids, index.graph, float(np.quantile(needed, RECALL, method="higher")) * (1 + 1e-9) if needed else 1.0)


def entries(rows: DataFrame) -> DataFrame:
    """``vec_id, v, h1, h2``: the rows that take part, with a digest of the vector; components stay floats if they are."""
    v = F.transform("embedding", lambda c: c.cast("double"))
    good = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(v, lambda c: c != 0)
    kept = F.col("embedding").alias("v") if rows.schema["embedding"].dataType.elementType.typeName() == "float" else v.alias("v")
    return rows.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(good, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), kept, F.xxhash64(v).alias("h1"), F.xxhash64(F.lit(1), v).alias("h2"))


def copies(found: DataFrame, k: int = K) -> DataFrame:
    """``h1, h2, vec_id, n`` of each vector: its ``k + 1`` smallest ids, and how many rows have each."""
    counted = found.groupBy("h1", "h2", "vec_id").agg(F.count("*").alias("n")).withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)))
    for key in (["h1", "h2", "salt"], ["h1", "h2"]):  # a vector may have a third of all rows
        counted = counted.withColumn("at", F.row_number().over(Window.partitionBy(*key).orderBy("vec_id"))).filter(F.col("at") <= k + 1)
    return counted.select("h1", "h2", "vec_id", "n")


def fit_indexes(distinct: DataFrame) -> dict[int, Index]:
    """An index per length of vector, from a sample of about ``SAMPLE`` of the distinct vectors, chosen by digest."""
    total = distinct.count()
    parts = -(-total // SAMPLE)
    sample = distinct.filter(F.pmod("h2", F.lit(max(1, parts))) == 0).orderBy("h1", "h2").select("v").toArrow().combine_chunks()
    return {dim: fit(vectors_of(own.column("v")), -(-total * len(own) // (len(sample) * LIST_ROWS)))
            for batch in sample.to_batches() for dim, own in by_length(batch)}


def plain(column: pa.Array) -> np.ndarray:
    """Vectors of one length as a matrix, of floats if they are."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def vectors_of(column: pa.Array) -> np.ndarray:
    """Vectors of one length as a matrix."""
    return plain(column).astype(float, copy=False)


def by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    sizes = pc.list_value_length(batch.column("v")).to_numpy()
    for dim in np.unique(sizes).tolist():
        yield dim, batch.filter(pa.array(sizes == dim))


def kind(df: DataFrame) -> str:
    return df.schema["v"].dataType.simpleString()


def listed(starts: np.ndarray, values: np.ndarray) -> pa.ListArray:
    """Lists that begin at ``starts`` in ``values``."""
    return pa.ListArray.from_arrays(pa.array(np.append(starts, len(values)), pa.int32()), pa.array(values, pa.int32()))


def postings(distinct: DataFrame, shared) -> DataFrame:
    """``dim, lists`` and the columns of ``distinct``: every vector with its lists, the nearest first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, own in by_length(batch):
                rows = max(1, CELLS // dim)
                for part in (own.slice(s, rows) for s in range(0, len(own), rows)):
                    p, lists = np.arange(len(part)), np.zeros(len(part), int)
                    if dim in shared.value:
                        p, lists = Index(*shared.value[dim]).homes(vectors_of(part.column("v")))
                    order = np.argsort(p, kind="stable")
                    starts = np.searchsorted(p[order], np.arange(len(part)))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), dim), pa.int32()), listed(starts, lists[order]), *part.columns],
                                                     names=["dim", "lists", *part.schema.names])

    return distinct.select("id", "h1", "h2", "v").mapInArrow(run, f"dim int, lists array<int>, id long, h1 long, h2 long, v {kind(distinct)}")


def packed(sizes: list[int], most: int) -> tuple[np.ndarray, np.ndarray]:
    """Per list the number of its first shelf, and how many it has; only lists over ``most`` have several, and these alone."""
    first, of, shelf, held = [], [], 0, 0
    for n in sizes:
        if held and held + n > most:
            shelf, held = shelf + 1, 0
        first.append(shelf)
        of.append(max(1, -(-n // most)))
        shelf, held = (shelf, held + n) if of[-1] == 1 else (shelf + of[-1], 0)
    return np.array(first, int), np.array(of, int)


def shelves(placed: DataFrame, lists: dict[int, int]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """``packed`` for each length of vector. One that is not here has one list on one shelf.

    To the driver come the sizes of the lists of the sample's lengths (``lists``), and of others too long for a shelf.
    """
    most = F.greatest(F.lit(1), F.floor(F.lit(SHELF) / (F.col("dim") + BESIDES)))
    sizes = placed.select("dim", F.explode("lists").alias("list")).groupBy("dim", "list").agg(F.count("*").alias("n"))
    found: dict[int, dict[int, int]] = {dim: {} for dim in lists}
    for dim, number, n in sizes.filter(F.col("dim").isin(list(lists)) | (F.col("n") > most)).collect():
        found.setdefault(dim, {})[number] = n
    out = {}
    for dim, own in found.items():
        size = max(1, min(SHELF // (dim + BESIDES), max(BLOCK, -(-sum(own.values()) // SHELVES))))
        out[dim] = packed([own.get(i, 0) for i in range(lists.get(dim, 1))], size)
    return out


def on_shelves(placed: DataFrame, plan: dict[int, tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """``dim, shelf, lists, id, h1, h2, v``: an entry for every list of every vector."""
    rows = [(dim, number, int(first), int(of)) for dim, own in plan.items() for number, (first, of) in enumerate(zip(*own))]
    known = placed.sparkSession.createDataFrame(rows, "dim int, list int, first int, of int")
    each = placed.withColumn("list", F.explode("lists")).join(F.broadcast(known), ["dim", "list"], "left")
    piece = F.pmod(F.xxhash64("h1", "h2"), F.coalesce("of", F.lit(1))).cast("int")
    return each.select("dim", (F.coalesce("first", F.lit(0)) + piece).alias("shelf"), F.array("list").alias("lists"), "id", "h1", "h2", "v")


def questions(asked: DataFrame, shared, plan, count: int) -> DataFrame:
    """``dim, shelf, lists, id, h1, h2, v``: every query for each shelf it reads, with the lists there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, own in by_length(batch):
                first, of = plan.value.get(dim, (np.zeros(1, int), np.ones(1, int)))
                for start in range(0, len(own), ASKED):
                    part = own.slice(start, ASKED)
                    p, lists = np.arange(len(part)), np.zeros(len(part), int)
                    if dim in shared.value:
                        p, lists = Index(*shared.value[dim]).read(vectors_of(part.column("v")))
                    each = np.repeat(np.arange(len(p)), of[lists])
                    ends = np.cumsum(of[lists])
                    shelf = first[lists[each]] + np.arange(len(each)) - (ends - of[lists])[each]
                    p, lists = p[each], lists[each]
                    new = np.flatnonzero(np.append(True, (p[1:] != p[:-1]) | (shelf[1:] != shelf[:-1])))
                    bounds, rows = np.append(new, len(p)), max(1, CELLS // dim)
                    for s in range(0, len(new), rows):
                        at = new[s:s + rows]
                        own_lists = listed(at - at[0], lists[at[0]:bounds[min(s + rows, len(new))]])
                        taken = part.take(pa.array(p[at]))
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), dim), pa.int32()), pa.array(shelf[at], pa.int32()), own_lists, *taken.columns],
                                                         names=["dim", "shelf", "lists", *taken.schema.names])

    dealt = asked.select("id", "h1", "h2", "v").repartition(max(1, -(-count // ASKED)), "h1", "id")
    return dealt.mapInArrow(run, f"dim int, shelf int, lists array<int>, id long, h1 long, h2 long, v {kind(asked)}")


class Shelf:
    """The entries of a shelf, list by list."""

    def __init__(self, batches: list[pa.RecordBatch]):
        lists = np.concatenate([b.column("lists").flatten().to_numpy() for b in batches])
        least, h1, h2 = (np.concatenate([b.column(c).to_numpy() for b in batches]) for c in ("id", "h1", "h2"))
        order = np.argsort(lists, kind="stable")
        self.numbers, starts, self.list_of = np.unique(lists[order], return_index=True, return_inverse=True)
        self.bounds = np.append(starts, len(lists))
        self.least, self.h1, self.h2 = least[order], h1[order], h2[order]
        place, start = np.empty(len(lists), int), 0
        place[order] = np.arange(len(lists))
        self.matrix = np.empty((len(lists), len(batches[0].column("v")[0])))
        for batch in batches:
            self.matrix[place[start:start + len(batch)]] = plain(batch.column("v"))
            start += len(batch)
        self.squares = (self.matrix * self.matrix).sum(1)
        by_vector = np.lexsort((self.h2, self.h1))
        new = np.append(True, (np.diff(self.h1[by_vector]) != 0) | (np.diff(self.h2[by_vector]) != 0))
        self.vector = np.empty(len(lists), int)
        self.vector[by_vector] = np.cumsum(new)
        self.most = int(np.bincount(self.vector).max())  # lists here that hold the same vector

    def rough(self, queries: np.ndarray, reads: np.ndarray) -> np.ndarray:
        """Rounded squares of distances but for a summand of each query; infinite where a list is not read."""
        out = np.full((len(queries), -(-len(self.matrix) // GROUP) * GROUP), np.inf)
        for n, (s, e) in enumerate(zip(self.bounds, self.bounds[1:])):
            who = np.flatnonzero(reads[:, n])
            if len(who):
                out[slice(None) if len(who) == len(queries) else who, s:e] = self.squares[s:e] - 2 * queries[who] @ self.matrix[s:e].T
        return out

    def possible(self, queries: np.ndarray, reads: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, entry) among which are the ``k`` nearest vectors of each query, as far as the rounded squares tell."""
        rough = self.rough(queries, reads)
        least, wanted = rough.reshape(len(queries), -1, GROUP).min(axis=2), k * self.most
        bound = np.partition(least, wanted - 1, axis=1)[:, wanted - 1] if wanted < least.shape[1] else np.full(len(queries), np.inf)
        error = 8 * queries.shape[1] * np.finfo(float).eps * (self.squares.max() + (queries * queries).sum(1))
        q, e = np.divmod(np.flatnonzero(~(rough > (bound + 2 * error)[:, None])), rough.shape[1])
        q, e = q[e < len(self.matrix)], e[e < len(self.matrix)]
        read = reads[q, self.list_of[e]]
        return q[read], e[read]

    def nearest(self, queries: np.ndarray, reads: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each query the ``k`` nearest vectors, by exact distance and then the smaller id: its number, the entry, the distance."""
        q, e = self.possible(queries, reads, k)
        far, rows = np.empty(len(q)), max(1, CELLS // queries.shape[1])
        for s in range(0, len(q), rows):
            far[s:s + rows] = np.sqrt(((self.matrix[e[s:s + rows]] - queries[q[s:s + rows]]) ** 2).sum(axis=1))
        order = np.lexsort((self.vector[e], self.least[e], far, q))
        q, e, far = q[order], e[order], far[order]
        once = np.append(True, (np.diff(q) != 0) | (np.diff(self.vector[e]) != 0))[:len(q)]
        q, e, far = q[once], e[once], far[once]
        kept = np.arange(len(q)) - np.searchsorted(q, q) < k
        return q[kept], e[kept], far[kept]

    def answers(self, asked: pa.RecordBatch, k: int) -> Iterator[pa.RecordBatch]:
        own = asked.column("lists")
        lists = own.flatten().to_numpy()
        at = np.minimum(np.searchsorted(self.numbers, lists), len(self.numbers) - 1)
        here = self.numbers[at] == lists
        reads = np.zeros((len(asked), len(self.numbers)), bool)
        reads[np.repeat(np.arange(len(asked)), pc.list_value_length(own).to_numpy())[here], at[here]] = True
        rows = max(1, CELLS // len(self.matrix))
        for start in range(0, len(asked), rows):
            part = asked.slice(start, rows)
            q, e, far = self.nearest(vectors_of(part.column("v")), reads[start:start + rows], k)
            one = part.take(pa.array(q))
            yield pa.RecordBatch.from_arrays([one.column("id"), one.column("h1"), one.column("h2"), pa.array(self.h1[e]), pa.array(self.h2[e]), pa.array(self.least[e]),
                                              pa.array(far)], names=["query_id", "q1", "q2", "h1", "h2", "least", "score"])


def meet(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The ``k`` nearest entries for each query of each cell. Rows come cell by cell, a cell's entries before its queries."""
    cell, held, shelf = None, [], None
    for batch in batches:
        cells, asks = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "asks"))
        cuts = np.flatnonzero((np.diff(cells) != 0) | (np.diff(asks.astype(int)) != 0)) + 1
        for s, e in zip([0, *cuts], [*cuts, len(batch)]):
            if s == e:
                continue
            if cells[s] != cell:
                cell, held, shelf = cells[s], [], None
            if not asks[s]:
                held.append(batch.slice(s, e - s))
                continue
            if held:
                shelf, held = Shelf(held), []
            if shelf:
                yield from shelf.answers(batch.slice(s, e - s), k)


def cells_of(asked: DataFrame) -> DataFrame:
    """``dim, shelf, first, parts``: the numbers of the cells of each shelf that is read, one for each part of its queries."""
    most = F.greatest(F.lit(ASKED), F.floor(F.lit(MOST_ASKED) / (F.col("dim") + BESIDES)))
    parts = asked.groupBy("dim", "shelf").agg(F.count("*").alias("n")).select("dim", "shelf", F.ceil(F.col("n") / most).cast("int").alias("parts"))
    before = F.sum("parts").over(Window.orderBy("dim", "shelf").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("parts")
    return parts.withColumn("first", before.cast("int"))  # the window has a row for each shelf


def nearest(rows: DataFrame, step: int = QUERY_STEP, k: int = K) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id is divisible by ``step`` its ``k`` nearest other rows found."""
    found = written(entries(rows), "vectors")
    distinct = written(found.groupBy("h1", "h2").agg(F.first("v").alias("v"), F.min("vec_id").alias("id")), "distinct-vectors")
    fitted = {dim: (i.centroids, i.graph, i.ratio) for dim, i in fit_indexes(distinct).items()}
    context = rows.sparkSession.sparkContext
    shared = context.broadcast(fitted)
    asked = written(found.filter(F.pmod("vec_id", F.lit(step)) == 0).dropDuplicates(["vec_id", "h1", "h2"]).withColumnRenamed("vec_id", "id"), "asked")
    placed = written(postings(distinct, shared), "postings")
    plan = shelves(placed, {dim: len(i[0]) for dim, i in fitted.items()})
    put = written(questions(asked, shared, context.broadcast(plan), asked.count()), "questions")
    cells = written(cells_of(put), "cells")
    count = cells.agg(F.max(F.col("first") + F.col("parts"))).first()[0] or 1
    row = ["cell", "asks", "lists", "id", "h1", "h2", "v"]
    held = on_shelves(placed, plan).join(cells, ["dim", "shelf"]).withColumns(
        {"cell": F.explode(F.sequence("first", F.col("first") + F.col("parts") - 1)), "asks": F.lit(False)}).select(*row)
    part = F.pmod(F.xxhash64("id", "h1", "h2"), F.col("parts")).cast("int")
    put = put.join(cells, ["dim", "shelf"]).withColumns({"cell": F.col("first") + part, "asks": F.lit(True)}).select(*row)
    dealt = held.union(put).repartitionById(min(MOST_TASKS, count), F.col("cell")).sortWithinPartitions("cell", "asks")
    answers = dealt.mapInArrow(lambda batches: meet(batches, k + 1), "query_id long, q1 long, q2 long, h1 long, h2 long, least long, score double")
    query = ["query_id", "q1", "q2"]
    once = answers.groupBy(*query, "h1", "h2", "least").agg(F.min("score").alias("score"))  # a vector may be in several lists
    first = once.withColumn("at", F.row_number().over(Window.partitionBy(*query).orderBy("score", "least"))).filter(F.col("at") <= k + 1)
    hits = first.join(copies(found, k), ["h1", "h2"]).filter(F.col("vec_id") != F.col("query_id"))
    hits = hits.withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.least("n", F.lit(k).cast("long")))))
    rank = F.row_number().over(Window.partitionBy(*query).orderBy("score", "vec_id"))
    return hits.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
