"""Exact top-k search by inner product with block-at-a-time pruning.

Vectors stand in blocks of neighbouring ids. A block's forward index is its matrix;
with it are kept the largest and smallest value of each component. For a query,
the sum over components of the larger of (query * largest, query * smallest)
bounds every score in a block. Blocks are visited by falling bound and scored
whole until the bound falls below the k-th score found so far. Scores within a
query's own block, found while the blocks are built, give the first k-th score.

Blocks and queries meet in cells of at most ``CELL_BLOCKS`` x ``CELL_QUERIES``,
each a task; a query's best of each cell are ranked at the end.

Scores are whole numbers and exact: products are summed in double precision only
where every partial sum is below 2^53, otherwise as unbounded integers (those
that leave 64 bits are held at their ends). Nulls:
vectors that are null or hold a null or non-finite component, and rows without
id, take no part. Only vectors of equal length meet. Repeated rows are candidates
each, and a query that stands several times is asked once; a row with the query's id is never its own result. An empty
table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from basketry.llm.common import written

SCALE, K, QUERY_STEP = 256, 5, 50
BLOCK, CELL_BLOCKS, CELL_QUERIES = 512, 16, 1024


def whole_vectors(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, v``: components as floor(scale * x), without rows that take no part."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * scale)).alias("v"))


def products(matrix: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``matrix`` with ``query`` (both whole numbers)."""
    if not matrix.size:
        return np.zeros(len(matrix), np.int64)
    if float(np.abs(matrix).max()) * float(np.abs(query).max()) * len(query) < 2.0**53:
        return (matrix.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    ends = np.iinfo(np.int64)
    return np.array([min(max(x, ends.min), ends.max) for x in matrix.astype(object) @ query.astype(object)], np.int64)


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores, ties to the smaller id."""
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def build_blocks(vectors: DataFrame, step: int, k: int) -> DataFrame:
    """Blocks ``dim, ids, matrix, high, low`` and, as further rows, the queries ``dim, ids, matrix, seed`` of each block."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[int, np.ndarray]] = []
        for batch in batches:
            held += [(i, np.asarray(v, np.int64)) for i, v in zip(batch["vec_id"], batch["v"])]
            while len(held) >= BLOCK:
                yield from blocks(held[:BLOCK])
                held = held[BLOCK:]
        yield from blocks(held)

    def blocks(held: list[tuple[int, np.ndarray]]) -> Iterator[pd.DataFrame]:
        for dim in sorted({len(v) for _, v in held}):
            ids = np.array([i for i, v in held if len(v) == dim], np.int64)
            matrix = np.array([v for _, v in held if len(v) == dim], np.int64).reshape(len(ids), dim)
            out = [(False, dim, ids, matrix.reshape(-1), matrix.max(axis=0), matrix.min(axis=0), None)]
            for row in np.flatnonzero(ids % step == 0):
                scores = np.sort(products(matrix, matrix[row])[ids != ids[row]])[::-1]
                out.append((True, dim, ids[row:row + 1], matrix[row], None, None, int(scores[k - 1]) if len(scores) >= k else None))
            frame = pd.DataFrame(out, columns=["query", "dim", "ids", "matrix", "high", "low", "seed"])
            yield frame.astype({"seed": "Int64"})

    ordered = vectors.repartitionByRange("vec_id").sortWithinPartitions("vec_id")
    return ordered.mapInPandas(run, "query boolean, dim int, ids array<long>, matrix array<long>, high array<long>, low array<long>, seed long")


def _search(blocks: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """The best k of these blocks for each of these queries."""
    out: list[tuple] = []
    if len(blocks) and len(queries):
        stack = lambda column: np.stack([np.asarray(x, np.float64) for x in column])
        asked, high, low = stack(queries["matrix"]), stack(blocks["high"]), stack(blocks["low"])
        bounds = np.maximum(asked, 0) @ high.T + np.minimum(asked, 0) @ low.T
        if np.abs(asked).max(initial=0) * max(np.abs(high).max(initial=0), np.abs(low).max(initial=0)) * asked.shape[1] >= 2.0**53:
            bounds = np.nextafter(bounds * (1 + 1e-9 * np.sign(bounds)), np.inf) + 1  # rounded sums: a little wider
        matrices = [np.asarray(m, np.int64).reshape(len(i), -1) for i, m in zip(blocks["ids"], blocks["matrix"])]
        numbers = [np.asarray(i, np.int64) for i in blocks["ids"]]
        for n, (own, vector, seed) in enumerate(zip(queries["ids"], queries["matrix"], queries["seed"])):
            vector, own = np.asarray(vector, np.int64), int(own[0])
            kth = -np.inf if pd.isna(seed) else int(seed)
            ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
            for b in np.argsort(-bounds[n], kind="stable"):
                if bounds[n, b] < kth:
                    break
                found = products(matrices[b], vector)
                good = (found >= kth) & (numbers[b] != own)
                ids, scores = best(np.append(ids, numbers[b][good]), np.append(scores, found[good]), k)
                if len(scores) == k:
                    kth = max(kth, int(scores[-1]))
            out += [(own, queries["digest"].iloc[n], int(i), int(s)) for i, s in zip(ids, scores)]
    return pd.DataFrame(out, columns=["query_id", "digest", "vec_id", "score"])


def top_k(rows: DataFrame, step: int = QUERY_STEP, k: int = K, scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id is divisible by ``step`` its k best other rows."""
    index = written(build_blocks(whole_vectors(rows, scale), step, k), "vector-blocks")
    sizes = {r["query"]: r["count"] for r in index.groupBy("query").count().collect()}
    across, down = (-(-sizes.get(q, 0) // n) or 1 for q, n in ((False, CELL_BLOCKS), (True, CELL_QUERIES)))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    part = lambda n: F.pmod(F.xxhash64("ids", "matrix"), F.lit(n)).cast("int")
    blocks = index.filter(~F.col("query")).select("dim", "ids", "matrix", "high", "low", part(across).alias("a"), spread(down).alias("d"))
    queries = index.filter("query").select("dim", "ids", "matrix", "seed", F.xxhash64("matrix").alias("digest"), part(down).alias("d"))
    # A query that stands several times is asked once, from the best of its first scores.
    queries = queries.groupBy("dim", "ids", "matrix", "digest", "d").agg(F.max("seed").alias("seed"))
    queries = queries.withColumn("a", spread(across))
    cell = ["dim", "a", "d"]
    found = blocks.groupBy(*cell).cogroup(queries.groupBy(*cell)).applyInPandas(
        lambda b, q: _search(b, q, k), "query_id long, digest long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id", "digest").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


TOP_K_SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % {QUERY_STEP} = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}"""
