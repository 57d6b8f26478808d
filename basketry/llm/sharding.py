"""Sharding by bytes: minimax contiguous partition of atomic groups.

Groups are the documents with equal texts; they stand in the order of a digest of
the text. The smallest capacity for which a greedy walk fills no more than the
wanted number of shards is found by binary search, and the order is cut there.

The walk needs sums of sizes up to possible cuts only, not every group. The
driver holds sums over ranges of digests: 2^12 ranges at first, then only the
ranges in which a cut can still fall are divided into 2^8, until the capacity is
exact. What it holds does not grow with the documents, but with the square of
the number of shards. Among the cuts of the best capacity those nearest to equal
sizes are taken.

Texts whose 64-bit digests agree share a group. Nulls: a null text has no bytes and
groups with empty ones; a null doc_id is an id like any other. Repeated rows stay
together, each with its own slot. More shards than groups leave shards empty.
Extra columns are ignored by ``assign`` and written by ``write``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from basketry.llm.common import fresh, written

SHARDS = 24
ROW_BYTES = 8  # every row costs this much besides its text
FIRST_BITS, MORE_BITS = 12, 8
BUCKET_ROWS, MOST_BUCKETS = 200, 1 << 16


def group_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _sums(rows: DataFrame, bits: int) -> np.ndarray:
    """(first key, last key, bytes) of the ranges of keys that agree in their first ``bits`` bits, in order."""
    found = rows.groupBy(F.shiftright("key", 64 - bits).alias("range")).agg(F.min("key"), F.max("key"), F.sum("size").cast("long")).collect()
    return np.array(sorted(tuple(r)[1:] for r in found), np.int64).reshape(-1, 3)


def _walk(ends: np.ndarray, capacity: int, shards: int) -> list[int] | None:
    """Greedy walk: how many ranges lie before each cut, or None if the shards do not suffice."""
    cuts, at = [], 0
    for _ in range(shards):
        reach = (ends[at - 1] if at else 0) + capacity
        to = int(np.searchsorted(ends, reach, side="right"))
        if to == at and at < len(ends):
            return None
        at = to
        cuts.append(at)
    return cuts if at == len(ends) else None


def _smallest(ends: np.ndarray, low: int, shards: int) -> int:
    """Smallest capacity from ``low`` on for which the walk succeeds."""
    high = int(ends[-1])
    while low < high:
        middle = (low + high) // 2
        if _walk(ends, middle, shards):
            high = middle
        else:
            low = middle + 1
    return low


def partition(rows: DataFrame, shards: int = SHARDS) -> list[int | None]:
    """Last key of each shard but the last, from rows of ``key, size``; None for a shard before all keys."""
    ranges, bits = _sums(rows, FIRST_BITS), FIRST_BITS
    if not len(ranges):
        return [None] * (shards - 1)
    while True:
        ends, single = np.cumsum(ranges[:, 2]), ranges[:, 0] == ranges[:, 1]
        low = max(-(-int(ends[-1]) // shards), int(ranges[single, 2].max(initial=0)))
        best = _smallest(ends, max(low, 1), shards)
        # Where the i-th cut of a walk with a capacity between low and best can lie, at least and at most.
        wide, at_least, at_most = np.zeros(len(ranges), bool), 0, 0
        for _ in range(shards - 1):
            reached = int(np.searchsorted(ends, at_least + low, side="right"))
            at_least = int(ends[reached - 1]) if reached else 0
            at_most = min(at_most + best, int(ends[-1]))
            wide[reached:int(np.searchsorted(ends, at_most)) + 1] = True
        wide &= ~single
        if best == low or not wide.any() or bits >= 64:
            break
        prefixes = [int(k) >> (64 - bits) for k in ranges[wide, 0]]
        # Ranges of earlier rounds that no cut can reach stay whole; all others have this round's bits.
        part = rows.filter(F.shiftright("key", 64 - bits).isin(prefixes))
        bits = min(64, bits + MORE_BITS)
        finer = _sums(part, bits)
        ranges = np.concatenate([ranges[~wide], finer])
        ranges = ranges[np.argsort(ranges[:, 0])]
    return _cut(ranges, best, shards)


def _cut(ranges: np.ndarray, capacity: int, shards: int) -> list[int | None]:
    """Cuts within ``capacity``, each as near to its equal share as those before and after allow."""
    ends = np.cumsum(ranges[:, 2])
    latest = _walk(ends, capacity, shards)
    back = _walk(np.cumsum(ranges[::-1, 2]), capacity, shards)
    earliest = [len(ends) - n for n in back[-2::-1]]
    keys, at = [], 0
    for i in range(shards - 1):
        reach = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + capacity, side="right"))
        wanted = int(ends[-1]) * (i + 1) / shards
        near = int(np.searchsorted(ends, wanted))
        if near < len(ends) and ends[near] - wanted <= wanted - (ends[near - 1] if near else 0):
            near += 1
        at = min(max(near, earliest[i], at), latest[i], reach)
        keys.append(int(ranges[at - 1, 1]) if at else None)
    return keys


def shard_of(key: Column, cuts: list[int | None]) -> Column:
    """The shard of a group: how many shards end before its key."""
    passed = [F.lit(1) if c is None else (key > c).cast("int") for c in cuts]
    return sum(passed, F.lit(0))


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` per document; slots of a shard count from 0 without gaps."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = written(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), group_key(F.col("text")).alias("key")), "shard-sizes")
    placed = rows.withColumn("shard", shard_of(F.col("key"), partition(rows, shards)).cast("int"))
    buckets = max(1, min(MOST_BUCKETS, -(-rows.count() // (shards * BUCKET_ROWS))))
    placed = placed.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(buckets)).cast("int"))
    # A slot is the number of rows in earlier buckets of the shard (at most MOST_BUCKETS counts) and before it in its own.
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("shard", "bucket").count().withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0)))
    place = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size"))
    slotted = placed.withColumn("place", place).join(counts.select("shard", "bucket", "before"), ["shard", "bucket"])
    return slotted.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                          (F.col("before") + F.col("place") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def write(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """The documents with all their columns in one folder per shard."""
    shard = fresh(docs, "shard")
    rows = docs.select(group_key(F.col("text")).alias("key"), (F.octet_length(F.coalesce("text", F.lit(""))) + ROW_BYTES).alias("size"))
    cuts = partition(written(rows, "shard-sizes"), shards)
    docs.withColumn(shard, shard_of(group_key(F.col("text")), cuts)).write.partitionBy(shard).parquet(path)
