"""Joins of a large table with a table that has one row per key.

A key that holds a large share of the rows would put that share into one
shuffle partition. ``find_hot_keys`` names such keys (there can be only a few:
at most ``1/share``), and ``attach`` spreads the rows of each over as many
salts as its share of the shuffle partitions, repeating the single matching
row of the other side once per salt. All other keys join in the usual way.
The result is the same with or without hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from math import ceil
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

# Share of all rows from which a key is treated on its own.
HOT_SHARE = 0.02
# Values a sketch of frequent keys follows at a time; its counts are off by about 1/16000 of all rows at most.
SKETCH_ITEMS = 16384


@dataclass(frozen=True)
class HotKeys:
    """Row counts of the few keys that hold a large share of a table, and of missing keys if they do."""

    counts: dict[Any, int] = field(default_factory=dict)
    total: int = 0
    nulls: int = 0

    def splits(self, partitions: int) -> dict[Any, int]:
        """How many parts each hot key is cut into on ``partitions`` shuffle partitions."""
        return {k: self._parts(n, partitions) for k, n in self.counts.items()}

    def null_splits(self, partitions: int) -> int:
        return self._parts(self.nulls, partitions) if self.nulls else 1

    def _parts(self, n: int, partitions: int) -> int:
        return max(2, ceil(2 * partitions * n / self.total))


def find_hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> HotKeys:
    """Keys holding at least ``share`` of the rows."""
    return measure_hot_keys(df, [key], share)[key]


def measure_hot_keys(df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> dict[str, HotKeys]:
    """Frequent values of several columns from one column-pruned pass.

    A sketch of fixed size per column gives the counts; they may be off by a few
    thousandths of ``share``, which only shifts the number of salts.
    """
    sketches = [F.expr(f"approx_top_k(`{k}`, {ceil(1 / share)}, {SKETCH_ITEMS})").alias(f"top{i}") for i, k in enumerate(keys)]
    missing = [F.count_if(F.col(k).isNull()).alias(f"nulls{i}") for i, k in enumerate(keys)]
    row = df.select(*keys).agg(F.count("*").alias("total"), *sketches, *missing).first()
    found = {}
    for i, key in enumerate(keys):
        least = max(1, share * row["total"])
        counts = {x["item"]: x["count"] for x in row[f"top{i}"] or [] if x["item"] is not None and x["count"] >= least}
        found[key] = HotKeys(counts, row["total"], row[f"nulls{i}"] if row[f"nulls{i}"] >= least else 0)
    return found


def attach(fact: DataFrame, dim: DataFrame, key: str, how: str = "inner", hot: HotKeys | None = None,
           by: Sequence[str] | None = None) -> DataFrame:
    """Join ``fact`` with ``dim`` (unique on ``key``), salting the hot keys of ``fact``.

    ``how`` is "inner" or "left". Broadcasting is left to Spark, which does it
    only below its measured size threshold. The salt of a row follows from its
    columns ``by`` (all others than the key by default), so filters still move
    below it and only those columns are read for it; rows equal in all of them
    share a salt, and are split by adaptive execution if they are very many.
    """
    if hot is None or not (hot.counts or (hot.nulls and how == "left")):
        return fact.join(dim, key, how)
    partitions = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    # Missing keys match nothing, but a left join would still send them all to one partition.
    splits = F.when(F.col(key).isNull(), hot.null_splits(partitions)).otherwise(_lookup(F.col(key), hot.splits(partitions)))
    spread = [c for c in fact.columns if c != key] if by is None else list(by)
    salted = fact.withColumn("_salt", F.when(splits > 1, F.pmod(F.xxhash64(*spread), splits)).otherwise(F.lit(0)).cast("int"))
    copies = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), (splits - 1).cast("int"))))
    return salted.join(copies, [key, "_salt"], how).drop("_salt")


def _lookup(key: Column, values: dict[Any, int]) -> Column:
    """Number of parts of ``key``: the stated one for hot keys, otherwise 1."""
    if not values:
        return F.lit(1)
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[key], F.lit(1))
