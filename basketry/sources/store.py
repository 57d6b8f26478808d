"""A store of bucketed tables, in versions.

Tables that are joined by a key, or read by it, are cut into buckets by that key and sorted within. Two tables with the
same buckets are joined without moving a row, and a read by key opens the files of one bucket only. A key that holds a
large share of a table is dealt to many tasks when it is written, and ``hot_join`` joins its rows apart, so neither
the bucket of such a key nor the task that reads it grows.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketry.operators.joins import HotKeys
from basketry.sources import results

BUCKETS = 64


@dataclass(frozen=True)
class Layout:
    """By which column a table is bucketed, how it is sorted within, and the frequent keys it has."""

    key: str
    order: tuple[str, ...] = ()
    hot: HotKeys | None = None


class Store:
    """Tables of the newest version in a folder; ``buckets`` are fixed when a store is made."""

    def __init__(self, spark: SparkSession, path: str, layouts: Mapping[str, Layout], buckets: int = BUCKETS) -> None:
        self.spark, self.path, self.layouts, self.buckets = spark, path, dict(layouts), buckets
        self._named: dict[tuple[str, str], str] = {}

    def write(self, tables: Mapping[str, DataFrame], keep: int = results.KEEP) -> None:
        """A new version of all tables."""
        results.commit(self.path, {name: lambda to, name=name, df=df: self._write(name, df, to) for name, df in tables.items()}, self.spark, keep)

    def _write(self, name: str, df: DataFrame, to: str) -> None:
        layout = self.layouts[name]
        dealt = _dealt(df, layout, self.buckets)
        table = f"store_{name}_{uuid.uuid4().hex}"
        dealt.write.format("parquet").bucketBy(self.buckets, layout.key).sortBy(layout.key, *layout.order).option("path", to).saveAsTable(table)
        self.spark.sql(f"DROP TABLE {table}")  # the files stay; readers name them by their version

    def read(self, name: str) -> DataFrame:
        """A table of the newest version, with its buckets known to the planner."""
        folder = results.newest(self.spark, self.path)
        if (folder, name) not in self._named:
            layout, at = self.layouts[name], posixpath.join(folder, name)
            table = f"store_{name}_{uuid.uuid4().hex}"
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.spark.read.parquet(at).schema.fields)
            order = ", ".join(f"`{c}`" for c in (layout.key, *layout.order))
            self.spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (`{layout.key}`) SORTED BY ({order}) "
                           f"INTO {self.buckets} BUCKETS LOCATION '{at}'")
            self._named[folder, name] = table
        return self.spark.table(self._named[folder, name])


def _dealt(df: DataFrame, layout: Layout, buckets: int) -> DataFrame:
    """One task per bucket; the rows of frequent keys over as many tasks as they have shares of the partitions."""
    if layout.hot is None or not layout.hot.counts:
        return df.repartition(buckets, layout.key)
    hot = F.coalesce(F.col(layout.key).isin(list(layout.hot.counts)), F.lit(False))
    tasks = sum(layout.hot.splits(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))).values())
    others = [c for c in df.columns if c != layout.key]
    return df.filter(~hot).repartition(buckets, layout.key).unionAll(df.filter(hot).repartition(tasks, *others))


def hot_join(fact: DataFrame, dim: DataFrame, key: str, hot: HotKeys | None = None) -> DataFrame:
    """Join two tables of the same buckets. Rows of frequent keys are read without their buckets and meet the few rows they match."""
    if hot is None or not hot.counts:
        return fact.join(dim, key)
    few = F.col(key).isin(list(hot.counts))
    # One row per frequent key, of which there are at most 1 / HOT_SHARE.
    return fact.filter(~few).join(dim.filter(~few), key).unionByName(fact.filter(few).join(F.broadcast(dim.filter(few)), key))
