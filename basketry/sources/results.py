"""Durable results in versions: a rewrite is seen whole or not at all, and takes nothing from those who read.

A version is a folder of tables of its own. It counts once a row of the manifest names it, and that row is written
last, by a commit that is one rename. Readers take the newest version named; whoever has begun to read an older one
finishes on it, since the last ``keep`` versions stay. Folders that no kept row names (superseded versions, and those
of writers that failed) go after a commit. There is one writer at a time.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketry.session import exists, folders, remove

MANIFEST, VERSIONS, KEEP = "manifest", "versions", 2


def materialise(results: Mapping[str, DataFrame], path: str, keep: int = KEEP) -> None:
    """One Parquet folder per result, all of one version."""
    commit(path, {name: lambda to, df=df: df.write.parquet(to) for name, df in results.items()}, _session(results.values()), keep)


def load_results(spark: SparkSession, path: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """The named tables of the newest version."""
    folder = newest(spark, path)
    return {name: spark.read.parquet(posixpath.join(folder, name)) for name in names}


def write_warehouse(tables: Mapping[str, tuple[DataFrame, list[str]]], path: str, keep: int = KEEP) -> None:
    """A new version of every table of the store, ordered by its key."""
    writers = {name: lambda to, df=df, keys=keys: write_key_ordered(df, to, keys) for name, (df, keys) in tables.items()}
    commit(path, writers, _session(df for df, _ in tables.values()), keep)


def write_key_ordered(df: DataFrame, path: str, keys: list[str]) -> None:
    """Range-partitioned and sorted by ``keys``, so that a filter on the leading
    key reads only the row groups whose statistics contain it."""
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)


def commit(path: str, writers: Mapping[str, Callable[[str], None]], spark: SparkSession, keep: int = KEEP) -> str:
    """Let each writer write its table into a new version, name the version in the manifest, remove what is superseded."""
    kept = versions(spark, path)
    number = kept[0][0] + 1 if kept else 1
    folder = f"{number:09d}-{uuid.uuid4().hex}"
    for name, write in writers.items():
        write(posixpath.join(path, VERSIONS, folder, name))
    row = spark.range(1).select(F.lit(number).cast("long").alias("version"), F.lit(folder).alias("folder"))
    row.coalesce(1).write.mode("append").parquet(posixpath.join(path, MANIFEST))
    stay = {f for _, f in [(number, folder), *kept][:keep]}
    for old in folders(spark, posixpath.join(path, VERSIONS)):
        if posixpath.basename(old) not in stay:
            remove(spark, old)
    return posixpath.join(path, VERSIONS, folder)


def versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Number and folder of every version named, newest first: a row per rewrite."""
    manifest = posixpath.join(path, MANIFEST)
    if not exists(spark, posixpath.join(manifest, "_SUCCESS")):
        return []
    rows = spark.read.schema("version long, folder string").parquet(manifest).collect()
    return sorted(((r["version"], r["folder"]) for r in rows), reverse=True)


def newest(spark: SparkSession, path: str) -> str:
    """The folder of the newest version."""
    found = versions(spark, path)
    if not found:
        raise FileNotFoundError(f"no version of results in {path}")
    return posixpath.join(path, VERSIONS, found[0][1])


def _session(frames: Iterable[DataFrame]) -> SparkSession:
    return next(iter(frames)).sparkSession
