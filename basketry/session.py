"""Spark session settings the library is designed for."""

from __future__ import annotations

import os
import posixpath
import uuid

from pyspark.sql import DataFrame, SparkSession


PARTITION_BYTES = 256 << 20
MOST_PARTITIONS = 32000


def sizing(shuffle_bytes: int) -> dict[str, str]:
    """Settings for jobs that shuffle about ``shuffle_bytes``: partitions of 256 MB, larger only
    where there would be more than the shuffle service handles well. Adaptive execution
    merges what turns out small, so the number may be generous."""
    partitions = min(MOST_PARTITIONS, max(200, -(-shuffle_bytes // PARTITION_BYTES)))
    target = max(PARTITION_BYTES, -(-shuffle_bytes // partitions))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.files.maxPartitionBytes": str(PARTITION_BYTES),
    }


def build_session(app_name: str = "basketry", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC, ANSI arithmetic and adaptive execution.

    For large data pass ``**sizing(bytes)``; without it the shuffle settings stay
    those of the cluster. A broadcast happens only for sides Spark has measured.
    Only settings passed here or missing from the environment are set, so
    cluster-provided values such as ``spark.checkpoint.dir`` stay untouched.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Shared folder for durable intermediate results.

    The cluster names it in ``spark.checkpoint.dir``. Only on one machine (a local
    master, as in tests) a folder under the working directory may stand in for it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return os.path.join(os.getcwd(), "spark-warehouse", "shared")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder for a table of this application in the shared folder; it goes when the application ends."""
    path = posixpath.join(shared_dir(spark), f"basketry-{name}-{uuid.uuid4().hex}")
    files, target = _files(spark, path)
    files.deleteOnExit(target)
    return path


def _files(spark: SparkSession, path: str) -> tuple:
    """The file system of a path, which may be any that Spark reads, and the path in it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _files(spark, path)
    return files.exists(target)


def folders(spark: SparkSession, path: str) -> list[str]:
    files, target = _files(spark, path)
    return [f.getPath().toString() for f in files.listStatus(target) if f.isDirectory()] if files.exists(target) else []


def remove(spark: SparkSession, path: str) -> None:
    files, target = _files(spark, path)
    files.delete(target, True)


def durable(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read back: a lost executor loses none of it, and nothing is computed twice."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
