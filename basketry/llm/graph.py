"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from basketry.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (long columns ``a``, ``b``); root is the smallest node reachable.

    Large-star and small-star steps (Kiveris et al. 2014) alternate until the
    links stand still, in a number of rounds that grows with the logarithm of
    the longest chain. A node with very many links is only ever an aggregate
    and one side of a join that Spark can split. Each round is a table in the
    shared folder; the driver sees one count and one checksum a round.
    """
    links = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links, before = written(links, "links"), None
    while before != (before := _state(links)):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(both).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        small = _star(large)
        hung = small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        own = small.select("a", F.col("m").alias("b"))
        links = written(hung.unionByName(own).distinct(), "links")
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _star(links: DataFrame) -> DataFrame:
    """Each link (a, b) with ``m``, the smallest of a and its neighbours here."""
    least = links.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return links.join(least, "a")


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
