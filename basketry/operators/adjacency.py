"""Steps between neighbouring rows of a sequence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

STEP, HEAD, TAIL = 0, 1, 2


def chunk_records(df: DataFrame, group: str, order: Sequence[str], value: str) -> DataFrame:
    """``side, chunk, group, source, target, n``: the steps counted inside chunks, and the first and last row of each chunk.

    Rows are range-partitioned by (group, order) and ordered as one sequence, so a chunk
    holds many short groups or a piece of a long one. It leaves two rows whatever the
    number of its groups; steps have no group and no chunk.
    """
    chunked = df.select(F.col(group).alias("_g"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], F.col(value).alias("_v"))
    keys = ["_g", *(f"_o{i}" for i in range(len(order)))]
    chunked = chunked.repartitionByRange(*keys).withColumn("_chunk", F.spark_partition_id())
    w = Window.partitionBy("_chunk").orderBy(*keys)
    stepped = chunked.select(
        "_g", "_chunk", "_v", F.lead("_v").over(w).alias("_next"), F.lead("_g").over(w).alias("_next_g"),
        F.row_number().over(w).alias("_pos"), F.lead(F.lit(True)).over(w).isNull().alias("_end"),
    )
    kinds = chunked.schema

    def record(side: int, edge: bool):
        nothing = lambda c: F.lit(None).cast(kinds[c].dataType)
        return F.struct(F.lit(side).alias("side"), (F.col("_chunk") if edge else nothing("_chunk")).alias("chunk"),
                        (F.col("_g") if edge else nothing("_g")).alias("group"), F.col("_v").alias("source"),
                        (nothing("_v") if edge else F.col("_next")).alias("target"))

    within = ~F.col("_end") & F.col("_g").eqNullSafe(F.col("_next_g"))
    records = F.array(F.when(within, record(STEP, False)), F.when(F.col("_pos") == 1, record(HEAD, True)), F.when(F.col("_end"), record(TAIL, True)))
    return (
        stepped.select(F.explode(records).alias("r")).filter("r IS NOT NULL").select("r.*")
        .groupBy("side", "chunk", "group", "source", "target").agg(F.count("*").alias("n"))
    )


def transition_counts(df: DataFrame, group: str, order: Sequence[str], value: str) -> DataFrame:
    """How often ``value`` of one row is followed by ``value`` of the next row of its group.

    Steps inside a chunk are counted there; the step across a cut goes from the last row
    of a chunk to the first of the next, if both are of one group. Everything flows
    through one chain, so a chunk is never derived twice.
    """
    records = chunk_records(df, group, order, value)
    # The ends of all chunks meet in one window: two rows a chunk. Counted steps only pass through.
    cuts = Window.partitionBy(F.when(F.col("side") == STEP, F.col("source"))).orderBy("chunk", "side")
    after = records.withColumns({f"_after_{c}": F.lead(c).over(cuts) for c in ("side", "group", "source")})
    crossing = (F.col("side") == TAIL) & (F.col("_after_side") == HEAD) & F.col("group").eqNullSafe(F.col("_after_group"))
    return (
        after.filter((F.col("side") == STEP) | crossing)
        .select("source", F.when(F.col("side") == STEP, F.col("target")).otherwise(F.col("_after_source")).alias("target"), "n")
        .groupBy("source", "target").agg(F.sum("n").alias("count"))
    )
