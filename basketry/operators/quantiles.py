"""Exact quantiles of groups of any size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from basketry.functions.numeric import dbl, half_up

QUARTILES = (0.25, 0.5, 0.75)
ACCURACY = 10000


def summary_by(df: DataFrame, value: str, group: str | None = None, probs: Sequence[float] = QUARTILES, digits: int = 2,
               extra: Mapping[str, Column] | None = None) -> DataFrame:
    """``n, min, max`` and one interpolated quantile per probability (``q25`` ...), per group or over all rows.

    Sorting a group in one task would not survive a group holding most rows.
    A sketch first gives, for every group and probability, two values that are
    guaranteed to enclose the wanted rank; only the value frequencies between
    them are ordered, everything below is folded into one counter while the
    frequencies are combined. The answer is exact, the sketch only narrows it.
    ``extra`` aggregates are taken along in the first pass.
    """
    rows = df.withColumn("_v", dbl(value)).withColumn("_g", F.col(group) if group else F.lit(0))
    margin = 3.0 / ACCURACY
    lows = [max(0.0, p - margin) for p in probs]
    highs = [min(1.0, p + margin) for p in probs]
    kept = ["n", "min", "max", *(extra or {})]
    sketch = rows.groupBy(*(["_g"] if group else [])).agg(
        F.count("_v").alias("n"), F.min("_v").alias("min"), F.max("_v").alias("max"),
        F.percentile_approx("_v", lows, ACCURACY).alias("_lo"), F.percentile_approx("_v", highs, ACCURACY).alias("_hi"),
        *[c.alias(name) for name, c in (extra or {}).items()],
    )
    # Below ACCURACY rows the sketch margin is less than a row: use the whole range.
    narrowed = bracketed(sketch, kept, probs, F.col("n") < ACCURACY, [F.col("_lo")[i] for i in range(len(probs))], [F.col("_hi")[i] for i in range(len(probs))],
                         grouped=group is not None)
    result = between_brackets(rows, narrowed, kept, probs, digits, grouped=group is not None)
    return result.withColumnRenamed("_g", group) if group else result


def bracketed(sketch: DataFrame, kept: Sequence[str], probs: Sequence[float], small: Column, lows: Sequence[Column], highs: Sequence[Column],
              grouped: bool) -> DataFrame:
    """Per group a struct ``_s`` of ``kept`` and of two values around each probability's rank: the whole range where ``small``."""
    brackets = F.array(*[
        F.struct(F.lit(i).alias("q"), F.lit(p).alias("p"), F.when(small, F.col("min")).otherwise(low).alias("lo"),
                 F.when(small, F.col("max")).otherwise(high).alias("hi"))
        for i, (p, low, high) in enumerate(zip(probs, lows, highs))
    ])
    return sketch.select(*(["_g"] if grouped else []), F.struct(*kept, brackets.alias("brackets")).alias("_s"))


def between_brackets(rows: DataFrame, narrowed: DataFrame, kept: Sequence[str], probs: Sequence[float], digits: int, grouped: bool) -> DataFrame:
    """``kept`` and the exact quantiles of ``rows`` (``_g, _v``), of which only the values inside the brackets are ordered."""
    frequencies = rows.filter("_v IS NOT NULL").groupBy("_g", "_v").agg(F.count("*").alias("_c"))
    if grouped:
        # Groups may be very few: their single rows are repeated over salts of the value, so no task meets a whole group.
        salts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
        salted = frequencies.withColumn("_salt", F.pmod(F.xxhash64("_v"), F.lit(salts)).cast("int"))
        placed = salted.join(narrowed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))), ["_g", "_salt"])
    else:
        placed = frequencies.withColumn("_s", narrowed.scalar())
    wanted = placed.select("_g", "_v", "_c", *[F.col(f"_s.{c}").alias(c) for c in kept], F.explode("_s.brackets").alias("_b"))
    keys = ["_g", *kept, "q", "p"]
    folded = (
        wanted.select("_g", "_v", "_c", *kept, "_b.*").filter("_v <= hi")
        .groupBy(*keys, F.when(F.col("_v") >= F.col("lo"), F.col("_v")).alias("_v")).agg(F.sum("_c").alias("_c"))
    )
    so_far = Window.partitionBy("_g", "q").orderBy(F.asc_nulls_first("_v")).rowsBetween(Window.unboundedPreceding, 0)
    ranked = folded.withColumn("_upto", F.sum("_c").over(so_far))
    rank = (F.col("n") - 1) * F.col("p")
    at = ranked.groupBy(*keys).agg(
        F.min(F.when(F.col("_upto") > F.floor(rank), F.col("_v"))).alias("_below"),
        F.min(F.when(F.col("_upto") > F.floor(rank) + 1, F.col("_v"))).alias("_above"),
        # The wanted rank must lie between the bounds: not among the values folded below, nor above all that are left.
        (F.bool_or(F.col("_v").isNull() & (F.col("_upto") > F.floor(rank))) | (F.max("_upto") <= F.floor(rank))
         | ((F.max("_upto") <= F.floor(rank) + 1) & (F.floor(rank) + 1 < F.max("n")) & (rank > F.floor(rank)))).alias("_outside"),
    )
    below, above = F.col("_below"), F.coalesce("_above", "_below")
    exact = at.withColumn("_x", F.when(F.col("_outside"), F.raise_error(F.lit("a quantile lies outside its bracket"))).otherwise(half_up(below + (above - below) * (rank - F.floor(rank)), digits)))
    result = exact.groupBy("_g", *kept).agg(
        *[F.max(F.when(F.col("q") == i, F.col("_x"))).alias(f"q{round(p * 100):02d}") for i, p in enumerate(probs)]
    )
    return result if grouped else result.drop("_g")
