"""Mixing sources to target weights by entropy balancing.

Every document gets a rate between 0 and ``most`` copies such that the expected
words of each source meet its target and the rates stay as close to even as that
allows (largest binary entropy against ``most``). The solution tilts the odds of
a document exponentially in its size, ``rate = most * sigmoid(lambda * size)``,
with one multiplier per source. The multipliers solve a convex dual problem by
Newton steps, kept inside a bracket; each step is one aggregation over the counts
of documents by source and size, so it does not read documents again.

Rates become whole copies by error diffusion within chunks of about
``CHUNK_ROWS`` documents of a source, largest documents first, so a source misses
its target by a few words per chunk. Moments are summed as whole numbers:
nothing depends on the order in which partitions are merged, and reruns agree.

Nulls: a null text has size 0, a null source is a source of its own, a document
without doc_id takes part. Documents of size 0 are taken once. Rows that repeat
doc_id, source and size share one rate, and so many of them are rounded up as come
nearest to it. Documents of equal size are ordered by a hash of their id. A text of
any length is one number here. Extra columns are ignored by ``mix`` and passed through
by ``mixed``. An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from basketry.llm.common import WORD, fresh, with_any_names, written

WEIGHTS, BUDGET, MOST = (3, 1, 2), 1.5, 2.0
CHUNK_ROWS, ROWS_AT_ONCE = 1000, 1000
TOLERANCE, MOST_STEPS = 1e-6, 100
UNITS = 1 << 20  # of a word, in sums


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def targets(sources: DataFrame, weights: tuple = WEIGHTS, budget: float = BUDGET, most: float = MOST) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size`` (one row per source).

    Weights repeat over the sources by code point, null last. Shares above
    ``most`` times a source's size are cut there and the excess is shared again
    by weight: sources are filled in the order of the level at which they are full.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    weighed = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))).cast("int") + 1).cast("double"))
    weighed = weighed.withColumn("cap", most * F.col("source_size")).withColumn("full_at", F.col("cap") / F.col("weight"))
    order = Window.orderBy("full_at", F.col("source").isNull(), "source")
    total = Window.partitionBy()
    level = (budget * F.sum("source_size").over(total) - F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))) \
        / F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    levels = weighed.withColumn("level", level)
    # The first source in this order that the level does not fill sets the level of all.
    reached = F.first(F.when(F.col("level") <= F.col("full_at"), F.col("level")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return levels.withColumn("reached", reached).select(
        "source", "source_size", F.when(F.col("full_at") > F.col("reached"), F.col("reached") * F.col("weight")).otherwise(F.col("cap")).alias("target"))


def _rate(most: float) -> Column:
    return F.when(F.col("full"), F.lit(most)).otherwise(most / (1 + F.exp(-F.col("tilt") * F.col("size") / F.col("scale"))))


def tilts(counts: DataFrame, wanted: DataFrame, most: float = MOST) -> DataFrame:
    """``source, full, scale, tilt`` per source: the multipliers whose expected words meet the targets.

    ``counts`` has ``source, size, n`` for sizes above 0; ``wanted`` has ``source, source_size, target``.
    """
    means = counts.groupBy("source").agg(F.sum("n").alias("_n"))
    state = wanted.join(means, wanted["source"].eqNullSafe(means["source"])).drop(means["source"]).select(
        "source", "target", (F.col("target") >= most * F.col("source_size")).alias("full"), (F.col("source_size") / F.col("_n")).alias("scale"),
        F.lit(0.0).alias("tilt"), F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"), F.lit(1.0).alias("miss"))
    state = written(state, "tilts")
    whole = lambda x: F.sum(F.round(x * UNITS).cast("decimal(38,0)")) / UNITS
    for _ in range(MOST_STEPS):
        at = counts.join(state.withColumnRenamed("source", "_s"), counts["source"].eqNullSafe(F.col("_s")))
        rate, x = _rate(most), F.col("size") / F.col("scale")
        moments = at.groupBy("_s").agg(
            whole(F.col("n") * F.col("size") * rate).cast("double").alias("words"),
            whole(F.col("n") * F.col("size") * x * rate * (1 - rate / most)).cast("double").alias("slope"))
        now = state.join(moments, state["source"].eqNullSafe(moments["_s"]))
        over = F.col("words") > F.col("target")
        low, high = F.when(over, F.col("low")).otherwise(F.col("tilt")), F.when(over, F.col("tilt")).otherwise(F.col("high"))
        now = now.withColumns({"low": low, "high": high, "miss": F.when(F.col("full"), 0.0).otherwise(F.abs(F.col("words") - F.col("target")) / F.col("target"))})
        step = F.col("tilt") + F.when(F.col("slope") > 0, (F.col("target") - F.col("words")) / F.col("slope")).otherwise(F.when(over, -1.0).otherwise(1.0))
        # Without a bracket on that side a step goes at most twice as far as before.
        far = F.abs(F.col("tilt")) + 1
        inside = F.least(F.greatest(step, F.coalesce("low", F.col("tilt") - far)), F.coalesce("high", F.col("tilt") + far))
        halved = (F.col("low") + F.col("high")) / 2
        settled = (F.col("miss") <= TOLERANCE) | F.col("full")
        new = F.when(settled, F.col("tilt")).when((step > F.col("low")) & (step < F.col("high")), step).otherwise(F.coalesce(halved, inside))
        state = written(now.withColumn("tilt", new).select(state.columns), "tilts")
        if (state.agg(F.max("miss")).first()[0] or 0.0) <= TOLERANCE:
            break
    else:
        raise RuntimeError(f"a source still misses its target by more than {TOLERANCE} of it after {MOST_STEPS} steps")
    return state.select("source", "full", "scale", "tilt")


def _copies(rows: pd.DataFrame, most: float) -> pd.DataFrame:
    """Whole copies for one chunk, largest documents first: ``low`` for each row of a group, one more for ``ups`` of them.

    Each rate is rounded to the side that keeps the words owed near zero, as long as
    the smaller documents that follow can still make up for them. Of a group of equal rows
    as many are rounded up as come nearest.
    """
    rows = rows.sort_values(["size", "_h", "doc_id"], ascending=[False, True, True], kind="stable")
    words, rate = (rows["size"] * rows["n"]).to_numpy(), rows["rate"].to_numpy()
    low = np.minimum(np.floor(rate), most - 1)
    over, under = (rate - low) * words, (low + 1 - rate) * words  # owed more if rounded down, less if rounded up
    can_raise = np.append(np.cumsum(over[::-1])[::-1][1:], 0.0)
    can_lower = np.append(np.cumsum(under[::-1])[::-1][1:], 0.0)
    owed, ups = 0.0, []
    for size, n, down, up, lower, higher in zip(rows["size"].tolist(), rows["n"].tolist(), over.tolist(), under.tolist(), can_lower.tolist(), can_raise.tolist()):
        near = min(n, max(0, round((owed + down) / size))) if size and n > 1 else 0
        choices = sorted((max(o - lower, -o - higher, 0.0), abs(o), o, taken) for o, taken in ((owed + down - size * u, u) for u in {0, near, n}))
        owed = choices[0][2]
        ups.append(choices[0][3])
    return rows.assign(low=np.where(words > 0, low, 1).astype(int), ups=np.where(words > 0, ups, 0))[["doc_id", "source", "size", "n", "rate", "low", "ups"]]


def decisions(sizes: DataFrame, weights: tuple = WEIGHTS, budget: float = BUDGET, most: float = MOST) -> tuple[DataFrame, DataFrame]:
    """Copies per distinct ``doc_id, source, size`` (``n`` such rows, see ``_copies``), and the targets per source."""
    rows = written(sizes.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n")), "sizes")
    counts = written(rows.groupBy("source", "size").agg(F.sum("n").alias("n")), "size-counts")
    wanted = targets(counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).cast("long").alias("source_size")), weights, budget, most)
    wanted = written(wanted, "targets")
    solved = tilts(counts.filter("size > 0"), wanted, most)
    chunks = counts.groupBy("source").agg(F.ceil(F.sum("n") / CHUNK_ROWS).alias("_chunks"))
    known = chunks.join(solved.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s").withColumnRenamed("source", "_s")
    rated = rows.join(known, rows["source"].eqNullSafe(F.col("_s"))).select(
        "doc_id", "source", "size", "n", F.coalesce(_rate(most), F.lit(1.0)).alias("rate"),
        F.xxhash64("doc_id", "size").alias("_h"), F.pmod(F.xxhash64("doc_id", "size", "source"), "_chunks").alias("_chunk"))
    taken = rated.groupBy("source", "_chunk").applyInPandas(
        lambda rows: _copies(rows, most), "doc_id long, source string, size long, n long, rate double, low int, ups long")
    return taken, wanted


def mix(docs: DataFrame, weights: tuple = WEIGHTS, budget: float = BUDGET, most: float = MOST) -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies, rate`` per document."""
    sizes = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", size_of(F.col("text")).alias("size"))
    taken, wanted = decisions(sizes, weights, budget, most)
    wanted = wanted.withColumnRenamed("source", "_s")
    # Equal rows return as so many rows, in two steps: no row ever holds an array as long as a group.
    parts = F.array(F.struct((F.col("low") + 1).alias("copies"), F.col("ups").alias("m")), F.struct(F.col("low").alias("copies"), (F.col("n") - F.col("ups")).alias("m")))
    rows = taken.select("*", F.inline(parts)).filter("m > 0").withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(m - 1) div {ROWS_AT_ONCE}"))))
    rows = rows.withColumn("_j", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(ROWS_AT_ONCE).cast("long"), F.col("m") - F.col("_i") * ROWS_AT_ONCE))))
    return rows.join(wanted, F.col("source").eqNullSafe(F.col("_s"))).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "rate")


@with_any_names
def mixed(docs: DataFrame, weights: tuple = WEIGHTS, budget: float = BUDGET, most: float = MOST) -> DataFrame:
    """The mix itself: every document as often as it is taken, with all its columns."""
    size, again = fresh(docs, "_size"), fresh(docs, "_again")
    sized = docs.withColumn(size, size_of(F.col("text")))
    taken, _ = decisions(sized.select(F.col("doc_id").cast("long").alias("doc_id"), "source", F.col(size).alias("size")), weights, budget, most)
    own = {c: fresh(sized, f"_{c}") for c in ("doc_id", "source", "size", "n", "low", "ups")}
    taken = taken.filter("low > 0 OR ups > 0").select(*(F.col(c).alias(name) for c, name in own.items()))
    same = F.col("doc_id").eqNullSafe(F.col(own["doc_id"])) & F.col("source").eqNullSafe(F.col(own["source"])) & (F.col(size) == F.col(own["size"]))
    n, low, ups = (F.col(own[c]) for c in ("n", "low", "ups"))
    alike = (ups == 0) | (ups == n)  # all rows of a group are taken equally often
    parts = [sized.join(taken.filter(alike), same).withColumn(again, low + (ups > 0).cast("int"))]
    split = written(taken.filter(~alike), "split-groups")  # groups of equal rows that are not all taken equally often
    if split.limit(1).count():
        numbered = _numbered(sized.join(split, same), [own[c] for c in ("doc_id", "source", "size")], again)
        parts.append(numbered.withColumn(again, low + (F.col(again) <= ups).cast("int")))
    out = reduce(DataFrame.unionAll, (part.select(*docs.columns, again) for part in parts)).filter(F.col(again) > 0)
    return out.withColumn(again, F.explode(F.sequence(F.lit(1), F.col(again)))).drop(again)


def _numbered(rows: DataFrame, key: list[str], name: str) -> DataFrame:
    """Rows numbered from 1 within their ``key``, in any order; counted over salts, for a key may have very many rows."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at, salt, here, start = (fresh(rows, f"_{c}") for c in ("at", "salt", "here", "start"))
    rows = written(rows.withColumn(at, F.monotonically_increasing_id()), "equal-rows").withColumn(salt, F.pmod(F.xxhash64(at), F.lit(parts)))
    counts = rows.groupBy(*key, salt).agg(F.count("*").alias(here))
    starts = counts.withColumn(start, F.sum(here).over(Window.partitionBy(*key).orderBy(salt)) - F.col(here))
    starts = starts.select(*(F.col(c).alias(f"{c}2") for c in key), F.col(salt).alias(f"{salt}2"), start)
    numbered = rows.withColumn(name, F.row_number().over(Window.partitionBy(*key, salt).orderBy(at)))
    return numbered.join(starts, reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"{c}2")) for c in [*key, salt]))).withColumn(name, F.col(name) + F.col(start))
