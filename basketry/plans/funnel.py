"""Conversion funnel and cart abandonment.

A cart stage here means a non-empty cart (the overview in ``sessions`` goes by
the outcome instead); abandoned means the outcome says so.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from basketry.functions.calendar import time_of_day
from basketry.functions.numeric import half_up, mean, pct, ratio

STAGES = {"Browse": "stage_browse", "View Product": "stage_view_product", "Add to Cart": "stage_add_to_cart",
          "Purchase": "stage_purchase"}


def funnel_flags(sessions: DataFrame) -> DataFrame:
    hour = F.hour("start_time")
    return sessions.select(
        "session_id", "user_id", "start_time", "duration_seconds", "conversion_status", "referrer", "device_type", "device_os",
        F.lit(True).alias("stage_browse"),
        F.coalesce(F.col("viewed_products") > 0, F.lit(False)).alias("stage_view_product"),
        F.coalesce(F.col("cart_items") > 0, F.lit(False)).alias("stage_add_to_cart"),
        F.coalesce(F.col("conversion_status") == "converted", F.lit(False)).alias("stage_purchase"),
        hour.alias("hour_of_day"), time_of_day(hour).alias("time_of_day"),
    )


def with_purchases(flags: DataFrame, session_purchases: DataFrame) -> DataFrame:
    """Purchase amount and item count per session, 0 without a purchase. Both sides have one row per session."""
    return flags.join(session_purchases, "session_id", "left").withColumns(
        {
            "purchase_amount": F.coalesce("purchase_amount", F.lit(0).cast("decimal(18,2)")),
            "items_purchased": F.coalesce("items_purchased", F.lit(0).cast("bigint")),
        }
    )


def funnel_stages(flags: DataFrame) -> DataFrame:
    """Four rows from one aggregation: count, share of all and share of the stage before (0 when that is empty)."""
    counts = flags.agg(*[F.count_if(F.col(c)).alias(c) for c in STAGES.values()])
    before = ["stage_browse", *list(STAGES.values())[:-1]]
    rows = F.array(*[
        F.struct(F.lit(i).alias("_i"), F.lit(name).alias("stage"), F.col(c).alias("count"),
                 F.col("stage_browse").alias("_all"), F.col(b).alias("_before"))
        for i, ((name, c), b) in enumerate(zip(STAGES.items(), before))
    ])

    def share(den: str) -> Column:
        return F.coalesce(pct("count", den), F.lit(0.0))

    return counts.select(F.inline(rows)).orderBy("_i").select(
        "stage", "count", share("_all").alias("pct_of_total"), share("_before").alias("pct_of_prev")
    )


def funnel_by(flags: DataFrame, dim: str) -> DataFrame:
    """Stage counts and rates by ``device_type``, ``referrer`` or ``time_of_day``."""
    n = F.count("*")
    viewed, carted, bought = (F.count_if(F.col(c)) for c in ("stage_view_product", "stage_add_to_cart", "stage_purchase"))
    return flags.groupBy(dim).agg(
        n.alias("total_sessions"), viewed.alias("viewed"), carted.alias("added_to_cart"), bought.alias("purchased"),
        pct(viewed, n).alias("view_rate_pct"), pct(carted, n).alias("cart_rate_pct"), pct(bought, n).alias("purchase_rate_pct"),
    ).orderBy(F.desc("purchase_rate_pct"), dim)


def funnel_rates_long(by_dim: DataFrame, dim: str) -> DataFrame:
    """The three rates as rows."""
    return by_dim.unpivot([dim], ["view_rate_pct", "cart_rate_pct", "purchase_rate_pct"], "stage", "rate")


def avg_purchase(flags: DataFrame, session_purchases: DataFrame) -> DataFrame:
    """Mean amount and items of converted sessions by device and referrer."""
    n = F.count("*")
    return with_purchases(flags.filter("stage_purchase"), session_purchases).groupBy("device_type", "referrer").agg(
        n.alias("purchases"), mean(F.sum("purchase_amount"), n, 2).alias("avg_amount"),
        mean(F.sum("items_purchased"), n, 1).alias("avg_items"),
    ).orderBy(F.desc("avg_amount"), "device_type", "referrer")


def cart_abandonment(flags: DataFrame) -> DataFrame:
    n, left = F.count("*"), F.count_if(F.col("conversion_status") == "abandoned")
    return flags.filter("stage_add_to_cart").agg(
        n.alias("cart_sessions"), left.alias("abandoned"), F.count_if("stage_purchase").alias("converted"),
        F.coalesce(pct(left, n), F.lit(0.0)).alias("abandonment_rate_pct"),
    )


def cart_abandonment_by_device(flags: DataFrame) -> DataFrame:
    n, left = F.count("*"), F.count_if(F.col("conversion_status") == "abandoned")
    return flags.filter("stage_add_to_cart").groupBy("device_type").agg(
        n.alias("cart_sessions"), left.alias("abandoned"), pct(left, n).alias("abandonment_rate_pct")
    ).orderBy(F.desc("abandonment_rate_pct"), "device_type")


def device_funnel(sessions: DataFrame) -> DataFrame:
    """Stage counts per device and overall, with the share of the first stage."""
    stages = {
        "total_sessions": F.count("*"),
        "viewed_products": F.count_if(F.col("viewed_products") > 0),
        "added_to_cart": F.count_if(F.col("cart_items") > 0),
        "converted": F.count_if(F.col("conversion_status") == "converted"),
    }
    per_device = sessions.groupBy("device_type").agg(*[c.alias(name) for name, c in stages.items()])
    totals = per_device.rollup("device_type").agg(
        F.grouping("device_type").alias("_all"), *[F.sum(name).alias(name) for name in stages]
    )
    n = F.col("total_sessions")
    return totals.select(
        F.when(F.col("_all") == 1, "overall").otherwise(F.initcap(F.coalesce("device_type", F.lit("unknown")))).alias("device"),
        "total_sessions", "viewed_products", "added_to_cart", "converted",
        pct("viewed_products", n).alias("viewed_pct"), pct("added_to_cart", n).alias("cart_pct"),
        pct("converted", n).alias("converted_pct"),
    )


def device_funnel_insight(sessions: DataFrame) -> DataFrame:
    """Overall conversion, cart conversion and abandonment, and the best converting device."""
    per_device = sessions.groupBy("device_type").agg(
        F.count("*").alias("n"), F.count_if(F.col("cart_items") > 0).alias("carts"),
        F.count_if(F.col("conversion_status") == "converted").alias("hits"),
    ).withColumn("rate", ratio("hits", "n"))
    best = F.struct(-F.col("rate"), "device_type")
    n, carts, hits = F.sum("n"), F.sum("carts"), F.sum("hits")
    return per_device.agg(
        pct(hits, n).alias("conversion_rate_pct"), F.coalesce(pct(hits, carts), F.lit(0.0)).alias("cart_to_conversion_pct"),
        F.coalesce(half_up((F.lit(1.0) - ratio(hits, carts)) * 100.0, 1), F.lit(0.0)).alias("cart_abandonment_pct"),
        F.initcap(F.min_by("device_type", best)).alias("best_device"),
        half_up(F.max("rate") * 100.0, 1).alias("best_device_rate_pct"),
    )
