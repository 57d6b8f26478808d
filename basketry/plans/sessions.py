"""Session behaviour, conversion and page flow."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from basketry.functions.numeric import half_up, mean, pct, rate_of, ratio
from basketry.operators.adjacency import transition_counts
from basketry.operators.quantiles import summary_by
from basketry.plans.cohort import matrix

CONVERTED, ABANDONED, BROWSING = "converted", "abandoned", "browsing"


def is_converted() -> Column:
    return F.col("conversion_status") == CONVERTED


def device_behaviour(sessions: DataFrame) -> DataFrame:
    n = F.count("*")
    return sessions.groupBy("device_type", F.col("device_os").alias("os")).agg(
        n.alias("session_count"),
        mean(F.sum("duration_seconds"), n, 0).alias("avg_duration_sec"),
        mean(F.sum("page_views"), n, 1).alias("avg_pages_per_session"),
        mean(F.sum("viewed_products"), n, 1).alias("avg_products_viewed"),
        rate_of(is_converted()).alias("conversion_rate_pct"),
    ).orderBy(F.desc("session_count"), "device_type", "os")


def funnel_overview(sessions: DataFrame) -> DataFrame:
    """One row. "Cart" here means the session ended converted or abandoned."""
    in_cart = F.count_if(F.col("conversion_status").isin(CONVERTED, ABANDONED))
    browsed, bought, n = F.count_if(F.col("viewed_products") > 0), F.count_if(is_converted()), F.count("*")
    return sessions.agg(
        n.alias("total_sessions"),
        browsed.alias("browsed_products"), pct(browsed, n).alias("browse_rate_pct"),
        in_cart.alias("added_to_cart"), pct(in_cart, n).alias("cart_rate_pct"),
        bought.alias("converted"), pct(bought, n).alias("conversion_rate_pct"),
        pct(bought, in_cart).alias("cart_to_purchase_pct"),
    )


def session_filter(sessions: DataFrame, devices: Sequence[str] | None = None, referrers: Sequence[str] | None = None) -> DataFrame:
    """Keep the chosen devices and referrers; ``None`` keeps all."""
    for column, chosen in (("device_type", devices), ("referrer", referrers)):
        if chosen is not None:
            sessions = sessions.filter(F.col(column).isin(*chosen))
    return sessions


def status_counts(sessions: DataFrame) -> DataFrame:
    n = F.count("*")
    columns = []
    for status in (CONVERTED, ABANDONED, BROWSING):
        hits = F.count_if(F.col("conversion_status") == status)
        columns += [hits.alias(status), pct(hits, n).alias(f"{status}_pct")]
    return sessions.agg(n.alias("total"), *columns)


def stage_counts(sessions: DataFrame) -> DataFrame:
    """``stage, count`` in funnel order. "Cart" here means a non-empty cart."""
    totals = sessions.agg(
        F.count("*").alias("Total Sessions"), F.count_if(F.col("viewed_products") > 0).alias("Viewed Products"),
        F.count_if(F.col("cart_items") > 0).alias("Added to Cart"), F.count_if(is_converted()).alias("Purchased"),
    )
    return totals.unpivot([], totals.columns, "stage", "count")


def conversion_by(sessions: DataFrame, dim: str, with_duration: bool = False) -> DataFrame:
    """Sessions, conversions and rate by a session attribute (``hour`` = hour of the start)."""
    key = F.hour("start_time").alias("hour") if dim == "hour" else F.col(dim)
    n, hits = F.count("*"), F.count_if(is_converted())
    extra = [mean(F.sum("duration_seconds"), n, 2).alias("avg_duration")] if with_duration else []
    return sessions.groupBy(key).agg(
        n.alias("sessions"), hits.alias("conversions"), half_up(ratio(hits, n) * 100.0, 4).alias("conv_rate"), *extra
    ).orderBy(dim)


def session_flow(sessions: DataFrame) -> DataFrame:
    """Sessions per (referrer, device, outcome)."""
    return sessions.groupBy("referrer", "device_type", "conversion_status").agg(F.count("*").alias("count"))


def session_flow_edges(sessions: DataFrame) -> DataFrame:
    """Two-hop edges referrer -> device -> outcome. Both hops come out of one
    aggregation: the triples are few, each adds its count to two edges."""
    hops = F.array(
        F.struct(F.lit("referrer_device").alias("hop"), F.col("referrer").alias("source"), F.col("device_type").alias("target")),
        F.struct(F.lit("device_status").alias("hop"), F.col("device_type").alias("source"), F.col("conversion_status").alias("target")),
    )
    return session_flow(sessions).select(F.explode(hops).alias("e"), "count").select("e.*", "count").groupBy(
        "hop", "source", "target"
    ).agg(F.sum("count").alias("count"))


def device_os_rates(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy("device_type", "device_os").agg(rate_of(is_converted()).alias("rate"))


def device_os_matrix(sessions: DataFrame, systems: Sequence[str]) -> DataFrame:
    """Conversion rate with one column per operating system, 0 where there are no sessions."""
    wide = device_os_rates(sessions).groupBy("device_type").pivot("device_os", list(systems)).agg(F.max("rate"))
    return wide.na.fill(0.0).orderBy("device_type")


def device_os_map(sessions: DataFrame) -> DataFrame:
    """Conversion rate per device type as a map over every operating system that occurs, none of them stated before;
    sessions without one count as Unknown."""
    known = sessions.withColumn("device_os", F.coalesce("device_os", F.lit("Unknown")))
    return matrix(device_os_rates(known), "device_type", "device_os", "rate")


def page_type_filter(page_views: DataFrame, page_types: Sequence[str] | None = None) -> DataFrame:
    return page_views if page_types is None else page_views.filter(F.col("page_type").isin(*page_types))


def page_view_kpis(page_views: DataFrame) -> DataFrame:
    """Totals, mean views per session, mean duration and the most viewed page type (ties: first by name)."""
    per_session = page_views.groupBy("session_id").agg(
        F.count("*").alias("n"), F.sum("view_duration").alias("spent"), F.count("view_duration").alias("timed")
    )
    types = page_views.groupBy("page_type").agg(F.count("*").alias("n"))
    top_type = types.agg(F.min_by("page_type", F.struct(-F.col("n"), "page_type")).alias("t"))
    return per_session.agg(
        F.sum("n").alias("total_views"), mean(F.sum("n"), F.count("*"), 2).alias("avg_views_per_session"),
        mean(F.sum("spent"), F.sum("timed"), 2).alias("avg_duration"),
    ).withColumn("top_page_type", top_type.scalar())


def page_type_stats(page_views: DataFrame) -> DataFrame:
    """Views, mean duration, extremes and exact quartiles of the duration per page type."""
    extra = {
        "views": F.count("*"),
        "avg_duration": mean(F.sum("view_duration"), F.count("view_duration"), 2),
    }
    return summary_by(page_views, "view_duration", "page_type", extra=extra).drop("n").orderBy("page_type")


def daily_page_views(page_views: DataFrame) -> DataFrame:
    return page_views.groupBy("date", "page_type").agg(F.count("*").alias("views")).orderBy("date", "page_type")


def page_transitions(page_views: DataFrame) -> DataFrame:
    """How often one page type follows another within a session."""
    return transition_counts(page_views, "session_id", ["timestamp", "view_id"], "page_type")


def nested_page_transitions(sessions: DataFrame) -> DataFrame:
    """The same for session documents: pairs inside the row's own list, no shuffle before the count."""
    types, steps = F.col("page_views.page_type"), F.size("page_views") - 1
    pairs = F.arrays_zip(F.slice(types, F.lit(1), steps), F.slice(types, F.lit(2), steps))
    return sessions.filter(F.size("page_views") > 1).select(F.inline(pairs).alias("source", "target")).groupBy(
        F.coalesce("source", F.lit("unknown")).alias("source"), F.coalesce("target", F.lit("unknown")).alias("target")
    ).agg(F.count("*").alias("count"))
