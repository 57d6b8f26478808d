"""Reads by key: a user's sessions, key-ordered scans, a product's days.

``stored_*`` read the session table of ``etl.warehouse``, which is ordered by the text of its row key: a user's rows
share a prefix and stand together, newest first, so the prefix filter skips all other row groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from basketry.functions.calendar import row_key_user, session_row_key

DETAIL = (
    "session_id", "user_id", "start_time", "end_time", "duration_seconds", "conversion_status", "referrer",
    "device_type", "device_os", "browser", "city", "province", "country", "viewed_products", "cart_items",
)


def user_sessions(sessions: DataFrame, user_id, limit: int = 10) -> DataFrame:
    """Newest sessions of one user."""
    mine = sessions.filter(F.col("user_id") == F.lit(user_id))
    return mine.select(*DETAIL).orderBy(F.desc("start_time"), "session_id").limit(limit)


def sessions_by_key(sessions: DataFrame, limit: int) -> DataFrame:
    """First rows in key order: by user text, newest first within a user."""
    keyed = sessions.select(
        session_row_key("user_id", "start_time").alias("row_key"), "session_id", "conversion_status", "duration_seconds"
    )
    return keyed.withColumn("user_id", row_key_user("row_key")).orderBy("row_key", "session_id").limit(limit)


def stored_user_sessions(stored: DataFrame, user_id, limit: int = 10) -> DataFrame:
    """Newest sessions of one user from the key-ordered table."""
    mine = stored.filter(F.col("row_key").startswith(f"{user_id}_"))
    return mine.select(*DETAIL).orderBy(F.desc("start_time"), "session_id").limit(limit)


def bucketed_user_sessions(stored: DataFrame, user_id, limit: int = 10) -> DataFrame:
    """Newest sessions of one user from the table bucketed by user: only the files of one bucket are opened."""
    return user_sessions(stored, user_id, limit)


def stored_sessions_by_key(stored: DataFrame, limit: int) -> DataFrame:
    """First rows of the key-ordered table."""
    first = stored.select("row_key", "session_id", "conversion_status", "duration_seconds").orderBy("row_key", "session_id").limit(limit)
    return first.withColumn("user_id", row_key_user("row_key"))


def recent_sessions(sessions: DataFrame, limit: int) -> DataFrame:
    """Newest sessions of all users."""
    return sessions.select("session_id", "user_id", "start_time", "conversion_status", "duration_seconds").orderBy(
        F.desc("start_time"), "session_id"
    ).limit(limit)


def product_metrics_for(metrics: DataFrame, product_id) -> DataFrame:
    """Daily rows of one product, oldest first."""
    return metrics.filter(F.col("product_id") == F.lit(product_id)).orderBy("date")


def product_metrics_summary(metrics: DataFrame, product_id) -> DataFrame:
    return metrics.filter(F.col("product_id") == F.lit(product_id)).agg(
        F.count("*").alias("days"), F.sum("total_quantity").alias("total_units"), F.sum("total_revenue").alias("total_revenue")
    )
