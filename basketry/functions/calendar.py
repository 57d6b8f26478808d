"""Dates, months, weeks and hours of zone-free timestamps."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F

# Key space of the descending time part of a session row key (fixed value).
REVERSE_TIME_BASE = 9999999999999

# First hour (inclusive) of each part of the day (fixed values).
MORNING, AFTERNOON, EVENING, NIGHT = 6, 12, 18, 22


def parse_iso(col: str) -> Column:
    """ISO text ending in Z to a zone-free timestamp (UTC); unreadable text becomes NULL."""
    return F.regexp_replace(F.col(col), "Z$", "").try_cast("timestamp_ntz")


def plain_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a zone-free timestamp; formatting it as an instant could shift it."""
    return F.substring(ts.cast("string"), 1, 19)


def iso_text(ts: str) -> Column:
    """The text ``parse_iso`` reads."""
    return F.concat(F.translate(plain_text(F.col(ts)), " ", "T"), F.lit("Z"))


def year_month(ts: Column | str) -> Column:
    return F.date_format(ts, "yyyy-MM")


def week_start(ts: Column | str) -> Column:
    """Monday of the week."""
    return F.date_trunc("week", ts).cast("date")


def months_apart(later: Column, earlier: Column) -> Column:
    """Whole calendar months between two dates, ignoring the day."""
    return ((F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)).cast("int")


def time_of_day(hour: Column) -> Column:
    return (
        F.when((hour >= MORNING) & (hour < AFTERNOON), "morning")
        .when((hour >= AFTERNOON) & (hour < EVENING), "afternoon")
        .when((hour >= EVENING) & (hour < NIGHT), "evening")
        .otherwise("night")
    )


def epoch_micros(ts: str) -> Column:
    """Microseconds since 1970 of a zone-free timestamp. Built from its calendar
    parts: converting it to an instant would depend on the session zone."""
    seconds = (F.unix_date(F.to_date(ts)).cast("bigint") * 24 + F.hour(ts)) * 3600 + F.minute(ts) * 60
    return seconds * 1000000 + (F.extract(F.lit("SECOND"), F.col(ts)) * 1000000).cast("bigint")


def seconds_between(start: str, end: str) -> Column:
    """Whole seconds from ``start`` to ``end``."""
    return F.floor((epoch_micros(end) - epoch_micros(start)) / F.lit(1000000)).cast("bigint")


def epoch_millis(ts: str) -> Column:
    return F.floor(epoch_micros(ts) / F.lit(1000)).cast("bigint")


def session_row_key(user_id: str, ts: str) -> Column:
    """``user_reversedtime``: ascending key order is newest first within a user."""
    return F.concat_ws("_", F.col(user_id).cast("string"), (F.lit(REVERSE_TIME_BASE) - epoch_millis(ts)).cast("string"))


def row_key_user(key: Column | str) -> Column:
    """User part of a row key: everything before the last underscore."""
    return F.regexp_extract(key, "^(.*)_([^_]*)$", 1)


def by_date(df: DataFrame, start: date | None, end: date | None, column: str = "date") -> DataFrame:
    """Days from ``start`` to ``end``, both included, for date and timestamp columns alike."""
    if start is not None:
        df = df.filter(F.col(column) >= F.lit(start))
    if end is not None:
        df = df.filter(F.col(column) < F.lit(end + timedelta(days=1)))
    return df
