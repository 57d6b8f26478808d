"""The three customer tier schemes. They differ on purpose; see each docstring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Spend buckets, lower bound inclusive, upper bound exclusive (fixed values).
SPEND_BOUNDS = (0, 1, 5000, 20000, 50000, 1000000)
SPEND_LABELS = ("Inactive", "Low", "Regular", "High", "VIP")

# Lifetime value thresholds (fixed values).
CLV_BOUNDS = (5000, 2000, 500)
CLV_LABELS = ("Platinum", "Gold", "Silver", "Bronze")

# Segment thresholds by spend of users with orders (fixed values).
SEGMENT_BOUNDS = (5000, 2000)
SEGMENT_LABELS = ("VIP", "Regular", "Low", "Inactive")

OTHER = "Other"


def spend_bucket(spent: Column, bounds: Sequence[float] = SPEND_BOUNDS) -> Column:
    """Index of the bucket holding ``spent``; the index after the last one when none does."""
    out = F.lit(len(bounds) - 1)
    for i in range(len(bounds) - 2, -1, -1):
        out = F.when((spent >= bounds[i]) & (spent < bounds[i + 1]), i).otherwise(out)
    return out


def spend_label(bucket: Column, labels: Sequence[str] = SPEND_LABELS) -> Column:
    return F.coalesce(F.get(F.array(*[F.lit(x) for x in labels]), bucket), F.lit(OTHER))


def clv_tier(clv: Column, bounds: Sequence[float] = CLV_BOUNDS) -> Column:
    """By lifetime value; a missing value counts as the lowest tier."""
    platinum, gold, silver = bounds
    return (
        F.when(clv >= platinum, CLV_LABELS[0])
        .when(clv >= gold, CLV_LABELS[1])
        .when(clv >= silver, CLV_LABELS[2])
        .otherwise(CLV_LABELS[3])
    )


def segment(spent: Column, orders: Column, bounds: Sequence[float] = SEGMENT_BOUNDS) -> Column:
    """By orders first, then spend: a user without orders is Inactive whatever the spend."""
    vip, regular = bounds
    return (
        F.when(orders == 0, "Inactive").when(spent >= vip, "VIP").when(spent >= regular, "Regular").otherwise("Low")
    )


def segment_rank(tier: Column) -> Column:
    """Display order of the segments, starting at 1."""
    return F.array_position(F.array(*[F.lit(x) for x in SEGMENT_LABELS]), tier)
