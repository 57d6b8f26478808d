"""Money, rounding and rates.

Row-level amounts are whole cents (BIGINT): sums are exact, do not depend on the
order in which partitions are merged, and cost a third of a DECIMAL sum in time
and shuffle bytes. ``sum_money`` turns every first-level sum into a DECIMAL
amount, so totals over all groups cannot overflow. Means and rates are taken as
doubles at the very end.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,2)"
SUM_UNITS = 10000.0  # per 1, in ``exact_sum``


def money(col: Column | str) -> Column:
    """Amount with two decimals."""
    return _col(col).cast(MONEY)


def cents(col: Column | str) -> Column:
    """Amount as whole cents, rounded half up."""
    return F.floor(dbl(col) * 100.0 + 0.5)


def units(col: Column | str, digits: int = 2) -> Column:
    """Whole number of 10^-digits parts (cents by default) as an exact amount."""
    part = Decimal(1).scaleb(-digits)
    return (_col(col).cast("decimal(20,0)") * F.lit(part)).cast(f"decimal({18 + digits},{digits})")


def sum_money(cents_col: Column | str, digits: int = 2) -> Column:
    """Aggregate: sum of cents as an amount."""
    return units(F.sum(cents_col), digits)


def whole(col: Column | str) -> Column:
    """A BIGINT as a decimal, for products that do not fit a BIGINT."""
    return _col(col).cast("decimal(19,0)")


def sum_squares(col: Column | str) -> Column:
    """Aggregate: exact sum of the squares of BIGINT values."""
    return F.sum((whole(col) * whole(col)).cast("decimal(38,0)"))


def exact_sum(col: Column | str) -> Column:
    """Aggregate: sum of doubles, each rounded half up to four decimals, in that unit; the order of rows does not matter."""
    return F.sum(F.floor(dbl(col) * SUM_UNITS + 0.5).cast("decimal(20,0)"))


def dbl(col: Column | str) -> Column:
    return _col(col).cast("double")


def half_up(col: Column | str, digits: int) -> Column:
    """Round a double half up; the same IEEE steps give the same bits anywhere."""
    scale = float(10**digits)
    return F.floor(dbl(col) * scale + 0.5).cast("double") / scale


def half_up_money(col: Column | str) -> Column:
    """Half-up rounding to two decimals as an exact amount."""
    return half_up(col, 2).cast(MONEY)


def ratio(num: Column | str, den: Column | str) -> Column:
    """Double division; NULL when the denominator is zero."""
    return F.try_divide(dbl(num), dbl(den))


def mean(total: Column | str, n: Column | str, digits: int) -> Column:
    return half_up(ratio(total, n), digits)


def pct(num: Column | str, den: Column | str, digits: int = 1) -> Column:
    return half_up(ratio(num, den) * 100.0, digits)


def rate_of(flag: Column, digits: int = 1) -> Column:
    """Aggregate: share of rows (percent) for which ``flag`` holds."""
    return pct(F.count_if(flag), F.count("*"), digits)


def sample_stddev(n: Column, total: Column, total_sq: Column) -> Column:
    """Sample standard deviation from exact sums; NULL for fewer than two rows."""
    spread = dbl(n * total_sq - total * total)
    return F.sqrt(ratio(spread, n * (n - F.lit(1))))


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col
