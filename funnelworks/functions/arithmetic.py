"""Exact numeric helpers.

Money, hours, rates and ratios stay in DECIMAL end to end: a double such as
1.005 does not round the way a decimal does, and the marts promise fixed-scale
decimals.  Divisions go through ``exact_ratio``, which takes exact operands and
keeps many fractional digits before the single final rounding cast.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from funnelworks.functions._col import as_col

MICROS_PER_HOUR = 3_600_000_000
MICROS_PER_DAY = 86_400_000_000

# Revenue model of the LTV estimate.
TAKE_RATE = Decimal("0.05")
SUBSCRIPTION_PER_MONTH = 500
MONTHS_PER_YEAR = 12


def decimal(col: Column | str, precision: int, scale: int) -> Column:
    return as_col(col).cast(f"decimal({precision},{scale})")


#: Type of every ratio: quotients of 10^24 or more raise.
RATIO_TYPE = "decimal(38,14)"
#: Operand types tried after the caller's: whole numbers (18 digits behind the point), large amounts (10).
WIDE = (((20, 0), (20, 0)), ((28, 2), (20, 2)))


def _exactly(col: Column, precision: int, scale: int) -> tuple[Column, Column]:
    """The value as decimal(precision, scale), and whether that is the same value."""
    n = col.try_cast(f"decimal({precision},{scale})")
    return n, n == col


def exact_ratio(
    num: Column | str,
    den: Column | str,
    num_type: tuple[int, int] = (30, 14),
    den_type: tuple[int, int] = (20, 8),
) -> Column:
    """num / den as decimal(38,14); null when den is 0 or either is null.

    Operands that fit their types without rounding are divided exactly:
    Spark's quotient keeps 38 digits less those that the types may need
    before the point, 14 behind it with the default types.  Larger operands
    that fit ``WIDE`` have at least 10.  All others (doubles
    such as 1/3, more than 14 fractional digits) are divided as doubles, so
    some 15 digits are right.  NaN, infinity and quotients of 10^24 or more
    raise.
    """
    n, d = as_col(num), as_col(den)
    exact = [(_exactly(n, *p), _exactly(d, *q)) for p, q in ((num_type, den_type), *WIDE)]
    ratio = F.when(n.isNull() | d.isNull() | (d == 0), F.lit(None).cast(RATIO_TYPE))
    for (x, same_x), (y, same_y) in exact:
        ratio = ratio.when(same_x & same_y, F.try_divide(x, y).cast(RATIO_TYPE))
    return ratio.otherwise(F.try_divide(n.cast("double"), d.cast("double")).cast(RATIO_TYPE))


def safe_divide(num: Column | str, den: Column | str) -> Column:
    """num / nullif(den, 0), for operands of any numeric type (``exact_ratio``)."""
    return exact_ratio(num, den)


def _micros_between(start: Column | str, end: Column | str) -> Column:
    return F.timestamp_diff("MICROSECOND", as_col(start), as_col(end)).cast("decimal(20,0)")


def hours_between(start: Column | str, end: Column | str) -> Column:
    """Fractional hours from start to end (negative when end is earlier);
    null when either side is null.  Exact decimal, no floating point."""
    return _micros_between(start, end) / F.lit(MICROS_PER_HOUR).cast("decimal(11,0)")


def days_between(start: Column | str, end: Column | str) -> Column:
    """Fractional days (hours / 24), computed from microseconds in one step."""
    return _micros_between(start, end) / F.lit(MICROS_PER_DAY).cast("decimal(12,0)")


def list_count(col: Column | str) -> Column:
    """Number of comma-separated items; null list → 0."""
    c = as_col(col)
    return F.when(c.isNull(), F.lit(0)).otherwise(F.size(F.split(c, ",")))


def ltv_estimate(gmv: Column | str) -> Column:
    """Annual LTV = monthly GMV x take rate x 12 + subscription x 12, decimal(12,2)."""
    g = as_col(gmv)
    value = g * F.lit(TAKE_RATE) * MONTHS_PER_YEAR + F.lit(SUBSCRIPTION_PER_MONTH * MONTHS_PER_YEAR)
    return F.when(g.isNotNull(), F.round(value, 2).cast("decimal(12,2)"))


def activity_density(total: Column | str, days: Column | str) -> Column:
    """round(total / greatest(days, 1), 4); null when either input is null."""
    t, d = as_col(total), as_col(days)
    ratio = exact_ratio(t, F.greatest(d, F.lit(Decimal("1.00"))))
    return F.when(t.isNotNull() & d.isNotNull(), F.round(ratio, 4))
