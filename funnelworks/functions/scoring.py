"""Rule-based lead tiers and inclusive-upper-bound hour bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from funnelworks.functions._col import as_col

# Tier thresholds (hours to first contact, monthly GMV p75).
FAST_CONTACT_HOURS = 72
HIGH_GMV_USD = 6279

# Band upper bounds (inclusive) and labels, in order.
SPEED_BANDS = [(24, "1_le_24h"), (72, "2_24_to_72h"), (168, "3_72_to_168h")]
SPEED_OVERFLOW = "4_gt_168h"
RECENCY_BANDS = [(168, "1_contacted_le_1_week"), (720, "2_contacted_1w_to_1mo"), (8760, "3_contacted_1mo_to_1yr")]
RECENCY_OVERFLOW = "4_stale_gt_1yr"


def conversion_tier(
    is_converted: Column | str,
    is_disqualified: Column | str,
    connected: Column | str,
    total_activity: Column | str,
    speed_hours: Column | str,
    gmv: Column | str,
    fast_hours: float = FAST_CONTACT_HOURS,
    high_gmv: float = HIGH_GMV_USD,
) -> Column:
    """First matching rule wins: converted, disqualified (null tier), hot,
    warm, cold.  A null signal simply does not qualify; the other may."""
    return (
        F.when(as_col(is_converted) == F.lit(True), F.lit("converted"))
        .when(as_col(is_disqualified), F.lit(None).cast("string"))
        .when(as_col(connected) == F.lit(True), F.lit("hot"))
        .when(
            (as_col(total_activity) > 0)
            & ((as_col(speed_hours) <= F.lit(fast_hours)) | (as_col(gmv) > F.lit(high_gmv))),
            F.lit("warm"),
        )
        .otherwise(F.lit("cold"))
    )


def band(col: Column | str, bands, overflow: str) -> Column:
    """Label of the first band whose inclusive upper bound holds; the overflow
    label above the last bound; null for null input."""
    c = as_col(col)
    out = None
    for upper, label in bands:
        cond = c <= F.lit(upper)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.when(c > F.lit(bands[-1][0]), F.lit(overflow))


def speed_bucket(col: Column | str) -> Column:
    return band(col, SPEED_BANDS, SPEED_OVERFLOW)


def recency_bucket(col: Column | str) -> Column:
    return band(col, RECENCY_BANDS, RECENCY_OVERFLOW)
