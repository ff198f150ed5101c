"""Calendar helpers: month truncation and the channel-aware cohort month."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from funnelworks.functions._col import as_col

# Channel labels.
INBOUND = "inbound"
OUTBOUND = "outbound"


def month_trunc(col: Column | str) -> Column:
    """First day of the month of a date or timestamp, as DATE."""
    return F.trunc(as_col(col).cast("date"), "month")


def derive_channel(form_date: Column | str) -> Column:
    """A form submission means the lead came in; no form means outreach."""
    return F.when(as_col(form_date).isNotNull(), F.lit(INBOUND)).otherwise(F.lit(OUTBOUND))


def cohort_month(channel: Column | str, form_date: Column | str, first_call: Column | str) -> Column:
    """Funnel entry month: form month for inbound, first-call month otherwise."""
    return F.when(as_col(channel) == INBOUND, month_trunc(form_date)).otherwise(month_trunc(first_call))


def has_cohort_anchor(channel: Column | str, form_date: Column | str, first_call: Column | str) -> Column:
    """The channel's entry timestamp is present."""
    ch = as_col(channel)
    return ((ch == INBOUND) & as_col(form_date).isNotNull()) | (
        (ch == OUTBOUND) & as_col(first_call).isNotNull()
    )


def date_spine(spark, start: str, end_exclusive: str, column: str = "date_day"):
    """One row per day in [start, end_exclusive)."""
    return spark.range(1).select(
        F.explode(
            F.sequence(
                F.to_date(F.lit(start)),
                F.date_sub(F.to_date(F.lit(end_exclusive)), 1),
                F.expr("INTERVAL 1 DAY"),
            )
        ).alias(column)
    )
