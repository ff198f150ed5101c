"""Claim-validation analyses over the enriched leads and the marts.

All of them aggregate month- or band-grain results with partial aggregation,
or filter a month-grain mart; none collects anything to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from funnelworks.functions import exact_ratio, month_trunc, recency_bucket, speed_bucket

INBOUND, OUTBOUND = "inbound", "outbound"
# The analysed window and month.
WINDOW_START, WINDOW_END = "2024-01-01", "2024-06-01"
DEFAULT_MONTH = "2024-07-01"


def _rate(num, den, scale: int, precision: int = 7):
    return F.round(exact_ratio(num, den), scale).cast(f"decimal({precision},{scale})")


def speed_buckets(enriched: DataFrame) -> DataFrame:
    """Inbound leads with a positive speed, by contact-speed band."""
    speed = F.col("speed_to_first_contact_hours")
    rows = enriched.filter((F.col("channel") == INBOUND) & speed.isNotNull() & (speed > 0))
    conv = F.count_if(F.col("is_converted") == F.lit(True))
    won = F.count_if(F.col("is_won") == F.lit(True))
    n = F.count(F.lit(1))
    return rows.groupBy(speed_bucket(speed).alias("speed_bucket")).agg(
        n.alias("leads"),
        conv.alias("converted"),
        won.alias("won"),
        _rate(conv, n, 3).alias("conversion_rate"),
        _rate(won, n, 3).alias("won_rate"),
        F.round(exact_ratio(F.sum(speed), F.count(speed)), 1).cast("decimal(12,1)").alias("avg_speed_hours"),
    ).orderBy("speed_bucket")


def recency_buckets(enriched: DataFrame) -> DataFrame:
    """Inbound leads with a positive speed, by wider recency band."""
    speed = F.col("speed_to_first_contact_hours")
    rows = enriched.filter((F.col("channel") == INBOUND) & (speed > 0))
    conv = F.count_if(F.col("is_converted") == F.lit(True))
    n = F.count(F.lit(1))
    return rows.groupBy(recency_bucket(speed).alias("recency_bucket")).agg(
        n.alias("leads"),
        conv.alias("converted"),
        _rate(conv, n, 3).alias("conversion_rate"),
        F.round(F.min(speed), 0).cast("decimal(12,0)").alias("min_hours"),
        F.round(F.max(speed), 0).cast("decimal(12,0)").alias("max_hours"),
    ).orderBy("min_hours")


def month_completeness(enriched: DataFrame, month: str = DEFAULT_MONTH) -> DataFrame:
    """Volume, wins and entry/activity date range per channel for one cohort month."""
    ch = F.col("channel")
    form, call = F.col("form_submission_date"), F.col("first_sales_call_at")
    m = F.lit(month).cast("date")
    rows = enriched.filter(
        ((ch == INBOUND) & (month_trunc(form) == m)) | ((ch == OUTBOUND) & (month_trunc(call) == m))
    )
    entry = F.when(ch == INBOUND, form).otherwise(call.cast("date"))
    won = F.count_if(F.col("is_won") == F.lit(True))
    n = F.count(F.lit(1))
    return rows.groupBy("channel").agg(
        n.alias("leads_created"),
        won.alias("closed_won"),
        _rate(won, n, 4, 8).alias("conversion_rate"),
        F.min(entry).alias("earliest_entry"),
        F.max(entry).alias("latest_entry"),
        F.max(F.col("last_sales_activity_at").cast("date")).alias("latest_activity"),
    )


def won_detail(enriched: DataFrame, month: str = DEFAULT_MONTH) -> DataFrame:
    """Outbound leads of a cohort month whose opportunity was won.  Enriched
    rows already carry their (deduplicated, unique-id) opportunity's columns,
    so no second join to opportunities is needed."""
    call = F.col("first_sales_call_at")
    return enriched.filter(
        (month_trunc(call) == F.lit(month).cast("date"))
        & (F.col("channel") == OUTBOUND)
        & (F.col("is_won") == F.lit(True))
    ).select(
        "lead_id",
        call.cast("date").alias("entry_date"),
        "close_date",
        "stage_name",
        "demo_set_date",
        "demo_held",
        "total_activity_count",
        "days_in_funnel",
    )


def funnel_stage_rates(gtm_funnel: DataFrame, channel: str = OUTBOUND) -> DataFrame:
    return gtm_funnel.filter(
        (F.col("channel") == channel) & F.col("month_date").between(F.lit(WINDOW_START), F.lit(WINDOW_END))
    ).select(
        "month_date",
        "channel",
        "leads_created",
        "demos_set",
        "demos_held",
        "closed_won",
        "lead_to_demo_set_rate",
        "demo_set_to_held_rate",
        "demo_to_close_rate",
        "overall_conversion_rate",
    ).orderBy("month_date")


def headcount_trend(expenses: DataFrame, cac_ltv: DataFrame, channel: str = OUTBOUND) -> DataFrame:
    """Headcount cost next to wins and CAC, with growth against the first
    month.  Both inputs are month-grain, so the global window is tiny."""
    e = expenses.filter(F.col("channel") == channel).select(
        "month_date", F.col("salary_and_commissions_usd").alias("headcount_cost_usd"), "total_cost_usd"
    )
    c = cac_ltv.filter(F.col("channel") == channel).select(
        "month_date", "new_customers_won", "cac_usd", "cac_ltv_ratio"
    )
    j = e.join(c, "month_date", "inner")
    cost = F.col("headcount_cost_usd")
    first = F.first(cost).over(Window.orderBy("month_date"))
    growth = F.round(exact_ratio((cost - first) * 100, first), 1).cast("decimal(8,1)")
    return j.select(
        "month_date",
        "headcount_cost_usd",
        "total_cost_usd",
        "new_customers_won",
        "cac_usd",
        "cac_ltv_ratio",
        growth.alias("headcount_cost_growth_pct"),
    ).orderBy("month_date")
