"""Intermediate models: expenses by channel-month, enriched leads, cohort
funnel, restaurant profile, audit findings by month.

Scale notes
* The only large join is leads ⟕ opportunities (``int_leads_enriched``).
  Null opportunity ids (most leads) are spread instead of landing in one
  partition; AQE chooses broadcast vs sort-merge from runtime sizes and splits
  hot keys.
* Everything month-grain is produced by partially aggregated group-bys, so a
  shuffle carries at most (#map tasks × #months × 2) rows.  How month-grain
  frames are joined is left to the runtime sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from funnelworks.functions import (
    cohort_month,
    days_between,
    derive_channel,
    exact_ratio,
    has_cohort_anchor,
    hours_between,
    list_count,
    ltv_estimate,
    month_trunc,
    surrogate_key,
)
from funnelworks.operators.contracts import enforce_contract
from funnelworks.operators.joins import left_join_keyed, left_join_spread_nulls
from funnelworks.plans import contracts_catalog as C
from funnelworks.plans.audits import OPP_DETAILS

INBOUND = "inbound"


def int_expenses_channel_month(salary: DataFrame, advertising: DataFrame) -> DataFrame:
    """Salary per month × channel plus advertising, which is attributed to
    inbound only (outbound gets 0).  Advertising is month-grain (one row per
    calendar month); its join strategy is left to the measured size."""
    ads = advertising.select(F.col("month_date").alias("ad_month"), "advertising_spend_usd")
    joined = salary.join(ads, salary["month_date"] == ads["ad_month"], "left")
    ad = F.when(
        F.col("sales_channel") == INBOUND, F.coalesce(F.col("advertising_spend_usd"), F.lit(0).cast("decimal(20,2)"))
    ).otherwise(F.lit(0).cast("decimal(20,2)"))
    df = joined.select(
        surrogate_key("month_date", "sales_channel").alias("expense_channel_month_sk"),
        "month_date",
        F.col("sales_channel").alias("channel"),
        "salary_and_commissions_usd",
        ad.cast("decimal(20,2)").alias("advertising_spend_usd"),
        (F.col("salary_and_commissions_usd") + ad).cast("decimal(20,2)").alias("total_cost_usd"),
    )
    return enforce_contract(df, C.INT_EXPENSES_CHANNEL_MONTH)


def int_leads_enriched(leads: DataFrame, opportunities: DataFrame, stored: bool = False) -> DataFrame:
    """``stored``: leads are narrow maps over a stored table, so reading it twice
    is cheaper than shuffling the leads without an opportunity."""
    opp = opportunities.select(
        "opportunity_sk",
        F.col("opportunity_id").alias("o_opportunity_id"),
        "account_id",
        "stage_name",
        "is_won",
        "is_lost",
        "is_open",
        "attribution_source",
        "lost_reason",
        "demo_held",
        "demo_set_date",
        "close_date",
        F.col("created_at").alias("opportunity_created_at"),
        "demo_scheduled_at",
        F.col("last_sales_call_at").alias("opp_last_sales_call_at"),
    )
    on = ("converted_opportunity_id", "o_opportunity_id")
    j = left_join_keyed(leads, opp, *on) if stored else left_join_spread_nulls(leads, opp, *on, ["lead_id"])
    form = F.col("form_submission_date")
    form_ts = form.cast("timestamp_ntz")
    speed = F.when(form.isNotNull(), hours_between(form_ts, "first_sales_call_at").cast("decimal(10,2)"))
    days = F.when(form.isNotNull(), days_between(form_ts, "last_sales_activity_at")).otherwise(
        days_between("first_sales_call_at", "last_sales_activity_at")
    )
    df = j.select(
        *[c for c in C.INT_LEADS_ENRICHED.fieldNames() if c not in ("channel", "speed_to_first_contact_hours", "days_in_funnel")],
        derive_channel(form).alias("channel"),
        speed.alias("speed_to_first_contact_hours"),
        days.cast("decimal(8,2)").alias("days_in_funnel"),
    )
    return enforce_contract(df, C.INT_LEADS_ENRICHED)


def cohort_stats(enriched: DataFrame, since=None) -> DataFrame:
    """Every month × channel measure the funnel, CAC/LTV and engagement marts
    need, from ONE partially aggregated group-by over enriched leads that
    carry their channel's anchor date.  Averages are kept as (sum, count)
    pairs so the marts can divide once, exactly.  ``since`` (a date Column)
    keeps only cohort months on or after it."""
    ch = F.col("channel")
    anchored = enriched.filter(has_cohort_anchor(ch, "form_submission_date", "first_sales_call_at"))
    month = cohort_month(ch, "form_submission_date", "first_sales_call_at")
    if since is not None:
        # Lookback applied to rows before aggregating, so counts and the
        # won-lead LTV averages of a reprocessed month stay consistent.
        anchored = anchored.filter(month >= since)
    rows = anchored.select(
        month.alias("month_date"),
        ch,
        "demo_set_date",
        "demo_held",
        "is_won",
        "is_lost",
        "is_converted",
        "predicted_monthly_gmv_usd",
        ltv_estimate("predicted_monthly_gmv_usd").alias("ltv"),
        "speed_to_first_contact_hours",
        "days_in_funnel",
        "total_activity_count",
    )
    won = F.col("is_won") == F.lit(True)
    conv = F.col("is_converted") == F.lit(True)
    won_gmv = F.when(won, F.col("predicted_monthly_gmv_usd"))
    won_ltv = F.when(won, F.col("ltv"))
    conv_speed = F.when(conv, F.col("speed_to_first_contact_hours"))
    conv_days = F.when(conv, F.col("days_in_funnel"))
    return rows.groupBy("month_date", "channel").agg(
        F.count(F.lit(1)).alias("leads_created"),
        F.count("demo_set_date").alias("demos_set"),
        F.count_if(F.col("demo_held") == F.lit(True)).alias("demos_held"),
        F.count_if(won).alias("closed_won"),
        F.count_if(F.col("is_lost") == F.lit(True)).alias("closed_lost"),
        F.sum(won_gmv).alias("won_gmv_sum"),
        F.count(won_gmv).alias("won_gmv_n"),
        F.sum(won_ltv).alias("won_ltv_sum"),
        F.count(won_ltv).alias("won_ltv_n"),
        F.sum(conv_speed).alias("conv_speed_sum"),
        F.count(conv_speed).alias("conv_speed_n"),
        F.sum(conv_days).alias("conv_days_sum"),
        F.count(conv_days).alias("conv_days_n"),
        F.sum("total_activity_count").alias("activity_sum"),
        F.count("total_activity_count").alias("activity_n"),
    )


def funnel_rates(stats: DataFrame) -> list:
    return [
        exact_ratio("demos_set", "leads_created").cast("decimal(6,4)").alias("lead_to_demo_set_rate"),
        exact_ratio("demos_held", "demos_set").cast("decimal(8,4)").alias("demo_set_to_held_rate"),
        exact_ratio("closed_won", "demos_held").cast("decimal(6,4)").alias("demo_to_close_rate"),
        exact_ratio("closed_won", "leads_created").cast("decimal(6,4)").alias("overall_conversion_rate"),
    ]


def int_funnel(enriched: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    stats = cohort_stats(enriched) if stats is None else stats
    df = stats.select(
        surrogate_key("month_date", "channel").alias("funnel_channel_month_sk"),
        "month_date",
        "channel",
        "leads_created",
        "demos_set",
        "demos_held",
        "closed_won",
        "closed_lost",
        *funnel_rates(stats),
    )
    return enforce_contract(df, C.INT_FUNNEL)


def int_restaurant_profile(enriched: DataFrame) -> DataFrame:
    df = enriched.select(
        "lead_sk",
        "lead_id",
        "channel",
        "is_converted",
        "is_won",
        "location_count",
        "cuisine_types_cleaned",
        list_count("marketplaces_used_cleaned").alias("marketplace_count"),
        F.col("olo_tools_cleaned").isNotNull().alias("has_olo_tool"),
        "predicted_monthly_gmv_usd",
        ltv_estimate("predicted_monthly_gmv_usd").alias("estimated_annual_ltv_usd"),
    )
    return enforce_contract(df, C.INT_RESTAURANT_PROFILE)


def _monthly_findings(rows: DataFrame, source_table: str) -> DataFrame:
    """rows(month_date, record_key, audit_category) with volume markers
    (null category) → one row per month × category with the month's volume.
    Finding counts, distinct affected records and volumes come from ONE
    aggregate; the volume is attached with a window over that (month ×
    category-grain, tiny) aggregate, so the source is scanned once — a second
    filtered use of the aggregate would be pushed below it and re-scan."""
    cat = F.col("audit_category")
    agg = rows.groupBy("month_date", "audit_category").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct(F.when(cat.isNotNull(), F.col("record_key"))).alias("affected_records"),
    )
    per_month = Window.partitionBy("month_date")
    with_volume = agg.withColumn("monthly_record_count", F.max(F.when(cat.isNull(), F.col("n"))).over(per_month))
    return with_volume.filter(cat.isNotNull()).select(
        "month_date",
        F.lit(source_table).alias("source_table"),
        "audit_category",
        F.col("n").alias("finding_count"),
        "affected_records",
        "monthly_record_count",
    )


def _monthly_counts(rows: DataFrame, source_table: str, categories: Sequence[str]) -> DataFrame:
    """rows(month_date, record_key, in_scope, <count per category>), one row
    per month and record → one row per month × category.  A record is one row of
    its month, so affected records need no distinct count."""
    known = F.col("record_key").isNotNull()
    per_month = rows.groupBy("month_date").agg(
        F.sum("in_scope").alias("monthly_record_count"),
        *[F.sum(c).alias(c) for c in categories],
        *[F.count_if((F.col(c) > 0) & known).alias(f"{c}_records") for c in categories],
    )
    found = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("audit_category"),
                    F.col(c).alias("finding_count"),
                    F.col(f"{c}_records").alias("affected_records"),
                )
                for c in categories
            ]
        )
    )
    return (
        per_month.select("month_date", F.lit(source_table).alias("source_table"), "monthly_record_count", found.alias("f"))
        .select("month_date", "source_table", "f.*", "monthly_record_count")
        .filter(F.col("finding_count") > 0)
    )


def int_audit_by_month(lead_rows: DataFrame, opp_rows: DataFrame) -> DataFrame:
    """Audit findings per month × source × category, with the source's
    monthly record volume and the affected share.  Each finding carries the
    anchor month of the source row it came from (form date for leads, creation
    date for opportunities); findings without an anchor are dropped.  Inputs
    are ``audits.lead_rows_dated`` / ``audits.opp_rows_dated``: one pass per
    source yields both findings and volumes."""
    unioned = _monthly_findings(lead_rows, "leads").unionByName(
        _monthly_counts(opp_rows, "opportunities", list(OPP_DETAILS))
    )
    df = unioned.select(
        surrogate_key("month_date", "source_table", "audit_category").alias("audit_month_sk"),
        "month_date",
        "source_table",
        "audit_category",
        F.col("finding_count").cast("bigint").alias("finding_count"),
        F.col("affected_records").cast("bigint").alias("affected_records"),
        F.col("monthly_record_count").cast("bigint").alias("monthly_record_count"),
        exact_ratio("affected_records", "monthly_record_count").cast("decimal(6,4)").alias("pct_of_monthly_total"),
    )
    return enforce_contract(df, C.INT_AUDIT_BY_MONTH)


def monthly_volume(df: DataFrame, anchor_col: str) -> DataFrame:
    """Records per anchor month (rows without an anchor are not counted)."""
    return (
        df.filter(F.col(anchor_col).isNotNull())
        .groupBy(month_trunc(anchor_col).alias("month_date"))
        .agg(F.count(F.lit(1)).alias("monthly_record_count"))
    )
