"""Marts: unit economics per cohort month, funnel with engagement, lead-level
leading indicators and the monthly data-quality monitor."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from funnelworks.functions import (
    activity_density,
    conversion_tier,
    exact_ratio,
    list_count,
    ltv_estimate,
    surrogate_key,
)
from funnelworks.operators.contracts import enforce_contract
from funnelworks.plans import contracts_catalog as C
from funnelworks.plans.intermediate import funnel_rates


def mart_cac_ltv(stats: DataFrame, expenses: DataFrame) -> DataFrame:
    """Cost, wins, CAC, won-lead GMV/LTV averages and LTV:CAC per month ×
    channel; limited to months with cost data (inner join).  The ratio is one
    division of exact products: (ltv_sum x won) / (ltv_n x cost).  Its type
    decimal(14,4) holds ratios below 10^10, for months of little spend."""
    cost = expenses.select("month_date", "channel", "total_cost_usd")
    j = stats.join(cost, ["month_date", "channel"], "inner")
    won = F.col("closed_won")
    avg_ltv = exact_ratio("won_ltv_sum", "won_ltv_n")
    cac = exact_ratio("total_cost_usd", won)
    # sums of cents times counts: 28 digits before the point for the numerator
    ratio = exact_ratio(
        F.col("won_ltv_sum") * won, F.col("won_ltv_n") * F.col("total_cost_usd"), num_type=(30, 2), den_type=(24, 2)
    )
    df = j.select(
        surrogate_key("month_date", "channel").alias("cac_ltv_sk"),
        "month_date",
        "channel",
        F.col("total_cost_usd").cast("decimal(20,2)").alias("total_cost_usd"),
        won.alias("new_customers_won"),
        cac.cast("decimal(12,2)").alias("cac_usd"),
        exact_ratio("won_gmv_sum", "won_gmv_n").cast("decimal(12,2)").alias("avg_predicted_monthly_gmv_usd"),
        avg_ltv.cast("decimal(12,2)").alias("avg_estimated_ltv_usd"),
        ratio.cast("decimal(14,4)").alias("cac_ltv_ratio"),
    )
    return enforce_contract(df, C.MART_CAC_LTV)


def mart_gtm_funnel(stats: DataFrame) -> DataFrame:
    """Funnel counts and rates plus engagement: speed and days averaged over
    converted leads only, activity over all leads of the cohort."""
    df = stats.select(
        surrogate_key("month_date", "channel").alias("gtm_funnel_sk"),
        "month_date",
        "channel",
        "leads_created",
        "demos_set",
        "demos_held",
        "closed_won",
        "closed_lost",
        *funnel_rates(stats),
        exact_ratio("conv_speed_sum", "conv_speed_n").cast("decimal(10,2)").alias("avg_speed_to_first_contact_hours"),
        exact_ratio("conv_days_sum", "conv_days_n").cast("decimal(8,2)").alias("avg_days_in_funnel"),
        exact_ratio("activity_sum", "activity_n").cast("decimal(8,2)").alias("avg_activity_count"),
    )
    return enforce_contract(df, C.MART_GTM_FUNNEL)


def mart_leading_indicators(enriched: DataFrame) -> DataFrame:
    """One row per lead with density and tier.  The restaurant profile is a
    projection of the same enriched row, so it is computed in place instead of
    self-joining on lead_sk (no shuffle at all: a narrow map over leads)."""
    row = enriched.select(
        "*",
        ltv_estimate("predicted_monthly_gmv_usd").alias("estimated_annual_ltv_usd"),
        list_count("marketplaces_used_cleaned").alias("marketplace_count"),
        F.col("olo_tools_cleaned").isNotNull().alias("has_olo_tool"),
    )
    df = row.select(
        "lead_sk",
        "lead_id",
        "channel",
        "status",
        "is_converted",
        "is_disqualified",
        "connected_with_decision_maker",
        "speed_to_first_contact_hours",
        "days_in_funnel",
        "total_activity_count",
        "last_sales_activity_at",
        activity_density("total_activity_count", "days_in_funnel").cast("decimal(8,4)").alias("activity_density_score"),
        "predicted_monthly_gmv_usd",
        "estimated_annual_ltv_usd",
        "marketplace_count",
        "has_olo_tool",
        conversion_tier(
            "is_converted",
            "is_disqualified",
            "connected_with_decision_maker",
            "total_activity_count",
            "speed_to_first_contact_hours",
            "predicted_monthly_gmv_usd",
        ).alias("conversion_probability_tier"),
    )
    return enforce_contract(df, C.MART_LEADING_INDICATORS)


def monthly_revenue(cac_ltv: DataFrame) -> DataFrame:
    """Month totals over channels from the stored (rounded) CAC mart.  A
    channel with no wins has null CAC, so its cost drops out of the blended
    numerator while its wins (0) do not change the denominator."""
    won = F.col("new_customers_won")
    return cac_ltv.groupBy("month_date").agg(
        F.sum(won).alias("new_customers_won"),
        F.sum(won * F.col("avg_estimated_ltv_usd")).alias("estimated_monthly_ltv_usd"),
        F.sum("total_cost_usd").alias("total_cost_usd"),
        F.sum(F.col("cac_usd") * won).alias("_cac_x_won"),
        F.sum(won).alias("_won"),
    )


def monthly_audit_totals(audit_by_month: DataFrame) -> DataFrame:
    """All audit totals of a month in one aggregate (overall and per source)."""
    src = F.col("source_table")

    def filtered(col: str, table: str):
        return F.sum(F.when(src == table, F.col(col)))

    return audit_by_month.groupBy("month_date").agg(
        F.sum("finding_count").alias("total_findings"),
        F.sum("affected_records").alias("total_affected_records"),
        F.sum("monthly_record_count").alias("total_records_in_scope"),
        filtered("finding_count", "leads").alias("leads_findings"),
        filtered("finding_count", "opportunities").alias("opps_findings"),
        filtered("affected_records", "leads").alias("leads_affected"),
        filtered("affected_records", "opportunities").alias("opps_affected"),
    )


def mart_data_quality_monitor(cac_ltv: DataFrame, audit_by_month: DataFrame) -> DataFrame:
    rev = monthly_revenue(cac_ltv)
    aud = monthly_audit_totals(audit_by_month)
    j = rev.join(aud, "month_date", "left")

    def zero(c: str):
        return F.coalesce(F.col(c), F.lit(0))

    by_month = Window.orderBy("month_date")  # month-grain input: one small partition
    ltv = F.col("estimated_monthly_ltv_usd")
    findings = zero("total_findings")
    df = j.select(
        surrogate_key("month_date").alias("dq_monitor_sk"),
        "month_date",
        F.col("new_customers_won").cast("bigint").alias("new_customers_won"),
        ltv.cast("decimal(20,2)").alias("estimated_monthly_ltv_usd"),
        F.col("total_cost_usd").cast("decimal(20,2)").alias("total_cost_usd"),
        exact_ratio("_cac_x_won", "_won").cast("decimal(12,2)").alias("blended_cac_usd"),
        (ltv - F.lag(ltv).over(by_month)).cast("decimal(20,2)").alias("mom_revenue_change_usd"),
        findings.cast("bigint").alias("total_audit_findings"),
        zero("total_affected_records").cast("bigint").alias("total_audit_affected_records"),
        zero("total_records_in_scope").cast("bigint").alias("total_records_in_scope"),
        exact_ratio(zero("total_affected_records"), F.col("total_records_in_scope"))
        .cast("decimal(6,4)")
        .alias("overall_audit_density"),
        zero("leads_findings").cast("bigint").alias("leads_audit_findings"),
        zero("opps_findings").cast("bigint").alias("opps_audit_findings"),
        zero("leads_affected").cast("bigint").alias("leads_audit_affected"),
        zero("opps_affected").cast("bigint").alias("opps_audit_affected"),
        (findings - F.lag(findings).over(by_month)).cast("bigint").alias("mom_audit_findings_change"),
    )
    return enforce_contract(df, C.MART_DATA_QUALITY_MONITOR)
