"""The project's declared data tests and its singular invariants."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelworks.functions import exact_ratio
from funnelworks.operators.quality import TestSpec

CHANNELS = ["inbound", "outbound"]
STAGES = ["Interest", "Demo Set", "In Progress", "Verbal Commitment", "On Hold", "Closed Won", "Closed Lost"]
LEAD_CATEGORIES = [
    "millennium_date_defect",
    "dirty_status_value",
    "negative_speed_to_contact",
    "stale_lead",
    "converted_missing_opp",
]
OPP_CATEGORIES = ["duplicate_row", "millennium_date_defect", "missing_lost_reason", "missing_attribution"]
TIERS = ["hot", "warm", "cold", "converted"]

# Declared column tests per model.
NOT_NULL = {
    "stg_expenses_advertising": ["expense_advertising_sk", "month_date"],
    "stg_expenses_salary": ["expense_salary_sk", "month_date", "sales_channel"],
    "stg_opportunities": [
        "opportunity_sk", "opportunity_id", "account_id", "stage_name", "demo_held", "created_at", "close_date",
    ],
    "stg_leads": ["lead_sk", "lead_id", "status", "connected_with_decision_maker"],
    "audit_opportunities": ["audit_sk", "source_table", "record_key", "audit_category", "audit_detail"],
    "audit_leads": ["audit_sk", "source_table", "record_key", "audit_category", "audit_detail"],
    "int_expenses_channel_month": ["expense_channel_month_sk", "month_date", "channel"],
    "int_leads_enriched": ["lead_sk", "lead_id", "channel"],
    "int_funnel": ["funnel_channel_month_sk", "month_date", "channel", "leads_created"],
    "int_restaurant_profile": ["lead_sk", "lead_id", "channel"],
    "int_audit_by_month": ["audit_month_sk", "month_date", "source_table", "audit_category"],
    "mart_cac_ltv": ["cac_ltv_sk", "month_date", "channel"],
    "mart_gtm_funnel": ["gtm_funnel_sk", "month_date", "channel"],
    "mart_leading_indicators": ["lead_sk", "lead_id", "channel"],
    "mart_data_quality_monitor": ["dq_monitor_sk", "month_date"],
}
UNIQUE = {
    "stg_expenses_advertising": ["expense_advertising_sk"],
    "stg_expenses_salary": ["expense_salary_sk"],
    "stg_opportunities": ["opportunity_sk", "opportunity_id"],
    "stg_leads": ["lead_sk", "lead_id"],
    "audit_opportunities": ["audit_sk"],
    "audit_leads": ["audit_sk"],
    "int_expenses_channel_month": ["expense_channel_month_sk"],
    "int_leads_enriched": ["lead_sk"],
    "int_funnel": ["funnel_channel_month_sk"],
    "int_restaurant_profile": ["lead_sk"],
    "int_audit_by_month": ["audit_month_sk"],
    "mart_cac_ltv": ["cac_ltv_sk"],
    "mart_gtm_funnel": ["gtm_funnel_sk"],
    "mart_leading_indicators": ["lead_sk"],
    "mart_data_quality_monitor": ["dq_monitor_sk"],
}
ACCEPTED = [
    ("stg_expenses_salary", "sales_channel", CHANNELS, None),
    ("stg_opportunities", "stage_name", STAGES, None),
    ("audit_opportunities", "audit_category", OPP_CATEGORIES, None),
    ("audit_leads", "audit_category", LEAD_CATEGORIES, None),
    ("int_expenses_channel_month", "channel", CHANNELS, None),
    ("int_leads_enriched", "channel", CHANNELS, None),
    ("int_funnel", "channel", CHANNELS, None),
    ("int_audit_by_month", "source_table", ["leads", "opportunities"], None),
    ("mart_cac_ltv", "channel", CHANNELS, None),
    ("mart_gtm_funnel", "channel", CHANNELS, None),
    ("mart_leading_indicators", "channel", CHANNELS, None),
    ("mart_leading_indicators", "conversion_probability_tier", TIERS, "is_disqualified = false or is_disqualified is null"),
]
EXPRESSIONS = [
    ("int_audit_by_month", "finding_count", "> 0", None),
    ("int_audit_by_month", "affected_records", "> 0", None),
    ("int_audit_by_month", "monthly_record_count", "> 0", None),
    ("mart_cac_ltv", "total_cost_usd", "> 0", None),
    ("mart_cac_ltv", "new_customers_won", ">= 0", None),
    ("mart_cac_ltv", "cac_usd", "> 0", "cac_usd is not null"),
    ("mart_cac_ltv", "cac_ltv_ratio", "> 0", "cac_ltv_ratio is not null"),
    ("mart_gtm_funnel", "leads_created", "> 0", None),
    ("mart_gtm_funnel", "demos_set", "<= leads_created", None),
    ("mart_gtm_funnel", "demo_set_to_held_rate", ">= 0", "demo_set_to_held_rate is not null"),
    ("mart_gtm_funnel", "avg_speed_to_first_contact_hours", "> 0", "avg_speed_to_first_contact_hours is not null"),
    ("mart_gtm_funnel", "avg_days_in_funnel", "> 0", "avg_days_in_funnel is not null"),
    ("mart_gtm_funnel", "avg_activity_count", ">= 0", "avg_activity_count is not null"),
    ("mart_leading_indicators", "total_activity_count", ">= 0", None),
    ("mart_leading_indicators", "activity_density_score", ">= 0", "activity_density_score is not null"),
    ("mart_leading_indicators", "marketplace_count", ">= 0", "marketplace_count is not null"),
    ("mart_data_quality_monitor", "new_customers_won", ">= 0", None),
    ("mart_data_quality_monitor", "total_audit_findings", ">= 0", None),
    ("mart_data_quality_monitor", "total_audit_affected_records", ">= 0", None),
]
RANGES = [
    ("int_audit_by_month", "pct_of_monthly_total", 0, 1, None),
    ("mart_cac_ltv", "avg_predicted_monthly_gmv_usd", 0, 1000000, None),
    ("mart_gtm_funnel", "lead_to_demo_set_rate", 0, 1, None),
    ("mart_gtm_funnel", "demo_to_close_rate", 0, 1, None),
    ("mart_gtm_funnel", "overall_conversion_rate", 0, 1, None),
    ("mart_leading_indicators", "predicted_monthly_gmv_usd", 0, 1000000, None),
    ("mart_data_quality_monitor", "overall_audit_density", 0, 1, "overall_audit_density is not null"),
]
RELATIONSHIPS = [("mart_leading_indicators", "lead_id", "stg_leads", "lead_id")]
NOT_NULL_PROPORTION = [("mart_leading_indicators", "speed_to_first_contact_hours", 0.20)]


def specs(kind: str | None = None) -> list[TestSpec]:
    out: list[TestSpec] = []
    for model, cols in NOT_NULL.items():
        out += [TestSpec(model, "not_null", c) for c in cols]
    for model, cols in UNIQUE.items():
        out += [TestSpec(model, "unique", c) for c in cols]
    out += [TestSpec(m, "accepted_values", c, {"values": v}, w) for m, c, v, w in ACCEPTED]
    out += [TestSpec(m, "expression_is_true", c, {"expression": e}, w) for m, c, e, w in EXPRESSIONS]
    out += [
        TestSpec(m, "accepted_range", c, {"min_value": lo, "max_value": hi, "inclusive": True}, w)
        for m, c, lo, hi, w in RANGES
    ]
    out += [TestSpec(m, "not_null_proportion", c, {"at_least": p}) for m, c, p in NOT_NULL_PROPORTION]
    out += [TestSpec(m, "relationships", c, {"to": to, "field": f}) for m, c, to, f in RELATIONSHIPS]
    return [s for s in out if kind is None or s.kind == kind]


# ---- singular invariants (violating rows; pass = empty) ----------------------------
def two_channels_per_month(cac_ltv: DataFrame) -> DataFrame:
    return (
        cac_ltv.groupBy("month_date")
        .agg(F.count(F.lit(1)).alias("channel_count"), F.array_sort(F.collect_list("channel")).alias("channels_present"))
        .filter(F.col("channel_count") != 2)
    )


def outbound_cac_not_extreme(cac_ltv: DataFrame, max_ratio: float = 10) -> DataFrame:
    piv = (
        cac_ltv.filter(F.col("cac_usd").isNotNull())
        .groupBy("month_date")
        .pivot("channel", CHANNELS)
        .agg(F.max("cac_usd"))
        .withColumnRenamed("inbound", "inbound_cac")
        .withColumnRenamed("outbound", "outbound_cac")
    )
    ratio = exact_ratio("outbound_cac", "inbound_cac")
    return piv.filter(ratio > max_ratio).select(
        "month_date", "inbound_cac", "outbound_cac", F.round(ratio, 2).cast("decimal(12,2)").alias("cac_ratio")
    )


def converted_not_cold(leads: DataFrame) -> DataFrame:
    """Note: `!=` lets a null tier through, as declared."""
    return leads.filter(
        (F.col("is_converted") == F.lit(True))
        & ~F.col("is_disqualified").eqNullSafe(F.lit(True))
        & (F.col("conversion_probability_tier") != "converted")
    ).select(
        "lead_id", "lead_sk", "channel", "is_converted", "is_disqualified", "connected_with_decision_maker",
        "speed_to_first_contact_hours", "total_activity_count", "predicted_monthly_gmv_usd",
        "conversion_probability_tier",
    )


def disqualified_tier_null(leads: DataFrame) -> DataFrame:
    return leads.filter(
        (F.col("is_disqualified") == F.lit(True)) & F.col("conversion_probability_tier").isNotNull()
    ).select("lead_id", "lead_sk", "status", "is_disqualified", "conversion_probability_tier")


def lead_count_matches(stg_leads: DataFrame, mart_leads: DataFrame) -> DataFrame:
    s = stg_leads.agg(F.count(F.lit(1)).alias("staging_leads"))
    m = mart_leads.agg(F.count(F.lit(1)).alias("mart_leads"))
    return (
        s.crossJoin(m)  # two one-row aggregates
        .filter(F.col("staging_leads") != F.col("mart_leads"))
        .select("staging_leads", "mart_leads", (F.col("mart_leads") - F.col("staging_leads")).alias("delta"))
    )


def invariants(tables: Mapping[str, DataFrame]) -> dict[str, tuple[str, DataFrame]]:
    """The singular tests over a set of models: name -> (model, violating rows)."""
    cac, leads = tables["mart_cac_ltv"], tables["mart_leading_indicators"]
    return {
        "two_channels_per_month": ("mart_cac_ltv", two_channels_per_month(cac)),
        "outbound_cac_not_extreme": ("mart_cac_ltv", outbound_cac_not_extreme(cac)),
        "converted_not_cold": ("mart_leading_indicators", converted_not_cold(leads)),
        "disqualified_tier_null": ("mart_leading_indicators", disqualified_tier_null(leads)),
        "lead_count_matches_staging": ("mart_leading_indicators", lead_count_matches(tables["stg_leads"], leads)),
    }


def with_defects(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The models with defects planted by rule, so that every kind of test has
    something to find: a test that never fails shows nothing."""
    cac, leads = tables["mart_cac_ltv"], tables["mart_leading_indicators"]
    month, outbound = F.month("month_date"), F.col("channel") == "outbound"
    cac = cac.where(~(outbound & (month == 2))).withColumns(
        {
            "cac_usd": F.when(outbound, F.col("cac_usd") * 50).otherwise(F.col("cac_usd")).cast("decimal(14,2)"),
            "total_cost_usd": F.when(month == 4, -F.col("total_cost_usd")).otherwise(F.col("total_cost_usd")),
        }
    )

    def ends(digits: str) -> Column:
        return F.col("lead_id").endswith(digits)

    tier = F.col("conversion_probability_tier")
    planted = {
        "conversion_probability_tier": F.when(F.col("is_converted") & ends("2"), "cold").when(F.col("is_disqualified") & ends("3"), "warm").otherwise(tier),
        "total_activity_count": F.when(ends("4"), -1).otherwise(F.col("total_activity_count")),
        "channel": F.when(ends("5"), "partner").otherwise(F.col("channel")),
        "lead_sk": F.when(ends("6"), "same").otherwise(F.col("lead_sk")),
        "predicted_monthly_gmv_usd": F.when(ends("7"), F.lit(2000000)).otherwise(F.col("predicted_monthly_gmv_usd")).cast("decimal(12,2)"),
        "speed_to_first_contact_hours": F.when(ends("8"), F.col("speed_to_first_contact_hours")),
        "lead_id": F.when(ends("9"), F.concat(F.lit("X"), F.col("lead_id"))).otherwise(F.col("lead_id")),
    }
    leads = leads.where(~ends("00")).withColumns(planted)
    return {**tables, "mart_cac_ltv": cac, "mart_leading_indicators": leads}
