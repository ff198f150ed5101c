"""Registry of runnable queries: key → callable(spark, sf_dir) → DataFrame.

Every query reads the driver tables (or data Spark derives from them) in
full; nothing is sampled or capped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from funnelworks import functions as fx
from funnelworks.operators import quality as _dq
from funnelworks.operators import reshape as _rs
from funnelworks.operators.joins import left_join_spread_nulls
from funnelworks.plans import analyses as _an
from funnelworks.plans import incremental_marts as _inc
from funnelworks.plans import marts as _marts
from funnelworks.plans import quality_suite as _suite
from funnelworks.plans import semantic as _sem
from funnelworks.plans.models import GtmModels
from funnelworks.session import scratch_path
from funnelworks.sources.driver_tables import read_table
from funnelworks.sources.gtm_raw import load_raw_sources
from funnelworks.streaming.incremental import lookback_start, watermark_filter

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return deco


def models(spark: SparkSession, sf_dir: str) -> GtmModels:
    """The model graph over a folder as it is now: lazy plans over a fresh
    file listing, so files added since the last call are read."""
    return GtmModels.from_driver_tables(spark, sf_dir)


# ---- raw sources ------------------------------------------------------------
for _name, _attr in [
    ("src_leads", "leads"),
    ("src_opportunities", "opportunities"),
    ("src_expenses_advertising", "expenses_advertising"),
    ("src_expenses_salary", "expenses_salary"),
]:
    QUERIES[_name] = (lambda a: lambda spark, sf: getattr(load_raw_sources(spark, sf), a))(_attr)

# ---- models -----------------------------------------------------------------
MODEL_KEYS = [
    "stg_expenses_advertising",
    "stg_expenses_salary",
    "stg_leads",
    "stg_opportunities",
    "audit_leads",
    "audit_opportunities",
    "int_expenses_channel_month",
    "int_leads_enriched",
    "int_funnel",
    "int_restaurant_profile",
    "int_audit_by_month",
    "mart_cac_ltv",
    "mart_gtm_funnel",
    "mart_leading_indicators",
    "mart_data_quality_monitor",
]
for _key in MODEL_KEYS:
    QUERIES[_key] = (lambda k: lambda spark, sf: getattr(models(spark, sf), k))(_key)


# ---- analyses -----------------------------------------------------------------


@register("analysis_speed_buckets")
def _q_speed(spark, sf):
    return _an.speed_buckets(models(spark, sf).int_leads_enriched)


@register("analysis_recency_buckets")
def _q_recency(spark, sf):
    return _an.recency_buckets(models(spark, sf).int_leads_enriched)


@register("analysis_month_completeness")
def _q_completeness(spark, sf):
    return _an.month_completeness(models(spark, sf).int_leads_enriched)


@register("analysis_won_detail")
def _q_won_detail(spark, sf):
    return _an.won_detail(models(spark, sf).int_leads_enriched)


@register("analysis_funnel_stage_rates")
def _q_stage_rates(spark, sf):
    return _an.funnel_stage_rates(models(spark, sf).mart_gtm_funnel)


@register("analysis_headcount_trend")
def _q_headcount(spark, sf):
    m = models(spark, sf)
    return _an.headcount_trend(m.int_expenses_channel_month, m.mart_cac_ltv)


# ---- verified queries -------------------------------------------------------------
for _key, _fn, _mart in [
    ("vq_outbound_cac", _sem.vq_outbound_cac, "mart_cac_ltv"),
    ("vq_funnel_rates", _sem.vq_funnel_rates, "mart_gtm_funnel"),
    ("vq_lead_tier_counts", _sem.vq_lead_tier_counts, "mart_leading_indicators"),
    ("vq_cac_ltv_trend", _sem.vq_cac_ltv_trend, "mart_cac_ltv"),
    ("vq_hot_pipeline", _sem.vq_hot_pipeline, "mart_leading_indicators"),
    ("vq_speed_impact", _sem.vq_speed_impact, "mart_gtm_funnel"),
]:
    QUERIES[_key] = (lambda f, mart: lambda spark, sf: f(getattr(models(spark, sf), mart)))(_fn, _mart)


# ---- governed metrics ---------------------------------------------------------------
def mart_tables(m: GtmModels) -> dict[str, DataFrame]:
    return {
        "mart_cac_ltv": m.mart_cac_ltv,
        "mart_gtm_funnel": m.mart_gtm_funnel,
        "mart_leading_indicators": m.mart_leading_indicators,
    }


def run_metrics(spark, sf, metrics, group_by, where=None):
    return _sem.metric_query(mart_tables(models(spark, sf)), metrics, group_by, where)


for _metric in _sem.METRICS:
    QUERIES[f"metric_{_metric.name}"] = (
        lambda name: lambda spark, sf: run_metrics(spark, sf, [name], _sem.default_group_by(name))
    )(_metric.name)

QUERIES["metric_query_cac_ltv_vs_demo_rate"] = lambda spark, sf: run_metrics(
    spark, sf, ["cac_ltv_ratio", "lead_to_demo_set_rate"], ["month_date__month"]
)
QUERIES["metric_query_tier_counts"] = lambda spark, sf: run_metrics(
    spark, sf, ["hot_lead_count", "warm_lead_count"], ["channel"]
)
QUERIES["metric_query_outbound_2024"] = lambda spark, sf: run_metrics(
    spark,
    sf,
    ["cac_usd", "leads_created", "inbound_conversion_rate"],
    ["month_date__month"],
    where="channel = 'outbound' and month_date between '2024-01-01' and '2024-06-01'",
)
QUERIES["metric_query_leads_by_activity_month"] = lambda spark, sf: run_metrics(
    spark, sf, ["total_lead_count", "hot_lead_count", "avg_prospect_gmv"], ["channel", "last_sales_activity_at__month"]
)
QUERIES["metric_query_metric_time"] = lambda spark, sf: run_metrics(
    spark, sf, ["cac_usd", "total_lead_count"], ["metric_time__month"]
)
QUERIES["metric_query_named_filter"] = lambda spark, sf: run_metrics(
    spark, sf, ["hot_lead_count", "avg_prospect_gmv"], ["channel"], where="inbound_active"
)
# bare measures without a metric of their own, also where two models share the name
MEASURES = {
    "demo_to_close_rate": "gtm_funnel", "demos_set": "gtm_funnel", "demos_held": "gtm_funnel", "closed_won": "gtm_funnel",
    "closed_lost": "gtm_funnel", "avg_activity_density_score": "lead_universe",
    "lead_universe.avg_speed_to_first_contact_hours": "lead_universe",
}
for _measure, _model in MEASURES.items():
    QUERIES[f"measure_{_measure.replace('.', '_')}"] = (
        lambda name, dims: lambda spark, sf: run_metrics(spark, sf, [name], dims)
    )(_measure, _sem.DEFAULT_GROUP_BY[_model])

FILTER_METRICS = {
    "gtm_channel_month": ["total_gtm_spend", "cac_usd"],
    "gtm_funnel": ["leads_created", "lead_to_demo_set_rate"],
    "lead_universe": ["total_lead_count", "avg_prospect_gmv"],
}
for _model, _metrics in FILTER_METRICS.items():
    QUERIES[f"metric_filters_{_model}"] = (
        lambda model, metrics: lambda spark, sf: _sem.metrics_by_filter(
            mart_tables(models(spark, sf)), model, metrics, ["channel"]
        )
    )(_model, _metrics)
QUERIES["metric_query_combined_filters"] = lambda spark, sf: run_metrics(
    spark, sf, ["cac_usd", "new_customers_won", "demo_to_close_rate"], ["month_date__month"],
    where=["inbound_only", "jan_jun_2024", "month_date > '2024-01-01'"],
)
QUERIES["metric_query_filter_across_models"] = lambda spark, sf: run_metrics(
    spark, sf, ["hot_lead_count", "cac_usd"], ["channel"], where="inbound_active"
)
QUERIES["metric_query_entity_dimensions"] = lambda spark, sf: run_metrics(
    spark, sf, ["total_lead_count", "avg_prospect_gmv"],
    ["lead__conversion_probability_tier", "lead__has_olo_tool", "lead__last_sales_activity_at__month"],
)


# ---- data tests -------------------------------------------------------------------


def model_tables(m: GtmModels) -> dict[str, DataFrame]:
    return {name: getattr(m, name) for name in MODEL_KEYS}


def stored_model_tables(spark, sf) -> dict[str, DataFrame]:
    """Models over stored bases (raw exports and enriched leads written once
    to the shared checkpoint folder), so a suite of ~100 tests does not
    recompute the raw projection for every test."""
    from funnelworks.plans.pipeline import materialized_models

    return model_tables(materialized_models(spark, load_raw_sources(spark, sf)))


for _kind, _key in [
    ("not_null", "dq_not_null"),
    ("unique", "dq_unique"),
    ("accepted_values", "dq_accepted_values"),
    ("expression_is_true", "dq_expression"),
    ("accepted_range", "dq_range"),
    ("not_null_proportion", "dq_not_null_proportion"),
]:
    QUERIES[_key] = (lambda kind: lambda spark, sf: _dq.run_tests(stored_model_tables(spark, sf), _suite.specs(kind)))(
        _kind
    )

QUERIES["dq_suite"] = lambda spark, sf: _dq.run_tests(stored_model_tables(spark, sf), _suite.specs())


@register("dq_relationships")
def _q_relationships(spark, sf):
    """Orders whose customer key has no customer row."""
    orders = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey"])
    customers = read_table(spark, sf, "customer", ["c_custkey"])
    return _dq.relationships(orders, "o_custkey", customers, "c_custkey")


@register("dq_lead_fk")
def _q_lead_fk(spark, sf):
    m = models(spark, sf)
    return _dq.relationships(m.mart_leading_indicators.select("lead_id"), "lead_id", m.stg_leads, "lead_id")


@register("dq_raw_duplicate_ids")
def _q_raw_dups(spark, sf):
    """unique() on the raw export's opportunity id: the export duplicates."""
    return _dq.unique(load_raw_sources(spark, sf).opportunities, "opportunity_id")


@register("dq_raw_status_values")
def _q_raw_status(spark, sf):
    """accepted_values() on the raw lead status: the dirty spelling."""
    return _dq.accepted_values(
        load_raw_sources(spark, sf).leads,
        "status",
        [
            "New", "Working", "Demo Set", "Sales Nurture", "Marketing Nurture", "Converted", "Disqualified",
            "Not Interested", "Incorrect Contact Data", "No Longer With Company", "No Show", "Postpone",
            "Restaurant Confirmed", "Nurturing",
        ],
    )


def planted(spark, sf) -> dict[str, DataFrame]:
    return _suite.with_defects(stored_model_tables(spark, sf))


QUERIES["dq_planted_suite"] = lambda spark, sf: _dq.run_tests(planted(spark, sf), _suite.specs())
for _name in ("two_channels_per_month", "outbound_cac_not_extreme", "converted_not_cold", "disqualified_tier_null",
              "lead_count_matches_staging"):
    QUERIES[f"dq_planted_{_name}"] = (lambda name: lambda spark, sf: _suite.invariants(planted(spark, sf))[name][1])(_name)


@register("dq_planted_lead_fk")
def _q_planted_fk(spark, sf):
    t = planted(spark, sf)
    return _dq.relationships(t["mart_leading_indicators"].select("lead_id"), "lead_id", t["stg_leads"], "lead_id")


@register("dq_two_channels")
def _q_two_channels(spark, sf):
    return _suite.two_channels_per_month(models(spark, sf).mart_cac_ltv)


@register("dq_cac_gap")
def _q_cac_gap(spark, sf):
    return _suite.outbound_cac_not_extreme(models(spark, sf).mart_cac_ltv)


@register("dq_cac_gap_2x")
def _q_cac_gap_2x(spark, sf):
    """The same invariant with a tighter bound; like dq_cac_gap it has no rows
    where outbound stays below inbound (dq_planted_* have)."""
    return _suite.outbound_cac_not_extreme(models(spark, sf).mart_cac_ltv, max_ratio=1)


@register("dq_converted_tier")
def _q_converted_tier(spark, sf):
    return _suite.converted_not_cold(models(spark, sf).mart_leading_indicators)


@register("dq_disqualified_tier")
def _q_disq_tier(spark, sf):
    return _suite.disqualified_tier_null(models(spark, sf).mart_leading_indicators)


@register("dq_lead_count")
def _q_lead_count(spark, sf):
    m = models(spark, sf)
    return _suite.lead_count_matches(m.stg_leads, m.mart_leading_indicators)


# ---- scalar functions over whole tables -----------------------------------------------


def _raw_leads(spark, sf):
    return load_raw_sources(spark, sf).leads


FUNCTION_QUERIES = {
    "fn_fix_millennium_date": lambda s, sf: _raw_leads(s, sf).select(
        "lead_id", "form_submission_date", fx.fix_millennium_date("form_submission_date").alias("fixed_date")
    ),
    "fn_clean_timestamp": lambda s, sf: _raw_leads(s, sf).select(
        "lead_id", "first_sales_call_date", fx.clean_timestamp("first_sales_call_date").alias("cleaned_at")
    ),
    "fn_clean_category_list": lambda s, sf: _raw_leads(s, sf).select(
        "lead_id",
        fx.clean_category_list("marketplaces_used").alias("marketplaces"),
        fx.clean_category_list("online_ordering_used").alias("olo_tools"),
        fx.clean_category_list("cuisine_types").alias("cuisines"),
    ),
    "fn_parse_european_numeric": lambda s, sf: _raw_leads(s, sf).select(
        "lead_id", "predicted_sales", fx.parse_european_numeric("predicted_sales").alias("amount")
    ),
    "fn_blank_to_null": lambda s, sf: _raw_leads(s, sf).select(
        "lead_id", fx.blank_to_null("converted_opportunity_id").alias("opportunity_id")
    ),
    "fn_normalize_status": lambda s, sf: _raw_leads(s, sf).select(
        "lead_id",
        "status",
        fx.normalize_value("status", {"Incorrect_Contact_Data": "Incorrect Contact Data"}).alias("status_clean"),
    ),
    "fn_status_flags": lambda s, sf: _raw_leads(s, sf).select(
        "lead_id",
        fx.equals_flag("status", "Converted").alias("is_converted"),
        fx.in_list_flag(
            "status",
            ["Disqualified", "Not Interested", "Incorrect Contact Data", "Incorrect_Contact_Data", "No Longer With Company"],
        ).alias("is_disqualified"),
    ),
    "fn_total_activity": lambda s, sf: models(s, sf).stg_leads.select(
        "lead_id",
        fx.null_safe_sum("sales_call_count", "sales_text_count", "sales_email_count").alias("total_activity"),
    ),
    "fn_derive_channel": lambda s, sf: models(s, sf).stg_leads.select(
        "lead_id", fx.derive_channel("form_submission_date").alias("channel")
    ),
    "fn_hours_between": lambda s, sf: models(s, sf).stg_leads.select(
        "lead_id",
        fx.hours_between("first_sales_call_at", "last_sales_activity_at").cast("decimal(20,6)").alias("hours"),
        fx.days_between("first_sales_call_at", "last_sales_email_at").cast("decimal(20,6)").alias("days"),
    ),
    "fn_month_trunc": lambda s, sf: read_table(s, sf, "events", ["event_id", "ts"]).select(
        "event_id", fx.month_trunc("ts").alias("month_date")
    ),
    "fn_cohort_month": lambda s, sf: models(s, sf).int_leads_enriched.select(
        "lead_id",
        fx.has_cohort_anchor("channel", "form_submission_date", "first_sales_call_at").alias("has_anchor"),
        fx.cohort_month("channel", "form_submission_date", "first_sales_call_at").alias("cohort_month"),
    ),
    "fn_list_count": lambda s, sf: models(s, sf).stg_leads.select(
        "lead_id", fx.list_count("marketplaces_used_cleaned").alias("marketplace_count")
    ),
    "fn_ltv_estimate": lambda s, sf: models(s, sf).stg_leads.select(
        "lead_id", fx.ltv_estimate("predicted_monthly_gmv_usd").alias("ltv")
    ),
    "fn_activity_density": lambda s, sf: models(s, sf).int_leads_enriched.select(
        "lead_id",
        fx.activity_density("total_activity_count", "days_in_funnel").cast("decimal(8,4)").alias("density"),
    ),
    "fn_surrogate_key": lambda s, sf: models(s, sf).stg_leads.select(
        "lead_id", fx.surrogate_key("lead_id", "converted_opportunity_id", "form_submission_date").alias("sk")
    ),
    "fn_safe_divide": lambda s, sf: read_table(
        s, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_extendedprice", "l_discount"]
    ).select(
        "l_orderkey",
        "l_linenumber",
        fx.safe_divide(
            F.col("l_extendedprice").cast("decimal(12,2)"), F.col("l_discount").cast("decimal(4,2)")
        ).cast("decimal(20,6)").alias("price_per_discount"),
    ),
    "fn_month_label": lambda s, sf: load_raw_sources(s, sf).expenses_salary.select(
        "month", fx.month_label_to_date("month").alias("month_date")
    ),
    "score_tier": lambda s, sf: models(s, sf).mart_leading_indicators.select("lead_id", "conversion_probability_tier"),
    "bucket_speed": lambda s, sf: models(s, sf).int_leads_enriched.select(
        "lead_id", fx.speed_bucket("speed_to_first_contact_hours").alias("speed_bucket")
    ),
    "bucket_recency": lambda s, sf: models(s, sf).int_leads_enriched.select(
        "lead_id", fx.recency_bucket("speed_to_first_contact_hours").alias("recency_bucket")
    ),
}
QUERIES.update(FUNCTION_QUERIES)


# ---- generic operators on whole tables ------------------------------------------------


@register("dedup_exact")
def _q_dedup(spark, sf):
    return _rs.dedup_exact(load_raw_sources(spark, sf).opportunities)


@register("dedup_events")
def _q_dedup_events(spark, sf):
    ev = read_table(spark, sf, "events", ["user_id", "event_type", "ts"])
    return _rs.dedup_exact(ev.select("user_id", "event_type", F.to_date("ts").alias("event_date")))


@register("unpivot_channel_cost")
def _q_unpivot(spark, sf):
    return models(spark, sf).stg_expenses_salary


@register("unpivot_lineitem_measures")
def _q_unpivot_li(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax"])
    return _rs.unpivot(li, ["l_orderkey", "l_linenumber"], ["l_extendedprice", "l_discount", "l_tax"], "measure", "value")


@register("join_left_enrich")
def _q_join_left(spark, sf):
    m = models(spark, sf)
    opp = m.stg_opportunities.select(F.col("opportunity_id").alias("o_id"), "stage_name", "is_won")
    leads = m.stg_leads.select("lead_id", "converted_opportunity_id")
    return left_join_spread_nulls(leads, opp, "converted_opportunity_id", "o_id").select(
        "lead_id", "converted_opportunity_id", "stage_name", "is_won"
    )


@register("join_left_stored")
def _q_join_left_stored(spark, sf):
    """The enriched leads of a build: over the stored exports only leads with
    an opportunity id are shuffled."""
    from funnelworks.plans.pipeline import materialized_models

    return materialized_models(spark, load_raw_sources(spark, sf)).int_leads_enriched


@register("join_inner_month")
def _q_join_inner(spark, sf):
    m = models(spark, sf)
    cost = m.int_expenses_channel_month.select("month_date", "channel", "total_cost_usd")
    return m.int_funnel.select("month_date", "channel", "leads_created", "closed_won").join(
        cost, ["month_date", "channel"], "inner"
    )


@register("join_anti_fk")
def _q_join_anti(spark, sf):
    """Orders without any line item (anti join)."""
    orders = read_table(spark, sf, "orders", ["o_orderkey", "o_orderdate"])
    lines = read_table(spark, sf, "lineitem", ["l_orderkey"])
    return _dq.relationships(orders, "o_orderkey", lines, "l_orderkey")


@register("join_cross_scalar")
def _q_join_cross(spark, sf):
    m = models(spark, sf)
    s = m.stg_leads.agg(F.count(F.lit(1)).alias("staging_leads"))
    t = m.mart_leading_indicators.agg(F.count(F.lit(1)).alias("mart_leads"))
    return s.crossJoin(t).select("*", (F.col("mart_leads") - F.col("staging_leads")).alias("delta"))


@register("agg_monthly_volume")
def _q_monthly_volume(spark, sf):
    from funnelworks.plans.intermediate import monthly_volume

    return monthly_volume(models(spark, sf).stg_leads, "form_submission_date")


@register("agg_revenue_month")
def _q_revenue(spark, sf):
    r = _marts.monthly_revenue(models(spark, sf).mart_cac_ltv)
    return r.select(
        "month_date",
        "new_customers_won",
        F.col("estimated_monthly_ltv_usd").cast("decimal(20,2)").alias("estimated_monthly_ltv_usd"),
        F.col("total_cost_usd").cast("decimal(20,2)").alias("total_cost_usd"),
    )


@register("agg_weighted_avg")
def _q_weighted(spark, sf):
    r = _marts.monthly_revenue(models(spark, sf).mart_cac_ltv)
    return r.select("month_date", fx.exact_ratio("_cac_x_won", "_won").cast("decimal(12,2)").alias("blended_cac_usd"))


@register("agg_filtered_sum")
def _q_filtered(spark, sf):
    t = _marts.monthly_audit_totals(models(spark, sf).int_audit_by_month)
    return t.select(
        "month_date",
        *[F.col(c).cast("bigint").alias(c) for c in t.columns if c != "month_date"],
    )


@register("agg_engagement_month")
def _q_engagement(spark, sf):
    return models(spark, sf).mart_gtm_funnel.select(
        "month_date", "channel", "avg_speed_to_first_contact_hours", "avg_days_in_funnel", "avg_activity_count"
    )


@register("agg_pivot_channel_cac")
def _q_pivot(spark, sf):
    return _rs.pivot_max(models(spark, sf).mart_cac_ltv, "month_date", "channel", ["inbound", "outbound"], "cac_usd")


@register("agg_channels_per_month")
def _q_collect(spark, sf):
    return models(spark, sf).mart_cac_ltv.groupBy("month_date").agg(
        F.count(F.lit(1)).alias("channel_count"), F.array_sort(F.collect_list("channel")).alias("channels_present")
    )


@register("win_mom_delta")
def _q_mom(spark, sf):
    return models(spark, sf).mart_data_quality_monitor.select(
        "month_date", "mom_revenue_change_usd", "mom_audit_findings_change"
    )


@register("win_daily_events_delta")
def _q_events_delta(spark, sf):
    """Day-grain event counts with day-over-day change: the window runs over
    the (calendar-bounded) daily aggregate, never over raw events."""
    ev = read_table(spark, sf, "events", ["ts", "event_type"])
    daily = ev.groupBy(F.to_date("ts").alias("event_date")).agg(F.count(F.lit(1)).alias("events"))
    w = Window.orderBy("event_date")
    return daily.select("event_date", "events", (F.col("events") - F.lag("events").over(w)).alias("events_change"))


@register("win_partitioned_lag")
def _q_partitioned_lag(spark, sf):
    """lag() per event type over the daily aggregate (partitioned window)."""
    ev = read_table(spark, sf, "events", ["ts", "event_type", "value"])
    daily = ev.groupBy("event_type", F.to_date("ts").alias("event_date")).agg(F.count(F.lit(1)).alias("events"))
    w = Window.partitionBy("event_type").orderBy("event_date")
    return daily.select(
        "event_type", "event_date", "events", F.lag("events").over(w).alias("prev_events")
    )


@register("win_first_value_growth")
def _q_first_value(spark, sf):
    return _an.headcount_trend(models(spark, sf).int_expenses_channel_month, models(spark, sf).mart_cac_ltv)


@register("date_spine")
def _q_spine(spark, sf):
    """The 2020-2029 day spine with each day's inbound form submissions
    (zero on days without any): the calendar side has 3,653 rows and the
    lead side is aggregated to day grain first."""
    daily = (
        models(spark, sf)
        .stg_leads.filter(F.col("form_submission_date").isNotNull())
        .groupBy(F.col("form_submission_date").alias("date_day"))
        .agg(F.count(F.lit(1)).alias("leads_submitted"))
    )
    spine = _rs.date_spine(spark, "2020-01-01", "2030-01-01")
    return spine.join(daily, "date_day", "left").select(
        "date_day", F.coalesce(F.col("leads_submitted"), F.lit(0)).alias("leads_submitted")
    )


# ---- incremental refresh -------------------------------------------------------------

# Fixed scenario: an earlier CRM snapshot (orders placed before 1998) is
# built in full, then the complete sources are refreshed incrementally as of
# mid-June 2024 with the default two-month lookback.
SNAPSHOT_BEFORE = "1998-01-01"
RUN_AS_OF = "2024-06-15"


def snapshot_models(spark, sf) -> GtmModels:
    return GtmModels(load_raw_sources(spark, sf, orders_before=SNAPSHOT_BEFORE))


@register("inc_month_channel_refresh")
def _q_inc_cac(spark, sf):
    path = scratch_path(spark, "mart_cac_ltv")
    _inc.build_mart_cac_ltv(spark, snapshot_models(spark, sf), path, full_refresh=True)
    return _inc.build_mart_cac_ltv(spark, models(spark, sf), path, as_of=RUN_AS_OF)


@register("inc_funnel_refresh")
def _q_inc_funnel(spark, sf):
    path = scratch_path(spark, "mart_gtm_funnel")
    _inc.build_mart_gtm_funnel(spark, snapshot_models(spark, sf), path, full_refresh=True)
    return _inc.build_mart_gtm_funnel(spark, models(spark, sf), path, as_of=RUN_AS_OF)


@register("inc_lead_refresh")
def _q_inc_leads(spark, sf):
    base = scratch_path(spark, "mart_leading_indicators")
    _inc.build_mart_leading_indicators(spark, snapshot_models(spark, sf), base, full_refresh=True)
    return _inc.build_mart_leading_indicators(spark, models(spark, sf), base)


@register("inc_audit_month_refresh")
def _q_inc_audit(spark, sf):
    """Findings of the lookback's months counted again, older months kept."""
    path = scratch_path(spark, "int_audit_by_month")
    _inc.build_int_audit_by_month(spark, snapshot_models(spark, sf), path, full_refresh=True)
    return _inc.build_int_audit_by_month(spark, models(spark, sf), path, as_of=RUN_AS_OF)


@register("inc_monitor_refresh")
def _q_inc_monitor(spark, sf):
    """The monitor after a refresh of its two inputs: only months that differ
    and those compared with them are computed again."""
    cac, audit, path = (scratch_path(spark, t) for t in ("mart_cac_ltv", "int_audit_by_month", "mart_data_quality_monitor"))
    old, new = snapshot_models(spark, sf), models(spark, sf)
    before = (
        _inc.build_mart_cac_ltv(spark, old, cac, full_refresh=True),
        _inc.build_int_audit_by_month(spark, old, audit, full_refresh=True),
    )
    _inc.build_mart_data_quality_monitor(spark, *before, path, full_refresh=True)
    after = (
        _inc.build_mart_cac_ltv(spark, new, cac, as_of=RUN_AS_OF),
        _inc.build_int_audit_by_month(spark, new, audit, as_of=RUN_AS_OF),
    )
    changed = _inc.changed_months(before[0], after[0]).union(_inc.changed_months(before[1], after[1])).distinct()
    return _inc.build_mart_data_quality_monitor(spark, *after, path, changed)


@register("inc_lookback_filter")
def _q_inc_lookback(spark, sf):
    """The batch an incremental funnel run recomputes (months in lookback)."""
    return _inc.gtm_funnel_batch(models(spark, sf), lookback_start(RUN_AS_OF, _inc.DEFAULT_LOOKBACK_MONTHS))


@register("inc_watermark_filter")
def _q_inc_watermark(spark, sf):
    """Leads selected by the high-watermark of a stored snapshot mart."""
    base = scratch_path(spark, "mart_leading_indicators")
    stored = _inc.build_mart_leading_indicators(spark, snapshot_models(spark, sf), base, full_refresh=True)
    return watermark_filter(models(spark, sf).int_leads_enriched, stored, "last_sales_activity_at").select(
        "lead_id", "last_sales_activity_at"
    )


@register("enforce_contract")
def _q_enforce_contract(spark, sf):
    """The final cast projection: a frame whose columns carry raw / wider
    types (text location count, bigint list size, double LTV inputs) is cast
    to the restaurant-profile contract, which also checks names and order."""
    from funnelworks.operators.contracts import enforce_contract
    from funnelworks.plans.contracts_catalog import INT_RESTAURANT_PROFILE

    e = models(spark, sf).int_leads_enriched
    loose = e.select(
        "lead_sk",
        "lead_id",
        "channel",
        "is_converted",
        "is_won",
        F.col("location_count").cast("string").alias("location_count"),
        "cuisine_types_cleaned",
        fx.list_count("marketplaces_used_cleaned").cast("bigint").alias("marketplace_count"),
        F.col("olo_tools_cleaned").isNotNull().alias("has_olo_tool"),
        F.col("predicted_monthly_gmv_usd").cast("decimal(20,6)").alias("predicted_monthly_gmv_usd"),
        fx.ltv_estimate("predicted_monthly_gmv_usd").cast("decimal(20,6)").alias("estimated_annual_ltv_usd"),
    )
    return enforce_contract(loose, INT_RESTAURANT_PROFILE, cast=True)
