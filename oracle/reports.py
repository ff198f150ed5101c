"""Oracle: analyses, verified queries and governed metrics as DuckDB SQL."""

from oracle.cte import rdiv, sql

REPORTS: dict[str, str] = {}


def scaled(x: str, s: int) -> str:
    return f"CAST(({x}) * {10**s} AS HUGEINT)"


def avg_exact(x: str, in_scale: int, out_scale: int, precision: int) -> str:
    return rdiv(f"sum({scaled(x, in_scale)})", f"{10**in_scale} * count({x})", out_scale, precision)


def q(key: str, final: str) -> None:
    REPORTS[key] = sql(final)


# ---- analyses ---------------------------------------------------------------
# Waiting times are cut by tables of bands: (name, above, up to) in hours.
# Names and bounds of the bands, July 2024, January to June 2024.
SPEED_BANDS = """(VALUES ('1_le_24h', 0, 24), ('2_24_to_72h', 24, 72), ('3_72_to_168h', 72, 168),
  ('4_gt_168h', 168, NULL)) AS band(name, above, up_to)"""
RECENCY_BANDS = """(VALUES ('1_contacted_le_1_week', 0, 168), ('2_contacted_1w_to_1mo', 168, 720),
  ('3_contacted_1mo_to_1yr', 720, 8760), ('4_stale_gt_1yr', 8760, NULL)) AS band(name, above, up_to)"""
JULY = ("TIMESTAMP '2024-07-01'", "TIMESTAMP '2024-08-01'")
HALF_YEAR = "[DATE '2024-01-01' + to_months(i) FOR i IN range(6)]"


def in_band(bands: str) -> str:
    """Inbound leads that waited, each with its band."""
    return f"""(SELECT band.name, e.speed_to_first_contact_hours AS hours, e.is_converted, e.is_won
  FROM int_leads_enriched e JOIN {bands}
    ON e.speed_to_first_contact_hours > band.above
   AND e.speed_to_first_contact_hours <= coalesce(band.up_to, e.speed_to_first_contact_hours)
  WHERE e.channel = 'inbound')"""


q(
    "analysis_speed_buckets",
    f"""
SELECT name AS speed_bucket, leads, converted, won, {rdiv('converted', 'leads', 3, 7)} AS conversion_rate,
  {rdiv('won', 'leads', 3, 7)} AS won_rate, {rdiv('waited', '100 * leads', 1, 12)} AS avg_speed_hours
FROM (SELECT name, count(*) AS leads, count(*) FILTER (is_converted) AS converted,
             count(*) FILTER (is_won) AS won, sum({scaled('hours', 2)}) AS waited
      FROM {in_band(SPEED_BANDS)} GROUP BY name)
""",
)

q(
    "analysis_recency_buckets",
    f"""
SELECT name AS recency_bucket, leads, converted, {rdiv('converted', 'leads', 3, 7)} AS conversion_rate,
  CAST(shortest AS DECIMAL(12,0)) AS min_hours, CAST(longest AS DECIMAL(12,0)) AS max_hours
FROM (SELECT name, count(*) AS leads, count(*) FILTER (is_converted) AS converted, min(hours) AS shortest,
             max(hours) AS longest FROM {in_band(RECENCY_BANDS)} GROUP BY name)
""",
)

q(
    "analysis_month_completeness",
    f"""
SELECT channel, leads_created, closed_won, {rdiv('closed_won', 'leads_created', 4, 8)} AS conversion_rate,
  CAST(first_in AS DATE) AS earliest_entry, CAST(last_in AS DATE) AS latest_entry,
  CAST(last_active AS DATE) AS latest_activity
FROM (SELECT channel, count(*) AS leads_created, count(*) FILTER (is_won) AS closed_won, min(entered) AS first_in,
             max(entered) AS last_in, max(last_sales_activity_at) AS last_active
      FROM (SELECT *, coalesce(CAST(form_submission_date AS TIMESTAMP), first_sales_call_at) AS entered
            FROM int_leads_enriched)
      WHERE entered >= {JULY[0]} AND entered < {JULY[1]} GROUP BY channel)
""",
)

# The enriched row already carries its opportunity.
q(
    "analysis_won_detail",
    f"""
SELECT lead_id, CAST(first_sales_call_at AS DATE) AS entry_date, close_date, stage_name, demo_set_date, demo_held,
  total_activity_count, days_in_funnel
FROM int_leads_enriched
WHERE is_won AND form_submission_date IS NULL AND first_sales_call_at >= {JULY[0]} AND first_sales_call_at < {JULY[1]}
""",
)

q(
    "analysis_funnel_stage_rates",
    f"""
SELECT month_date, f.channel, leads_created, demos_set, demos_held, closed_won, lead_to_demo_set_rate,
  demo_set_to_held_rate, demo_to_close_rate, overall_conversion_rate
FROM (SELECT CAST(unnest({HALF_YEAR}) AS DATE) AS month_date, 'outbound' AS channel) wanted
JOIN mart_gtm_funnel f USING (month_date, channel)
""",
)

# Growth is against the salaries of the earliest month that has both tables.
q(
    "analysis_headcount_trend",
    f"""
SELECT t.month_date, headcount_cost_usd, total_cost_usd, new_customers_won, cac_usd, cac_ltv_ratio,
  {rdiv('100 * (now_cents - start_cents)', 'start_cents', 1, 8)} AS headcount_cost_growth_pct
FROM (SELECT month_date, e.salary_and_commissions_usd AS headcount_cost_usd, e.total_cost_usd,
             c.new_customers_won, c.cac_usd, c.cac_ltv_ratio, {scaled('e.salary_and_commissions_usd', 2)} AS now_cents
      FROM mart_cac_ltv c JOIN int_expenses_channel_month e USING (month_date, channel)
      WHERE channel = 'outbound') t,
     (SELECT arg_min({scaled('e.salary_and_commissions_usd', 2)}, month_date) AS start_cents
      FROM mart_cac_ltv c JOIN int_expenses_channel_month e USING (month_date, channel)
      WHERE channel = 'outbound') s
""",
)

# ---- verified queries -------------------------------------------------------------
# Month reports start from the wanted months and look the marts up.
def half_year(key: str, mart: str, columns: str, channel: str | None = None) -> None:
    only = f" AND channel = '{channel}'" if channel else ""
    q(
        key,
        f"SELECT {columns} FROM (SELECT CAST(unnest({HALF_YEAR}) AS DATE) AS month_date) wanted "
        f"JOIN {mart} USING (month_date) WHERE true{only}",
    )


half_year("vq_outbound_cac", "mart_cac_ltv", "month_date, cac_usd, new_customers_won, cac_ltv_ratio", "outbound")
half_year(
    "vq_funnel_rates",
    "mart_gtm_funnel",
    "channel, month_date, leads_created, lead_to_demo_set_rate, demo_to_close_rate, overall_conversion_rate",
)
half_year(
    "vq_speed_impact",
    "mart_gtm_funnel",
    "month_date, channel, avg_speed_to_first_contact_hours, overall_conversion_rate, lead_to_demo_set_rate",
    "inbound",
)

# Sums of channel and tier in one table; both lead reports divide them.
TIER_SUMS = f"""(SELECT channel, conversion_probability_tier, is_disqualified IS TRUE AS out_of_scope,
    count(*) AS leads, sum({scaled('predicted_monthly_gmv_usd', 2)}) AS gmv, count(predicted_monthly_gmv_usd) AS gmv_n,
    sum({scaled('estimated_annual_ltv_usd', 2)}) AS ltv, count(estimated_annual_ltv_usd) AS ltv_n
  FROM mart_leading_indicators GROUP BY ALL)"""
q(
    "vq_lead_tier_counts",
    f"""
SELECT channel, conversion_probability_tier, leads AS lead_count, {rdiv('gmv', '100 * gmv_n', 0, 14)} AS avg_gmv_usd
FROM {TIER_SUMS} WHERE NOT out_of_scope
""",
)
q(
    "vq_hot_pipeline",
    f"""
SELECT channel, CAST(leads AS BIGINT) AS hot_lead_count, {rdiv('gmv', '100 * gmv_n', 0, 14)} AS avg_gmv_usd,
  {rdiv('ltv', '100 * ltv_n', 0, 14)} AS avg_ltv_usd, {rdiv('ltv', '100', 0, 20)} AS total_pipeline_ltv_usd
FROM (SELECT channel, sum(leads) AS leads, sum(gmv) AS gmv, sum(gmv_n) AS gmv_n, sum(ltv) AS ltv, sum(ltv_n) AS ltv_n
      FROM {TIER_SUMS} WHERE conversion_probability_tier = 'hot' GROUP BY channel)
""",
)
# The ratio before is that of the channel's latest earlier month.
q(
    "vq_cac_ltv_trend",
    """
SELECT n.channel, n.month_date, n.cac_usd, n.avg_estimated_ltv_usd, n.cac_ltv_ratio,
  b.cac_ltv_ratio AS prev_month_ratio, CAST(n.cac_ltv_ratio - b.cac_ltv_ratio AS DECIMAL(15,4)) AS mom_change
FROM mart_cac_ltv n ASOF LEFT JOIN mart_cac_ltv b ON n.channel = b.channel AND n.month_date > b.month_date
""",
)

# ---- governed metrics ---------------------------------------------------------------
MONTH_DIMS = "channel, CAST(date_trunc('month', month_date) AS DATE) AS month_date__month"


def metric_sql(table: str, dims: str, expr: str, name: str, where: str = "") -> str:
    w = f" WHERE {where}" if where else ""
    return f"SELECT {dims}, {expr} AS {name} FROM {table}{w} GROUP BY ALL"


CAC_SUM = {"total_gtm_spend": ("total_cost_usd", "DECIMAL(22,2)"), "new_customers_won": ("new_customers_won", "BIGINT")}
for name, (col, typ) in CAC_SUM.items():
    q(f"metric_{name}", metric_sql("mart_cac_ltv", MONTH_DIMS, f"CAST(sum({col}) AS {typ})", name))
for name, col, s in [
    ("cac_usd", "cac_usd", 2),
    ("cac_ltv_ratio", "cac_ltv_ratio", 4),
    ("avg_estimated_ltv", "avg_estimated_ltv_usd", 2),
]:
    q(f"metric_{name}", metric_sql("mart_cac_ltv", MONTH_DIMS, avg_exact(col, s, 6, 18), name))

q("metric_leads_created", metric_sql("mart_gtm_funnel", MONTH_DIMS, "CAST(sum(leads_created) AS BIGINT)", "leads_created"))
for name, col, s in [
    ("inbound_conversion_rate", "overall_conversion_rate", 4),
    ("lead_to_demo_set_rate", "lead_to_demo_set_rate", 4),
    ("avg_speed_to_first_contact", "avg_speed_to_first_contact_hours", 2),
    ("avg_days_in_funnel", "avg_days_in_funnel", 2),
]:
    q(f"metric_{name}", metric_sql("mart_gtm_funnel", MONTH_DIMS, avg_exact(col, s, 6, 18), name))

LEAD_DIMS = "channel"
q("metric_total_lead_count", metric_sql("mart_leading_indicators", LEAD_DIMS, "count(lead_sk)", "total_lead_count"))
q(
    "metric_converted_lead_count",
    metric_sql(
        "mart_leading_indicators",
        LEAD_DIMS,
        "CAST(sum(CASE WHEN is_converted = true THEN 1 ELSE 0 END) AS BIGINT)",
        "converted_lead_count",
    ),
)
for name, tier in [("hot", "hot"), ("warm", "warm"), ("cold", "cold"), ("converted_customer", "converted")]:
    q(
        f"metric_{name}_count" if name == "converted_customer" else f"metric_{name}_lead_count",
        metric_sql(
            "mart_leading_indicators",
            LEAD_DIMS,
            f"count(CASE WHEN conversion_probability_tier = '{tier}' THEN lead_sk END)",
            f"{name}_count" if name == "converted_customer" else f"{name}_lead_count",
        ),
    )
q(
    "metric_avg_prospect_gmv",
    metric_sql("mart_leading_indicators", LEAD_DIMS, avg_exact("predicted_monthly_gmv_usd", 2, 6, 18), "avg_prospect_gmv"),
)
q(
    "metric_pipeline_conversion_rate",
    metric_sql(
        "mart_leading_indicators",
        LEAD_DIMS,
        rdiv("sum(CASE WHEN is_converted = true THEN 1 ELSE 0 END)", "count(lead_sk)", 6, 18),
        "pipeline_conversion_rate",
    ),
)

q(
    "metric_query_cac_ltv_vs_demo_rate",
    f"""
SELECT coalesce(a.m, b.m) AS month_date__month, a.cac_ltv_ratio, b.lead_to_demo_set_rate FROM
 (SELECT CAST(date_trunc('month', month_date) AS DATE) AS m, {avg_exact('cac_ltv_ratio', 4, 6, 18)} AS cac_ltv_ratio
  FROM mart_cac_ltv GROUP BY 1) a
FULL OUTER JOIN
 (SELECT CAST(date_trunc('month', month_date) AS DATE) AS m,
         {avg_exact('lead_to_demo_set_rate', 4, 6, 18)} AS lead_to_demo_set_rate
  FROM mart_gtm_funnel GROUP BY 1) b
ON a.m IS NOT DISTINCT FROM b.m
""",
)
q(
    "metric_query_tier_counts",
    """
SELECT channel,
  count(CASE WHEN conversion_probability_tier = 'hot' THEN lead_sk END) AS hot_lead_count,
  count(CASE WHEN conversion_probability_tier = 'warm' THEN lead_sk END) AS warm_lead_count
FROM mart_leading_indicators GROUP BY channel
""",
)
q(
    "metric_query_outbound_2024",
    f"""
SELECT coalesce(a.m, b.m) AS month_date__month, a.cac_usd, b.leads_created, b.inbound_conversion_rate FROM
 (SELECT CAST(date_trunc('month', month_date) AS DATE) AS m, {avg_exact('cac_usd', 2, 6, 18)} AS cac_usd
  FROM mart_cac_ltv WHERE channel = 'outbound' AND month_date BETWEEN DATE '2024-01-01' AND DATE '2024-06-01'
  GROUP BY 1) a
FULL OUTER JOIN
 (SELECT CAST(date_trunc('month', month_date) AS DATE) AS m, CAST(sum(leads_created) AS BIGINT) AS leads_created,
         {avg_exact('overall_conversion_rate', 4, 6, 18)} AS inbound_conversion_rate
  FROM mart_gtm_funnel WHERE channel = 'outbound' AND month_date BETWEEN DATE '2024-01-01' AND DATE '2024-06-01'
  GROUP BY 1) b
ON a.m IS NOT DISTINCT FROM b.m
""",
)

q(
    "metric_query_named_filter",
    f"""
SELECT channel, count(CASE WHEN conversion_probability_tier = 'hot' THEN lead_sk END) AS hot_lead_count,
  {avg_exact('predicted_monthly_gmv_usd', 2, 6, 18)} AS avg_prospect_gmv
FROM mart_leading_indicators WHERE channel = 'inbound' AND is_disqualified = false GROUP BY channel
""",
)

q(
    "metric_query_leads_by_activity_month",
    f"""
SELECT channel, CAST(date_trunc('month', last_sales_activity_at) AS DATE) AS last_sales_activity_at__month,
  count(lead_sk) AS total_lead_count,
  count(CASE WHEN conversion_probability_tier = 'hot' THEN lead_sk END) AS hot_lead_count,
  {avg_exact('predicted_monthly_gmv_usd', 2, 6, 18)} AS avg_prospect_gmv
FROM mart_leading_indicators GROUP BY ALL
""",
)
q(
    "metric_query_metric_time",
    f"""
SELECT coalesce(a.m, b.m) AS metric_time__month, a.cac_usd, b.total_lead_count FROM
 (SELECT CAST(date_trunc('month', month_date) AS DATE) AS m, {avg_exact('cac_usd', 2, 6, 18)} AS cac_usd
  FROM mart_cac_ltv GROUP BY 1) a
FULL OUTER JOIN
 (SELECT CAST(date_trunc('month', last_sales_activity_at) AS DATE) AS m, count(lead_sk) AS total_lead_count
  FROM mart_leading_indicators GROUP BY 1) b
ON a.m IS NOT DISTINCT FROM b.m
""",
)

# ---- bare measures, filters, entities ------------------------------------------------
for name, table, dims, expr in [
    ("demo_to_close_rate", "mart_gtm_funnel", MONTH_DIMS, avg_exact("demo_to_close_rate", 4, 6, 18)),
    ("demos_set", "mart_gtm_funnel", MONTH_DIMS, "CAST(sum(demos_set) AS BIGINT)"),
    ("demos_held", "mart_gtm_funnel", MONTH_DIMS, "CAST(sum(demos_held) AS BIGINT)"),
    ("closed_won", "mart_gtm_funnel", MONTH_DIMS, "CAST(sum(closed_won) AS BIGINT)"),
    ("closed_lost", "mart_gtm_funnel", MONTH_DIMS, "CAST(sum(closed_lost) AS BIGINT)"),
    ("avg_activity_density_score", "mart_leading_indicators", LEAD_DIMS, avg_exact("activity_density_score", 4, 6, 18)),
]:
    q(f"measure_{name}", metric_sql(table, dims, expr, name))
q(
    "measure_lead_universe_avg_speed_to_first_contact_hours",
    metric_sql(
        "mart_leading_indicators", LEAD_DIMS, avg_exact("speed_to_first_contact_hours", 2, 6, 18),
        "lead_universe__avg_speed_to_first_contact_hours",
    ),
)

IN_2024 = "month_date >= DATE '2024-01-01' AND month_date <= DATE '2024-06-01'"
FILTERS = {
    "gtm_channel_month": (
        "mart_cac_ltv",
        {"inbound_only": "channel = 'inbound'", "outbound_only": "channel = 'outbound'", "jan_jun_2024": IN_2024},
        {"total_gtm_spend": ("total_cost_usd", None, "CAST(sum({}) AS DECIMAL(30,2))"), "cac_usd": ("cac_usd", 2, None)},
    ),
    "gtm_funnel": (
        "mart_gtm_funnel",
        {"outbound_2024": f"channel = 'outbound' AND {IN_2024}", "inbound_2024": f"channel = 'inbound' AND {IN_2024}"},
        {"leads_created": ("leads_created", None, "CAST(sum({}) AS BIGINT)"), "lead_to_demo_set_rate": ("lead_to_demo_set_rate", 4, None)},
    ),
    "lead_universe": (
        "mart_leading_indicators",
        {
            **{f"{t}_leads": f"conversion_probability_tier = '{t}'" for t in ("hot", "warm", "cold")},
            "converted_customers": "conversion_probability_tier = 'converted'",
            "active_unscored": "NOT is_disqualified AND conversion_probability_tier IS NOT NULL",
            "inbound_active": "channel = 'inbound' AND NOT is_disqualified",
            "outbound_active": "channel = 'outbound' AND NOT is_disqualified",
        },
        {"total_lead_count": ("lead_sk", None, "count({})"), "avg_prospect_gmv": ("predicted_monthly_gmv_usd", 2, None)},
    ),
}
for model, (table, filters, columns) in FILTERS.items():
    parts = []
    for f, condition in filters.items():
        for metric, (col, scale, agg) in columns.items():
            chosen = f"(CASE WHEN {condition} THEN {col} END)"
            value = agg.format(chosen) if agg else avg_exact(chosen, scale, 6, 18)
            parts.append(f"{value} AS {f}__{metric}")
    q(f"metric_filters_{model}", f"SELECT channel, {', '.join(parts)} FROM {table} GROUP BY channel")
q(
    "metric_query_combined_filters",
    f"""
SELECT coalesce(a.m, b.m) AS month_date__month, cac_usd, new_customers_won, demo_to_close_rate FROM
 (SELECT month_date AS m, {avg_exact('cac_usd', 2, 6, 18)} AS cac_usd, CAST(sum(new_customers_won) AS BIGINT) AS new_customers_won
  FROM mart_cac_ltv WHERE channel = 'inbound' AND {IN_2024} AND month_date > DATE '2024-01-01' GROUP BY 1) a
FULL OUTER JOIN
 (SELECT month_date AS m, {avg_exact('demo_to_close_rate', 4, 6, 18)} AS demo_to_close_rate
  FROM mart_gtm_funnel WHERE channel = 'inbound' AND {IN_2024} AND month_date > DATE '2024-01-01' GROUP BY 1) b
ON a.m = b.m
""",
)
q(
    "metric_query_filter_across_models",
    f"""
SELECT coalesce(a.channel, b.channel) AS channel, hot_lead_count, cac_usd FROM
 (SELECT channel, count(*) FILTER (WHERE conversion_probability_tier = 'hot') AS hot_lead_count
  FROM mart_leading_indicators WHERE channel = 'inbound' AND NOT is_disqualified GROUP BY 1) a
FULL OUTER JOIN
 (SELECT channel, {avg_exact('cac_usd', 2, 6, 18)} AS cac_usd FROM mart_cac_ltv WHERE channel = 'inbound' GROUP BY 1) b
ON a.channel = b.channel
""",
)
q(
    "metric_query_entity_dimensions",
    f"""
SELECT conversion_probability_tier AS lead__conversion_probability_tier, has_olo_tool AS lead__has_olo_tool,
  CAST(date_trunc('month', last_sales_activity_at) AS DATE) AS lead__last_sales_activity_at__month,
  count(lead_sk) AS total_lead_count, {avg_exact('predicted_monthly_gmv_usd', 2, 6, 18)} AS avg_prospect_gmv
FROM mart_leading_indicators GROUP BY ALL
""",
)
