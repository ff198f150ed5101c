"""Oracle: generic operators (dedup, unpivot, joins, aggregates, windows)."""

from oracle.cte import rdiv, sql
from oracle.reports import REPORTS

OPS: dict[str, str] = {}


def q(key: str, final: str) -> None:
    OPS[key] = sql(final)


q("dedup_exact", "SELECT DISTINCT * FROM raw_opportunities")
q("dedup_events", "SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS event_date FROM events")
q("unpivot_channel_cost", "SELECT * FROM stg_expenses_salary")
q(
    "unpivot_lineitem_measures",
    "SELECT l_orderkey, l_linenumber, 'l_extendedprice' AS measure, l_extendedprice AS value FROM lineitem "
    "UNION ALL SELECT l_orderkey, l_linenumber, 'l_discount', l_discount FROM lineitem "
    "UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem",
)
q(
    "join_left_enrich",
    "SELECT l.lead_id, l.converted_opportunity_id, o.stage_name, o.is_won FROM stg_leads l "
    "LEFT JOIN stg_opportunities o ON l.converted_opportunity_id = o.opportunity_id",
)
q(
    "join_inner_month",
    "SELECT f.month_date, f.channel, f.leads_created, f.closed_won, e.total_cost_usd FROM int_funnel f "
    "JOIN int_expenses_channel_month e ON f.month_date = e.month_date AND f.channel = e.channel",
)
q("join_left_stored", "SELECT * FROM int_leads_enriched")
q(
    "join_anti_fk",
    "SELECT o_orderkey, o_orderdate FROM orders o WHERE o_orderkey IS NOT NULL "
    "AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)",
)
q(
    "join_cross_scalar",
    "SELECT s.n AS staging_leads, m.n AS mart_leads, m.n - s.n AS delta FROM (SELECT count(*) AS n FROM stg_leads) s "
    "CROSS JOIN (SELECT count(*) AS n FROM mart_leading_indicators) m",
)
q("agg_monthly_volume", "SELECT month_date, in_scope AS monthly_record_count FROM leads_in_month")
q(
    "agg_revenue_month",
    "SELECT month_date, CAST(sum(new_customers_won) AS BIGINT) AS new_customers_won, "
    "CAST(sum(new_customers_won * avg_estimated_ltv_usd) AS DECIMAL(20,2)) AS estimated_monthly_ltv_usd, "
    "CAST(sum(total_cost_usd) AS DECIMAL(20,2)) AS total_cost_usd FROM mart_cac_ltv GROUP BY month_date",
)
q("agg_weighted_avg", "SELECT month_date, blended_cac_usd FROM money_of_month")
q(
    "agg_filtered_sum",
    "SELECT month_date, CAST(total_findings AS BIGINT) AS total_findings, "
    "CAST(total_affected_records AS BIGINT) AS total_affected_records, "
    "CAST(total_records_in_scope AS BIGINT) AS total_records_in_scope, "
    "CAST(leads_findings AS BIGINT) AS leads_findings, CAST(opps_findings AS BIGINT) AS opps_findings, "
    "CAST(leads_affected AS BIGINT) AS leads_affected, CAST(opps_affected AS BIGINT) AS opps_affected "
    "FROM findings_of_month",
)
q(
    "agg_engagement_month",
    "SELECT month_date, channel, avg_speed_to_first_contact_hours, avg_days_in_funnel, avg_activity_count "
    "FROM mart_gtm_funnel",
)
q(
    "agg_pivot_channel_cac",
    "SELECT month_date, max(CASE WHEN channel = 'inbound' THEN cac_usd END) AS inbound, "
    "max(CASE WHEN channel = 'outbound' THEN cac_usd END) AS outbound FROM mart_cac_ltv GROUP BY month_date",
)
q(
    "agg_channels_per_month",
    "SELECT month_date, count(*) AS channel_count, list_sort(list(channel)) AS channels_present "
    "FROM mart_cac_ltv GROUP BY month_date",
)
q("win_mom_delta", "SELECT month_date, mom_revenue_change_usd, mom_audit_findings_change FROM mart_data_quality_monitor")
q(
    "win_daily_events_delta",
    "SELECT event_date, events, events - lag(events) OVER (ORDER BY event_date) AS events_change FROM "
    "(SELECT CAST(ts AS DATE) AS event_date, count(*) AS events FROM events GROUP BY 1) d",
)
q(
    "win_partitioned_lag",
    "SELECT event_type, event_date, events, lag(events) OVER (PARTITION BY event_type ORDER BY event_date) "
    "AS prev_events FROM (SELECT event_type, CAST(ts AS DATE) AS event_date, count(*) AS events FROM events "
    "GROUP BY 1, 2) d",
)
OPS["win_first_value_growth"] = REPORTS["analysis_headcount_trend"]
q(
    "date_spine",
    "SELECT s.date_day, coalesce(d.n, 0) AS leads_submitted FROM date_spine s LEFT JOIN "
    "(SELECT form_submission_date AS date_day, count(*) AS n FROM stg_leads WHERE form_submission_date IS NOT NULL "
    "GROUP BY 1) d ON s.date_day = d.date_day",
)
_ = rdiv
OPS["enforce_contract"] = sql("SELECT * FROM int_restaurant_profile")
