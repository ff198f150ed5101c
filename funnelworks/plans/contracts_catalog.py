"""Declared output contracts of every model (names and types, in order)."""

from funnelworks.operators.contracts import contract

STG_EXPENSES_ADVERTISING = contract(
    ("expense_advertising_sk", "string"), ("month_date", "date"), ("advertising_spend_usd", "decimal(20,2)")
)
STG_EXPENSES_SALARY = contract(
    ("expense_salary_sk", "string"),
    ("month_date", "date"),
    ("sales_channel", "string"),
    ("salary_and_commissions_usd", "decimal(20,2)"),
)
STG_LEADS = contract(
    ("lead_sk", "string"),
    ("lead_id", "string"),
    ("converted_opportunity_id", "string"),
    ("status", "string"),
    ("is_converted", "boolean"),
    ("is_disqualified", "boolean"),
    ("sales_call_count", "int"),
    ("sales_text_count", "int"),
    ("sales_email_count", "int"),
    ("total_activity_count", "int"),
    ("connected_with_decision_maker", "boolean"),
    ("location_count", "int"),
    ("predicted_monthly_gmv_usd", "decimal(12,2)"),
    ("marketplaces_used_cleaned", "string"),
    ("olo_tools_cleaned", "string"),
    ("cuisine_types_cleaned", "string"),
    ("form_submission_date", "date"),
    ("first_sales_call_at", "timestamp_ntz"),
    ("first_text_sent_at", "timestamp_ntz"),
    ("first_meeting_booked_at", "timestamp_ntz"),
    ("last_sales_call_at", "timestamp_ntz"),
    ("last_sales_activity_at", "timestamp_ntz"),
    ("last_sales_email_at", "timestamp_ntz"),
)
STG_OPPORTUNITIES = contract(
    ("opportunity_sk", "string"),
    ("opportunity_id", "string"),
    ("account_id", "string"),
    ("stage_name", "string"),
    ("is_won", "boolean"),
    ("is_lost", "boolean"),
    ("is_open", "boolean"),
    ("attribution_source", "string"),
    ("lost_reason", "string"),
    ("closed_lost_notes", "string"),
    ("business_issue", "string"),
    ("demo_held", "boolean"),
    ("created_at", "timestamp_ntz"),
    ("demo_scheduled_at", "timestamp_ntz"),
    ("last_sales_call_at", "timestamp_ntz"),
    ("demo_set_date", "date"),
    ("close_date", "date"),
)
AUDIT = contract(
    ("audit_sk", "string"),
    ("source_table", "string"),
    ("record_key", "string"),
    ("audit_category", "string"),
    ("audit_detail", "string"),
    ("diagnostic_info", "string"),
)
INT_EXPENSES_CHANNEL_MONTH = contract(
    ("expense_channel_month_sk", "string"),
    ("month_date", "date"),
    ("channel", "string"),
    ("salary_and_commissions_usd", "decimal(20,2)"),
    ("advertising_spend_usd", "decimal(20,2)"),
    ("total_cost_usd", "decimal(20,2)"),
)
INT_LEADS_ENRICHED = contract(
    ("lead_sk", "string"),
    ("lead_id", "string"),
    ("converted_opportunity_id", "string"),
    ("opportunity_sk", "string"),
    ("account_id", "string"),
    ("channel", "string"),
    ("stage_name", "string"),
    ("is_won", "boolean"),
    ("is_lost", "boolean"),
    ("is_open", "boolean"),
    ("attribution_source", "string"),
    ("lost_reason", "string"),
    ("demo_held", "boolean"),
    ("demo_set_date", "date"),
    ("close_date", "date"),
    ("status", "string"),
    ("is_converted", "boolean"),
    ("is_disqualified", "boolean"),
    ("sales_call_count", "int"),
    ("sales_text_count", "int"),
    ("sales_email_count", "int"),
    ("total_activity_count", "int"),
    ("connected_with_decision_maker", "boolean"),
    ("location_count", "int"),
    ("predicted_monthly_gmv_usd", "decimal(12,2)"),
    ("marketplaces_used_cleaned", "string"),
    ("olo_tools_cleaned", "string"),
    ("cuisine_types_cleaned", "string"),
    ("form_submission_date", "date"),
    ("first_sales_call_at", "timestamp_ntz"),
    ("first_text_sent_at", "timestamp_ntz"),
    ("first_meeting_booked_at", "timestamp_ntz"),
    ("last_sales_call_at", "timestamp_ntz"),
    ("last_sales_activity_at", "timestamp_ntz"),
    ("last_sales_email_at", "timestamp_ntz"),
    ("opportunity_created_at", "timestamp_ntz"),
    ("demo_scheduled_at", "timestamp_ntz"),
    ("opp_last_sales_call_at", "timestamp_ntz"),
    ("speed_to_first_contact_hours", "decimal(10,2)"),
    ("days_in_funnel", "decimal(8,2)"),
)
INT_FUNNEL = contract(
    ("funnel_channel_month_sk", "string"),
    ("month_date", "date"),
    ("channel", "string"),
    ("leads_created", "bigint"),
    ("demos_set", "bigint"),
    ("demos_held", "bigint"),
    ("closed_won", "bigint"),
    ("closed_lost", "bigint"),
    ("lead_to_demo_set_rate", "decimal(6,4)"),
    ("demo_set_to_held_rate", "decimal(8,4)"),
    ("demo_to_close_rate", "decimal(6,4)"),
    ("overall_conversion_rate", "decimal(6,4)"),
)
INT_RESTAURANT_PROFILE = contract(
    ("lead_sk", "string"),
    ("lead_id", "string"),
    ("channel", "string"),
    ("is_converted", "boolean"),
    ("is_won", "boolean"),
    ("location_count", "int"),
    ("cuisine_types_cleaned", "string"),
    ("marketplace_count", "int"),
    ("has_olo_tool", "boolean"),
    ("predicted_monthly_gmv_usd", "decimal(12,2)"),
    ("estimated_annual_ltv_usd", "decimal(12,2)"),
)
# Counts that grow with the data volume (findings, records per month) are
# bigint: a 32-bit integer would overflow past 2^31 rows in one month.
INT_AUDIT_BY_MONTH = contract(
    ("audit_month_sk", "string"),
    ("month_date", "date"),
    ("source_table", "string"),
    ("audit_category", "string"),
    ("finding_count", "bigint"),
    ("affected_records", "bigint"),
    ("monthly_record_count", "bigint"),
    ("pct_of_monthly_total", "decimal(6,4)"),
)
MART_CAC_LTV = contract(
    ("cac_ltv_sk", "string"),
    ("month_date", "date"),
    ("channel", "string"),
    ("total_cost_usd", "decimal(20,2)"),
    ("new_customers_won", "bigint"),
    ("cac_usd", "decimal(12,2)"),
    ("avg_predicted_monthly_gmv_usd", "decimal(12,2)"),
    ("avg_estimated_ltv_usd", "decimal(12,2)"),
    ("cac_ltv_ratio", "decimal(14,4)"),
)
MART_GTM_FUNNEL = contract(
    ("gtm_funnel_sk", "string"),
    ("month_date", "date"),
    ("channel", "string"),
    ("leads_created", "bigint"),
    ("demos_set", "bigint"),
    ("demos_held", "bigint"),
    ("closed_won", "bigint"),
    ("closed_lost", "bigint"),
    ("lead_to_demo_set_rate", "decimal(6,4)"),
    ("demo_set_to_held_rate", "decimal(8,4)"),
    ("demo_to_close_rate", "decimal(6,4)"),
    ("overall_conversion_rate", "decimal(6,4)"),
    ("avg_speed_to_first_contact_hours", "decimal(10,2)"),
    ("avg_days_in_funnel", "decimal(8,2)"),
    ("avg_activity_count", "decimal(8,2)"),
)
MART_LEADING_INDICATORS = contract(
    ("lead_sk", "string"),
    ("lead_id", "string"),
    ("channel", "string"),
    ("status", "string"),
    ("is_converted", "boolean"),
    ("is_disqualified", "boolean"),
    ("connected_with_decision_maker", "boolean"),
    ("speed_to_first_contact_hours", "decimal(10,2)"),
    ("days_in_funnel", "decimal(8,2)"),
    ("total_activity_count", "int"),
    ("last_sales_activity_at", "timestamp_ntz"),
    ("activity_density_score", "decimal(8,4)"),
    ("predicted_monthly_gmv_usd", "decimal(12,2)"),
    ("estimated_annual_ltv_usd", "decimal(12,2)"),
    ("marketplace_count", "int"),
    ("has_olo_tool", "boolean"),
    ("conversion_probability_tier", "string"),
)
MART_DATA_QUALITY_MONITOR = contract(
    ("dq_monitor_sk", "string"),
    ("month_date", "date"),
    ("new_customers_won", "bigint"),
    ("estimated_monthly_ltv_usd", "decimal(20,2)"),
    ("total_cost_usd", "decimal(20,2)"),
    ("blended_cac_usd", "decimal(12,2)"),
    ("mom_revenue_change_usd", "decimal(20,2)"),
    ("total_audit_findings", "bigint"),
    ("total_audit_affected_records", "bigint"),
    ("total_records_in_scope", "bigint"),
    ("overall_audit_density", "decimal(6,4)"),
    ("leads_audit_findings", "bigint"),
    ("opps_audit_findings", "bigint"),
    ("leads_audit_affected", "bigint"),
    ("opps_audit_affected", "bigint"),
    ("mom_audit_findings_change", "bigint"),
)
DATE_SPINE = contract(("date_day", "date"))
