"""Oracle: scalar functions evaluated over whole tables."""

from oracle.cte import rdiv, sql
from oracle.models import blank, catlist, cts, euro_num, fixdate, micros, month_of, sk

FUNCS: dict[str, str] = {}


def q(key: str, final: str) -> None:
    FUNCS[key] = sql(final)


q("fn_fix_millennium_date",
  f"SELECT lead_id, form_submission_date, {fixdate('form_submission_date')} AS fixed_date FROM raw_leads")
q("fn_clean_timestamp",
  f"SELECT lead_id, first_sales_call_date, {cts('first_sales_call_date')} AS cleaned_at FROM raw_leads")
q("fn_clean_category_list",
  f"SELECT lead_id, {catlist('marketplaces_used')} AS marketplaces, {catlist('online_ordering_used')} AS olo_tools, "
  f"{catlist('cuisine_types')} AS cuisines FROM raw_leads")
q("fn_parse_european_numeric",
  f"SELECT lead_id, predicted_sales, {euro_num('predicted_sales')} AS amount FROM raw_leads")
q("fn_blank_to_null", "SELECT lead_id, nullif(trim(converted_opportunity_id), '') AS opportunity_id FROM raw_leads")
q("fn_normalize_status",
  "SELECT lead_id, status, CASE WHEN status = 'Incorrect_Contact_Data' THEN 'Incorrect Contact Data' ELSE status END "
  "AS status_clean FROM raw_leads")
q("fn_status_flags",
  "SELECT lead_id, coalesce(status = 'Converted', false) AS is_converted, coalesce(status IN ('Disqualified', "
  "'Not Interested', 'Incorrect Contact Data', 'Incorrect_Contact_Data', 'No Longer With Company'), false) "
  "AS is_disqualified FROM raw_leads")
q("fn_total_activity",
  "SELECT lead_id, coalesce(sales_call_count, 0) + coalesce(sales_text_count, 0) + coalesce(sales_email_count, 0) "
  "AS total_activity FROM stg_leads")
q("fn_derive_channel",
  "SELECT lead_id, CASE WHEN form_submission_date IS NOT NULL THEN 'inbound' ELSE 'outbound' END AS channel FROM stg_leads")
q("fn_hours_between",
  f"SELECT lead_id, {rdiv(micros('first_sales_call_at', 'last_sales_activity_at'), '3600000000', 6, 20)} AS hours, "
  f"{rdiv(micros('first_sales_call_at', 'last_sales_email_at'), '86400000000', 6, 20)} AS days FROM stg_leads")
q("fn_month_trunc", "SELECT event_id, CAST(date_trunc('month', ts) AS DATE) AS month_date FROM events")
q("fn_cohort_month",
  "SELECT lead_id, (channel = 'inbound' AND form_submission_date IS NOT NULL) OR "
  "(channel = 'outbound' AND first_sales_call_at IS NOT NULL) AS has_anchor, "
  "CASE WHEN channel = 'inbound' THEN CAST(date_trunc('month', form_submission_date) AS DATE) "
  "ELSE CAST(date_trunc('month', first_sales_call_at) AS DATE) END AS cohort_month FROM int_leads_enriched")
q("fn_list_count",
  "SELECT lead_id, CASE WHEN marketplaces_used_cleaned IS NULL THEN 0 "
  "ELSE CAST(len(string_split(marketplaces_used_cleaned, ',')) AS INTEGER) END AS marketplace_count FROM stg_leads")
q("fn_ltv_estimate",
  "SELECT lead_id, CASE WHEN predicted_monthly_gmv_usd IS NOT NULL THEN "
  "CAST(round(predicted_monthly_gmv_usd * 0.05 * 12 + 6000, 2) AS DECIMAL(12,2)) END AS ltv FROM stg_leads")
q("fn_activity_density",
  f"SELECT lead_id, CASE WHEN days_in_funnel IS NOT NULL AND total_activity_count IS NOT NULL THEN "
  f"{rdiv('CAST(total_activity_count AS HUGEINT) * 100', 'greatest(CAST(days_in_funnel * 100 AS HUGEINT), 100)', 4, 8)}"
  f" END AS density FROM int_leads_enriched")
q("fn_surrogate_key",
  f"SELECT lead_id, {sk('lead_id', 'converted_opportunity_id', 'form_submission_date')} AS sk FROM stg_leads")
q("fn_safe_divide",
  f"SELECT l_orderkey, l_linenumber, "
  f"{rdiv('CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS HUGEINT)', 'CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS HUGEINT)', 6, 20)}"
  f" AS price_per_discount FROM lineitem")
q("fn_month_label", f"SELECT month, {month_of('month')} AS month_date FROM raw_expenses_salary")
q("score_tier", "SELECT lead_id, conversion_probability_tier FROM mart_leading_indicators")
q("bucket_speed",
  "SELECT lead_id, CASE WHEN speed_to_first_contact_hours <= 24 THEN '1_le_24h' "
  "WHEN speed_to_first_contact_hours <= 72 THEN '2_24_to_72h' WHEN speed_to_first_contact_hours <= 168 "
  "THEN '3_72_to_168h' WHEN speed_to_first_contact_hours > 168 THEN '4_gt_168h' END AS speed_bucket "
  "FROM int_leads_enriched")
q("bucket_recency",
  "SELECT lead_id, CASE WHEN speed_to_first_contact_hours <= 168 THEN '1_contacted_le_1_week' "
  "WHEN speed_to_first_contact_hours <= 720 THEN '2_contacted_1w_to_1mo' WHEN speed_to_first_contact_hours <= 8760 "
  "THEN '3_contacted_1mo_to_1yr' WHEN speed_to_first_contact_hours > 8760 THEN '4_stale_gt_1yr' END AS recency_bucket "
  "FROM int_leads_enriched")
_ = blank
