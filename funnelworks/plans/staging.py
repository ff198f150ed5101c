"""Staging models: type, clean and key the raw exports (one row per source
record; opportunities deduplicated).  Pure column expressions — narrow
transformations that fuse into the scan's codegen stage — except the exact
dedup of opportunities, which is one partially aggregated shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelworks.functions import (
    blank_to_null,
    clean_category_list,
    clean_timestamp,
    equals_flag,
    fix_millennium_date,
    in_list_flag,
    month_label_to_date,
    normalize_value,
    not_in_list_flag,
    null_safe_sum,
    parse_european_numeric,
    surrogate_key,
)
from funnelworks.operators.contracts import enforce_contract
from funnelworks.operators.reshape import dedup_exact
from funnelworks.plans import contracts_catalog as C

# Status spellings.
DIRTY_STATUS = {"Incorrect_Contact_Data": "Incorrect Contact Data"}
CONVERTED_STATUS = "Converted"
DISQUALIFIED_STATUSES = (
    "Disqualified",
    "Not Interested",
    "Incorrect Contact Data",
    "Incorrect_Contact_Data",
    "No Longer With Company",
)
# Terminal opportunity stages.
WON_STAGE = "Closed Won"
LOST_STAGE = "Closed Lost"
#: Precision of spend: a month's total grows with the data.
SPEND_DIGITS = 20


def stg_expenses_advertising(raw: DataFrame) -> DataFrame:
    month = month_label_to_date("month")
    df = raw.select(
        surrogate_key(month).alias("expense_advertising_sk"),
        month.alias("month_date"),
        parse_european_numeric("advertising", SPEND_DIGITS).alias("advertising_spend_usd"),
    )
    return enforce_contract(df, C.STG_EXPENSES_ADVERTISING)


def stg_expenses_salary(raw: DataFrame) -> DataFrame:
    """Wide month × (outbound, inbound) → long month × channel, one pass
    (Expand) instead of a double scan."""
    typed = raw.select(
        month_label_to_date("month").alias("month_date"),
        parse_european_numeric("outbound_sales_team", SPEND_DIGITS).alias("outbound"),
        parse_european_numeric("inbound_sales_team", SPEND_DIGITS).alias("inbound"),
    )
    long = typed.unpivot(["month_date"], ["outbound", "inbound"], "sales_channel", "salary_and_commissions_usd")
    df = long.select(
        surrogate_key("month_date", "sales_channel").alias("expense_salary_sk"),
        "month_date",
        "sales_channel",
        "salary_and_commissions_usd",
    )
    return enforce_contract(df, C.STG_EXPENSES_SALARY)


def stg_leads(raw: DataFrame) -> DataFrame:
    calls = F.col("sales_call_count").cast("int")
    texts = F.col("sales_text_count").cast("int")
    emails = F.col("sales_email_count").cast("int")
    df = raw.select(
        surrogate_key("lead_id").alias("lead_sk"),
        F.col("lead_id"),
        blank_to_null("converted_opportunity_id").alias("converted_opportunity_id"),
        normalize_value("status", DIRTY_STATUS).alias("status"),
        equals_flag("status", CONVERTED_STATUS).alias("is_converted"),
        in_list_flag("status", DISQUALIFIED_STATUSES).alias("is_disqualified"),
        calls.alias("sales_call_count"),
        texts.alias("sales_text_count"),
        emails.alias("sales_email_count"),
        null_safe_sum(calls, texts, emails).alias("total_activity_count"),
        F.col("connected_with_decision_maker").cast("boolean").alias("connected_with_decision_maker"),
        F.col("location_count").cast("int").alias("location_count"),
        parse_european_numeric("predicted_sales").alias("predicted_monthly_gmv_usd"),
        clean_category_list("marketplaces_used").alias("marketplaces_used_cleaned"),
        clean_category_list("online_ordering_used").alias("olo_tools_cleaned"),
        clean_category_list("cuisine_types").alias("cuisine_types_cleaned"),
        fix_millennium_date("form_submission_date").alias("form_submission_date"),
        clean_timestamp("first_sales_call_date").alias("first_sales_call_at"),
        clean_timestamp("first_text_sent_date").alias("first_text_sent_at"),
        clean_timestamp("first_meeting_booked_date").alias("first_meeting_booked_at"),
        clean_timestamp("last_sales_call_date").alias("last_sales_call_at"),
        clean_timestamp("last_sales_activity_date").alias("last_sales_activity_at"),
        clean_timestamp("last_sales_email_date").alias("last_sales_email_at"),
    )
    return enforce_contract(df, C.STG_LEADS)


def stg_opportunities(raw: DataFrame) -> DataFrame:
    stage = F.col("stage_name")
    df = dedup_exact(raw).select(
        surrogate_key("opportunity_id").alias("opportunity_sk"),
        "opportunity_id",
        "account_id",
        stage.alias("stage_name"),
        equals_flag(stage, WON_STAGE).alias("is_won"),
        equals_flag(stage, LOST_STAGE).alias("is_lost"),
        not_in_list_flag(stage, (WON_STAGE, LOST_STAGE)).alias("is_open"),
        blank_to_null("how_did_you_hear_about_us_c").alias("attribution_source"),
        blank_to_null("lost_reason_c").alias("lost_reason"),
        blank_to_null("closed_lost_notes_c").alias("closed_lost_notes"),
        blank_to_null("business_issue_c").alias("business_issue"),
        F.col("demo_held").cast("boolean").alias("demo_held"),
        F.col("created_date").cast("timestamp_ntz").alias("created_at"),
        F.col("demo_time").cast("timestamp_ntz").alias("demo_scheduled_at"),
        F.col("last_sales_call_date_time").cast("timestamp_ntz").alias("last_sales_call_at"),
        fix_millennium_date("demo_set_date").alias("demo_set_date"),
        fix_millennium_date("close_date").alias("close_date"),
    )
    return enforce_contract(df, C.STG_OPPORTUNITIES)
