"""Raw (all-text) schemas of the four GTM sources.

Raw exports are read with these explicit schemas, never with inference: every
column is text, whatever it looks like, and the staging models type it.
"""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType


def _text(*names: str) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


RAW_LEADS = _text(
    "lead_id",
    "form_submission_date",
    "sales_call_count",
    "sales_text_count",
    "sales_email_count",
    "first_sales_call_date",
    "first_text_sent_date",
    "first_meeting_booked_date",
    "last_sales_call_date",
    "last_sales_activity_date",
    "last_sales_email_date",
    "predicted_sales",
    "marketplaces_used",
    "online_ordering_used",
    "cuisine_types",
    "location_count",
    "connected_with_decision_maker",
    "status",
    "converted_opportunity_id",
)

RAW_OPPORTUNITIES = _text(
    "opportunity_id",
    "stage_name",
    "lost_reason_c",
    "closed_lost_notes_c",
    "business_issue_c",
    "how_did_you_hear_about_us_c",
    "account_id",
    "created_date",
    "demo_time",
    "last_sales_call_date_time",
    "demo_held",
    "demo_set_date",
    "close_date",
)

RAW_ADVERTISING = _text("month", "advertising")
RAW_SALARY = _text("month", "outbound_sales_team", "inbound_sales_team")
