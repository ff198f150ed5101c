"""Dead-letter audits of the raw lead and opportunity exports.

Findings never block the pipeline; they are rows that point at the source
record, the broken rule and the raw values needed to triage it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from funnelworks.functions import clean_timestamp, fix_millennium_date, hours_between, is_blank, month_trunc, surrogate_key
from funnelworks.operators.audit import AuditRule, audit, findings_array
from funnelworks.operators.contracts import enforce_contract
from funnelworks.plans import contracts_catalog as C

# Audit categories and their detail texts.
MILLENNIUM_DATE_DEFECT = "millennium_date_defect"
DIRTY_STATUS_VALUE = "dirty_status_value"
NEGATIVE_SPEED = "negative_speed_to_contact"
STALE_LEAD = "stale_lead"
CONVERTED_MISSING_OPP = "converted_missing_opp"
DUPLICATE_ROW = "duplicate_row"
MISSING_LOST_REASON = "missing_lost_reason"
MISSING_ATTRIBUTION = "missing_attribution"
LEAD_DETAILS = {
    MILLENNIUM_DATE_DEFECT: "form_submission_date contains 0024-xx-xx prefix",
    DIRTY_STATUS_VALUE: "status contains underscore variant: Incorrect_Contact_Data",
    NEGATIVE_SPEED: "first_sales_call_date precedes form_submission_date",
    STALE_LEAD: "form_submission_date in 2020, first contact not until 2024",
    CONVERTED_MISSING_OPP: "lead status is Converted but converted_opportunity_id is null",
}
OPP_DETAILS = {
    DUPLICATE_ROW: "opportunity_id appears more than once in source export",
    MILLENNIUM_DATE_DEFECT: "close_date or demo_set_date contains 0024-xx-xx prefix",
    MISSING_LOST_REASON: "closed lost opportunity with null lost_reason_c",
    MISSING_ATTRIBUTION: "how_did_you_hear_about_us_c is null",
}
DEFECT_PREFIX = "0024-"
DIRTY_STATUS = "Incorrect_Contact_Data"
STALE_FORM_BEFORE = "2021-01-01"
STALE_CALL_FROM = "2024-01-01 00:00:00"


def _or_null(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("null"))


def lead_rules() -> list[AuditRule]:
    form_raw = F.col("form_submission_date")
    form = fix_millennium_date(form_raw)
    call = clean_timestamp("first_sales_call_date")
    status = F.col("status")
    speed = hours_between(form.cast("timestamp_ntz"), call)
    return [
        AuditRule(
            MILLENNIUM_DATE_DEFECT,
            LEAD_DETAILS[MILLENNIUM_DATE_DEFECT],
            form_raw.isNotNull() & form_raw.startswith(DEFECT_PREFIX),
            F.concat(F.lit("raw value: "), _or_null(form_raw)),
        ),
        AuditRule(
            DIRTY_STATUS_VALUE,
            LEAD_DETAILS[DIRTY_STATUS_VALUE],
            status == DIRTY_STATUS,
            F.concat(F.lit("raw value: "), status),
        ),
        AuditRule(
            NEGATIVE_SPEED,
            LEAD_DETAILS[NEGATIVE_SPEED],
            call.isNotNull() & form.isNotNull() & (call < form.cast("timestamp_ntz")),
            F.concat(F.lit("speed_hours: "), F.round(speed, 1).cast("string")),
        ),
        AuditRule(
            STALE_LEAD,
            LEAD_DETAILS[STALE_LEAD],
            (form < F.lit(STALE_FORM_BEFORE).cast("date"))
            & (call >= F.lit(STALE_CALL_FROM).cast("timestamp_ntz")),
            F.concat(
                F.lit("submission: "), form.cast("string"), F.lit(" | first_call: "), _or_null(call)
            ),
        ),
        AuditRule(
            CONVERTED_MISSING_OPP,
            LEAD_DETAILS[CONVERTED_MISSING_OPP],
            (status == "Converted") & is_blank("converted_opportunity_id"),
            F.concat(F.lit("status: "), _or_null(status)),
        ),
    ]


def audit_leads(raw_leads: DataFrame) -> DataFrame:
    return enforce_contract(audit(raw_leads, "lead_id", lead_rules(), "leads"), C.AUDIT)


def _category_names(rules) -> Column:
    """Array of the categories whose rule holds for the row."""
    return F.array_compact(F.array(*[F.when(r.predicate, F.lit(r.category)) for r in rules]))


def dated_rows(df: DataFrame, month: Column, key: Column, categories: Column) -> DataFrame:
    """One pass over a source: each anchored row emits one (month, category,
    record) row per finding plus one volume marker (category null), so the
    monthly volume and the findings are aggregated together."""
    return (
        df.select(month.alias("month_date"), key.cast("string").alias("record_key"), categories.alias("cats"))
        .filter(F.col("month_date").isNotNull())
        .select(
            "month_date",
            "record_key",
            F.explode(F.concat("cats", F.array(F.lit(None).cast("string")))).alias("audit_category"),
        )
    )


def lead_rows_dated(raw_leads: DataFrame) -> DataFrame:
    month = month_trunc(fix_millennium_date("form_submission_date"))
    return dated_rows(raw_leads, month, F.col("lead_id"), _category_names(lead_rules()))


def opp_rules() -> list[AuditRule]:
    close, demo_set = F.col("close_date"), F.col("demo_set_date")
    stage = F.col("stage_name")
    return [
        AuditRule(
            MILLENNIUM_DATE_DEFECT,
            OPP_DETAILS[MILLENNIUM_DATE_DEFECT],
            (close.isNotNull() & close.startswith(DEFECT_PREFIX))
            | (demo_set.isNotNull() & demo_set.startswith(DEFECT_PREFIX)),
            F.concat(F.lit("close_date: "), _or_null(close), F.lit(" | demo_set_date: "), _or_null(demo_set)),
        ),
        AuditRule(
            MISSING_LOST_REASON,
            OPP_DETAILS[MISSING_LOST_REASON],
            (stage == "Closed Lost") & is_blank("lost_reason_c"),
            F.concat(
                F.lit("stage_name: "), _or_null(stage), F.lit(" | business_issue: "), _or_null(F.col("business_issue_c"))
            ),
        ),
        AuditRule(
            MISSING_ATTRIBUTION,
            OPP_DETAILS[MISSING_ATTRIBUTION],
            is_blank("how_did_you_hear_about_us_c"),
            F.concat(F.lit("stage_name: "), _or_null(stage)),
        ),
    ]


def counted_rows(df: DataFrame) -> DataFrame:
    """Distinct rows with the number of their copies, from one hash aggregate
    over all columns (copies collapse before the shuffle)."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies"))


def audit_opportunities(raw_opps: DataFrame) -> DataFrame:
    """Findings of the opportunities, from one scan: each distinct row emits
    its findings and one marker with its number of copies; the markers of an id
    add up to the number of its raw rows, and those of one row go.  Both
    aggregates combine before their shuffle, so a hot id is one small group."""
    # Findings that are equal in all columns (of unequal rows under one id) are counted and repeated.
    marker = F.struct(
        F.lit(DUPLICATE_ROW).alias("audit_category"),
        F.lit(OPP_DETAILS[DUPLICATE_ROW]).alias("audit_detail"),
        F.lit(None).cast("string").alias("diagnostic_info"),
    )
    found = (
        counted_rows(raw_opps)
        .select(
            F.col("opportunity_id").alias("record_key"),
            "copies",
            F.explode(F.concat(findings_array(opp_rules()), F.array(marker))).alias("f"),
        )
        .groupBy("record_key", "f.audit_category", "f.audit_detail", "f.diagnostic_info")
        .agg(F.sum("copies").alias("raw_rows"), F.count(F.lit(1)).alias("n"))
    )
    is_marker = F.col("audit_category") == DUPLICATE_ROW
    kept = found.filter(~is_marker | (F.col("raw_rows") > 1)).select(
        surrogate_key("record_key", "audit_category").alias("audit_sk"),
        F.lit("opportunities").alias("source_table"),
        "record_key",
        "audit_category",
        "audit_detail",
        F.when(is_marker, F.concat(F.col("raw_rows").cast("string"), F.lit(" total rows for this opportunity_id")))
        .otherwise(F.col("diagnostic_info"))
        .alias("diagnostic_info"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.when(is_marker, F.lit(1).cast("bigint")).otherwise(F.col("n")))).alias("_copy"),
    )
    return enforce_contract(kept.drop("_copy"), C.AUDIT)


def opp_rows_dated(raw_opps: DataFrame) -> DataFrame:
    """One row per (creation month, opportunity): its distinct rows
    (``in_scope``) and, for each category, how many of them have the finding
    (duplicate_row: all, if the id has more than one raw row in any month).
    One scan; the window over an id holds at most a row a month, however many
    rows the id has."""
    month = month_trunc(F.col("created_date").cast("timestamp_ntz"))
    per_month = (
        counted_rows(raw_opps)
        .groupBy(month.alias("month_date"), F.col("opportunity_id").alias("record_key"))
        .agg(
            F.count(F.lit(1)).alias("in_scope"),
            F.sum("copies").alias("raw_rows"),
            *[F.count_if(r.predicate).alias(r.category) for r in opp_rules()],
        )
    )
    repeated = F.sum("raw_rows").over(Window.partitionBy("record_key")) > 1
    return (
        per_month.withColumn(
            DUPLICATE_ROW, F.when(repeated & F.col("record_key").isNotNull(), F.col("in_scope")).otherwise(F.lit(0))
        )
        .filter(F.col("month_date").isNotNull())
        .select("month_date", "record_key", "in_scope", *OPP_DETAILS)
    )
