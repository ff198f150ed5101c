"""Raw go-to-market sources derived from the driver's TPC-H-style tables.

The CRM and finance exports the models were written for are not part of the
data we are given, so the raw layer is a deterministic projection of the
driver tables, with every column kept as text exactly as a CRM export would
deliver it (defects included).  Let k = o_orderkey:

* ``leads`` — one per order (orders left-joined to per-order lineitem counts),
* ``opportunities`` — orders with k % 9 = 0, plus an exact second copy when
  k % 450 = 0,
* ``expenses_advertising`` / ``expenses_salary_and_commissions`` — six monthly
  rows from lineitem quantities by month(l_shipdate) % 6.

Only integer arithmetic and text operations are used, so the projection is
reproducible in any SQL engine; the independent oracle writes the same rules
in DuckDB SQL.  The work grows with the input: the lead projection is one
aggregation of lineitem by order key and one equi-join with orders.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelworks.sources.driver_tables import read_table
from funnelworks.sources.schemas import (
    RAW_ADVERTISING,
    RAW_OPPORTUNITIES,
    RAW_SALARY,
)

# Lead statuses cycled by k % 17 for non-converted leads
# (the dirty underscore spelling and a missing status included).
STATUS_CYCLE = [
    "New",
    "Working",
    "Demo Set",
    "Sales Nurture",
    "Marketing Nurture",
    "Disqualified",
    "Not Interested",
    "Incorrect Contact Data",
    "Incorrect_Contact_Data",
    "No Longer With Company",
    "No Show",
    "Postpone",
    "Restaurant Confirmed",
    "Nurturing",
    None,
]
# Opportunity stages cycled by j % 7.
STAGE_CYCLE = ["Interest", "Demo Set", "In Progress", "Verbal Commitment", "On Hold", "Closed Won", "Closed Lost"]
# List-typed text columns chosen by order priority.
MARKETPLACES_BY_PRIORITY = {
    "1-URGENT": "['Uber Eats', 'DoorDash', 'Grubhub']",
    "2-HIGH": "['DoorDash']",
    "3-MEDIUM": "[]",
    "4-NOT SPECIFIED": "['']",
}
OLO_BY_PRIORITY = {
    "1-URGENT": "['Toast']",
    "2-HIGH": "[]",
    "3-MEDIUM": " ['Square', 'Olo'] ",
    "5-LOW": "['']",
}
CUISINES_BY_K4 = ["['Pizza', 'Italian']", "['Mexican']", "[]", None]
MONTH_LABELS = ["Jan-24", "Feb-24", "Mar-24", "Apr-24", "May-24", "Jun-24"]
NBSP = "\u00a0"
CURRENCY_PREFIX = "US$\t"


@dataclass(frozen=True)
class RawSources:
    leads: DataFrame
    opportunities: DataFrame
    expenses_advertising: DataFrame
    expenses_salary: DataFrame


def _pick(index: Column, values: list) -> Column:
    """values[index] for a small fixed list (a CASE chain, codegen-friendly)."""
    out = None
    for i, v in enumerate(values):
        lit = F.lit(v).cast("string")
        out = F.when(index == i, lit) if out is None else out.when(index == i, lit)
    return out


def _by_key(col: Column, mapping: dict) -> Column:
    out = None
    for key, v in mapping.items():
        out = F.when(col == key, F.lit(v)) if out is None else out.when(col == key, F.lit(v))
    return out


def euro_text(cents: Column) -> Column:
    """Render whole cents as "12 345,67" (NBSP between thousands)."""
    whole = ((cents - cents % 100).cast("decimal(20,0)") / 100).cast("bigint")
    grouped = F.translate(F.format_number(whole, 0), ",", NBSP)
    return F.concat(grouped, F.lit(","), F.lpad((cents % 100).cast("string"), 2, "0"))


def _fmt_ts(ts: Column) -> Column:
    """'yyyy-MM-dd HH:mm:ss' (whole seconds only, so the plain cast of a
    timestamp without zone gives exactly this text, without a formatter)."""
    return ts.cast("string")


def _plus_hours(ts: Column, hours: Column) -> Column:
    return F.timestamp_add("HOUR", hours, ts)


def _defect(date_text: Column) -> Column:
    """'2024-03-05' → '0024-03-05' (two-digit-century export defect)."""
    return F.concat(F.lit("00"), F.substring(date_text, 3, 100))


def _lineitem_activity(lineitem: DataFrame) -> DataFrame:
    """Per-order activity counts: calls = 'A' lines, texts = 'N', emails = 'R'.
    Partial aggregation happens map-side, so only one row per order and
    partition is shuffled."""
    flag = F.col("l_returnflag")
    return lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count_if(flag == "A").alias("n_a"),
        F.count_if(flag == "N").alias("n_n"),
        F.count_if(flag == "R").alias("n_r"),
    )


def raw_leads(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    inbound = k % 5 < 2
    activity = _lineitem_activity(lineitem)
    # The lead projection keeps every order: a left join to per-order counts
    # (orders without lines get null counts).  The per-order aggregate grows
    # with the data, so it is never broadcast: a sort-merge join on the order
    # key, whose aggregate side is already hash-partitioned by that key.  The
    # text projection below then runs after the shuffle, spread over all
    # shuffle partitions instead of in the scan tasks.
    joined = orders.select("o_orderkey", "o_totalprice", "o_orderpriority").join(
        activity.hint("merge"), "o_orderkey", "left"
    )
    # Level 1: per-order anchors used by several output columns.  Kept as a
    # separate projection so each is computed once per row (Catalyst does not
    # collapse a projection when that would duplicate a non-trivial expression).
    base_day = F.date_add(F.lit("2024-01-01").cast("date"), ((k * 37) % 182).cast("int"))
    stale = inbound & (k % 95 == 0)
    entry_ts = F.when(stale, F.lit("2024-02-01").cast("date")).otherwise(base_day).cast("timestamp_ntz")
    first_call = F.when(k % 101 == 0, _plus_hours(entry_ts, -(1 + k % 30))).otherwise(_plus_hours(entry_ts, k % 400))
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    anchors = joined.select(
        "o_orderkey",
        "o_orderpriority",
        "n_a",
        "n_n",
        "n_r",
        base_day.cast("string").alias("day_text"),
        first_call.alias("first_call"),
        euro_text(cents).alias("amount_text"),
    )
    # Level 2: the export's text columns.
    day_text, call, amount = F.col("day_text"), F.col("first_call"), F.col("amount_text")
    stale_form = F.date_add(F.lit("2020-01-01").cast("date"), (k % 365).cast("int")).cast("string")
    form = (
        F.when(~inbound, F.when(k % 2 == 1, F.lit("")))
        .when(k % 95 == 0, stale_form)
        .when(k % 97 == 0, F.lit("0001-01-01"))
        .when(k % 3 == 0, day_text)
        .otherwise(_defect(day_text))
    )
    predicted = (
        F.when(k % 25 == 0, F.lit(None).cast("string"))
        .when(k % 12 == 0, F.lit(" "))
        .when(k % 4 == 1, F.concat(F.lit(CURRENCY_PREFIX), amount))
        .otherwise(amount)
    )

    def count_text(c: str) -> Column:
        return F.when(F.col(c) > 0, F.col(c).cast("string"))

    status = F.when(k % 9 == 0, F.lit("Converted")).otherwise(_pick(k % 17, STATUS_CYCLE))
    opp_id = F.concat(F.lit("O"), k.cast("string"))
    converted_opp = F.when(
        k % 9 == 0,
        F.when(k % 909 == 0, F.lit(""))
        .when(k % 27 == 0, F.concat(F.lit(" "), opp_id, F.lit(" ")))
        .otherwise(opp_id),
    )
    prio = F.col("o_orderpriority")
    return anchors.select(
        F.concat(F.lit("L"), k.cast("string")).alias("lead_id"),
        form.alias("form_submission_date"),
        count_text("n_a").alias("sales_call_count"),
        count_text("n_n").alias("sales_text_count"),
        count_text("n_r").alias("sales_email_count"),
        F.when(k % 11 == 0, F.when(k % 2 == 1, F.lit("  "))).otherwise(_fmt_ts(call)).alias("first_sales_call_date"),
        F.when(k % 4 != 0, _fmt_ts(_plus_hours(call, k % 48))).alias("first_text_sent_date"),
        F.when(k % 6 == 0, _fmt_ts(_plus_hours(call, F.lit(48)))).otherwise(F.lit("")).alias(
            "first_meeting_booked_date"
        ),
        F.when(k % 13 == 0, F.lit("")).otherwise(_fmt_ts(_plus_hours(call, (k % 30) * 24))).alias(
            "last_sales_call_date"
        ),
        F.when((k % 7 == 0) | (k % 11 == 0), F.lit(None).cast("string"))
        .otherwise(_fmt_ts(_plus_hours(call, (k % 60) * 24)))
        .alias("last_sales_activity_date"),
        F.when(k % 8 != 0, _fmt_ts(_plus_hours(call, (k % 60) * 24 - k % 5))).alias("last_sales_email_date"),
        predicted.alias("predicted_sales"),
        _by_key(prio, MARKETPLACES_BY_PRIORITY).alias("marketplaces_used"),
        _by_key(prio, OLO_BY_PRIORITY).alias("online_ordering_used"),
        _pick(k % 4, CUISINES_BY_K4).alias("cuisine_types"),
        F.when(k % 10 != 3, (1 + k % 5).cast("string")).alias("location_count"),
        F.when(k % 29 == 0, F.lit(None).cast("string"))
        .when(k % 3 == 0, F.lit("true"))
        .otherwise(F.lit("false"))
        .alias("connected_with_decision_maker"),
        status.alias("status"),
        converted_opp.alias("converted_opportunity_id"),
    )


def raw_opportunities(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    j = F.expr("o_orderkey div 9")  # integer division, exact for any key size
    stage = F.when(j % 53 == 7, F.lit(None).cast("string")).otherwise(_pick(j % 7, STAGE_CYCLE))
    created = _plus_hours(
        F.date_add(F.lit("2024-01-01").cast("date"), (k % 182).cast("int")).cast("timestamp_ntz"), k % 24
    )
    created_day = created.cast("date")
    set_text = F.date_add(created_day, 2).cast("string")
    close_text = F.date_add(created_day, 30).cast("string")
    lost = stage == "Closed Lost"
    closed = stage.isin("Closed Won", "Closed Lost")
    opp = orders.filter(k % 9 == 0).select(
        F.concat(F.lit("O"), k.cast("string")).alias("opportunity_id"),
        stage.alias("stage_name"),
        F.when(lost, _pick(j % 3, ["Price", "Timing", " "])).alias("lost_reason_c"),
        F.when(lost, F.concat(F.lit("notes "), j.cast("string"))).otherwise(F.lit("")).alias("closed_lost_notes_c"),
        _pick(j % 4, ["Marketing", "Operations ", "  ", None]).alias("business_issue_c"),
        F.when(j % 4 == 0, F.lit("Google"))
        .when(j % 8 == 1, F.lit(" Referral "))
        .when(j % 8 == 5, F.lit(""))
        .alias("how_did_you_hear_about_us_c"),
        F.concat(F.lit("A"), F.col("o_custkey").cast("string")).alias("account_id"),
        _fmt_ts(created).alias("created_date"),
        F.when(j % 3 > 0, _fmt_ts(_plus_hours(created, F.lit(72)))).alias("demo_time"),
        _fmt_ts(_plus_hours(created, (j % 20) * 24)).alias("last_sales_call_date_time"),
        F.when(j % 3 > 0, F.lit("true")).otherwise(F.lit("false")).alias("demo_held"),
        F.when(j % 4 == 0, F.lit(None).cast("string"))
        .when(j % 2 == 0, _defect(set_text))
        .otherwise(set_text)
        .alias("demo_set_date"),
        F.when(~F.coalesce(closed, F.lit(False)), F.lit(""))
        .when(j % 3 == 0, _defect(close_text))
        .when(j % 10 == 4, F.lit("0001-01-01"))
        .otherwise(close_text)
        .alias("close_date"),
        (k % 450 == 0).alias("_dup"),
    )
    # Exact second copy of every k % 450 = 0 opportunity (export artifact).
    copies = F.when(F.col("_dup"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return opp.withColumn("_copy", F.explode(copies)).select(*RAW_OPPORTUNITIES.fieldNames())


def _monthly_lineitem(lineitem: DataFrame) -> DataFrame:
    """Six monthly rows: quantities per return flag by month(l_shipdate) % 6."""
    idx = F.month("l_shipdate") % 6
    q = F.col("l_quantity").cast("bigint")
    flag = F.col("l_returnflag")
    return lineitem.groupBy(idx.alias("m")).agg(
        F.coalesce(F.sum(F.when(flag == "N", q)), F.lit(0)).alias("q_n"),
        F.coalesce(F.sum(F.when(flag == "R", q)), F.lit(0)).alias("q_r"),
        F.coalesce(F.sum(F.when(flag == "A", q)), F.lit(0)).alias("q_a"),
    )


def _amount_text(cents: Column) -> Column:
    return F.concat(F.lit(CURRENCY_PREFIX), euro_text(cents))


def raw_expenses(lineitem: DataFrame) -> tuple[DataFrame, DataFrame]:
    monthly = _monthly_lineitem(lineitem)
    label = _pick(F.col("m"), MONTH_LABELS)
    ads = monthly.select(label.alias("month"), _amount_text(F.col("q_n") * 100).alias("advertising"))
    salary = monthly.select(
        label.alias("month"),
        _amount_text(F.col("q_r") * 75).alias("outbound_sales_team"),
        _amount_text(F.col("q_a") * 75).alias("inbound_sales_team"),
    )
    return ads.select(*RAW_ADVERTISING.fieldNames()), salary.select(*RAW_SALARY.fieldNames())


def load_raw_sources(spark: SparkSession, sf_dir: str, orders_before: str | None = None) -> RawSources:
    """Raw exports from the driver tables; ``orders_before`` restricts the
    CRM side to orders placed before a date (an earlier snapshot of the CRM,
    used to exercise incremental refresh).  The filter reaches the Parquet
    scan as a pushed filter."""
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderdate"])
    if orders_before is not None:
        orders = orders.filter(F.col("o_orderdate") < F.lit(orders_before).cast("timestamp_ntz"))
    lineitem = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_quantity", "l_returnflag", "l_shipdate"])
    ads, salary = raw_expenses(lineitem)
    return RawSources(
        leads=raw_leads(orders, lineitem),
        opportunities=raw_opportunities(orders),
        expenses_advertising=ads,
        expenses_salary=salary,
    )
