"""Edge rows of every scalar function (FIXTURES §4)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from funnelworks import functions as fx
from funnelworks.plans.staging import stg_leads, stg_opportunities
from funnelworks.sources.schemas import RAW_LEADS, RAW_OPPORTUNITIES


def one_col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_fix_millennium_date(spark):
    out = one_col(spark, [None, "", "0001-01-01", "0024-03-05", "2020-05-01", "1999-03-05"], fx.fix_millennium_date)
    assert out == [None, None, None, dt.date(2024, 3, 5), dt.date(2020, 5, 1), dt.date(2099, 3, 5)]


def test_fix_millennium_date_junk_raises(spark):
    with pytest.raises(Exception):
        one_col(spark, ["not a date"], fx.fix_millennium_date)


def test_clean_timestamp(spark):
    out = one_col(spark, [None, "", "   ", "  2024-01-02 03:04:05 "], fx.clean_timestamp)
    assert out == [None, None, None, dt.datetime(2024, 1, 2, 3, 4, 5)]


def test_clean_category_list(spark):
    out = one_col(spark, ["['Uber Eats', 'DoorDash']", "[]", "['']", "  ", None, " ['Olo'] "], fx.clean_category_list)
    assert out == ["UberEats,DoorDash", None, None, None, None, "Olo"]


def test_parse_european_numeric(spark):
    seed = "US$\t55 779,40"
    out = one_col(spark, [seed, "1234", " ", None, "-5,00", "1.234,56"], fx.parse_european_numeric)
    assert out == [Decimal("55779.40"), Decimal("1234.00"), None, None, Decimal("5.00"), Decimal("1234.56")]


def test_parse_european_numeric_two_commas_raise(spark):
    with pytest.raises(Exception):
        one_col(spark, ["1,2,3"], fx.parse_european_numeric)


def test_month_label(spark):
    assert one_col(spark, ["Jan-24", "Jun-24"], fx.month_label_to_date) == [dt.date(2024, 1, 1), dt.date(2024, 6, 1)]


def test_hours_between(spark):
    df = spark.createDataFrame(
        [
            (None, dt.datetime(2024, 1, 1)),
            (dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 1)),
            (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2, 12)),
        ],
        "s timestamp_ntz, e timestamp_ntz",
    )
    out = [r[0] for r in df.select(fx.hours_between("s", "e")).collect()]
    assert out[0] is None and out[1] == -24 and out[2] == 36


def test_safe_divide(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (1, 4)], "n int, d int")
    out = [r[0] for r in df.select(fx.safe_divide("n", "d")).collect()]
    assert out[:2] == [None, None] and out[2] == Decimal("0.25")


def test_list_count(spark):
    assert one_col(spark, [None, "a", "a,b,c"], fx.list_count) == [0, 1, 3]


def test_ltv_estimate(spark):
    out = one_col(spark, [None, Decimal("10000.00"), Decimal("0.00")], fx.ltv_estimate, "decimal(12,2)")
    assert out == [None, Decimal("12000.00"), Decimal("6000.00")]


def test_activity_density(spark):
    df = spark.createDataFrame([(3, Decimal("0.50")), (3, None), (10, Decimal("4.00"))], "t int, d decimal(8,2)")
    out = [r[0] for r in df.select(fx.activity_density("t", "d")).collect()]
    assert out == [Decimal("3.0000"), None, Decimal("2.5000")]


def test_tier_rules(spark):
    cases = [
        # converted, disqualified, connected, activity, speed, gmv, expected
        (True, False, True, 5, None, None, "converted"),
        (False, True, True, 5, None, None, None),
        (False, False, True, 0, None, None, "hot"),
        (False, False, False, 3, Decimal("72.00"), None, "warm"),
        (False, False, False, 3, Decimal("72.01"), Decimal("6279.00"), "cold"),
        (False, False, False, 3, Decimal("72.01"), Decimal("6279.01"), "warm"),
        (False, False, False, 3, None, None, "cold"),
        (False, False, False, 3, Decimal("-5.00"), None, "warm"),
        (False, False, False, 0, Decimal("1.00"), Decimal("9999.00"), "cold"),
        (True, True, False, 0, None, None, "converted"),
    ]
    df = spark.createDataFrame(
        [c[:6] for c in cases],
        "c boolean, d boolean, h boolean, a int, s decimal(10,2), g decimal(12,2)",
    )
    out = [r[0] for r in df.select(fx.conversion_tier("c", "d", "h", "a", "s", "g")).collect()]
    assert out == [c[6] for c in cases]


def test_buckets(spark):
    vals = [Decimal(x) for x in ["24", "24.01", "72", "168", "168.01", "720", "8760", "8760.01"]]
    speed = one_col(spark, vals, fx.speed_bucket, "decimal(10,2)")
    assert speed == ["1_le_24h", "2_24_to_72h", "2_24_to_72h", "3_72_to_168h", "4_gt_168h", "4_gt_168h", "4_gt_168h",
                     "4_gt_168h"]
    rec = one_col(spark, vals, fx.recency_bucket, "decimal(10,2)")
    assert rec[3:] == ["1_contacted_le_1_week", "2_contacted_1w_to_1mo", "2_contacted_1w_to_1mo",
                       "3_contacted_1mo_to_1yr", "4_stale_gt_1yr"]


def _raw_lead(**kw):
    row = {f: None for f in RAW_LEADS.fieldNames()}
    row.update(kw)
    return tuple(row[f] for f in RAW_LEADS.fieldNames())


def test_status_flags(spark):
    raw = spark.createDataFrame(
        [
            _raw_lead(lead_id="a", status="Incorrect_Contact_Data"),
            _raw_lead(lead_id="b", status="Incorrect Contact Data"),
            _raw_lead(lead_id="c", status=None),
            _raw_lead(lead_id="d", status="Converted"),
        ],
        RAW_LEADS,
    )
    got = {r.lead_id: (r.status, r.is_converted, r.is_disqualified) for r in stg_leads(raw).collect()}
    assert got["a"] == ("Incorrect Contact Data", False, True)
    assert got["b"] == ("Incorrect Contact Data", False, True)
    assert got["c"] == (None, False, False)
    assert got["d"] == ("Converted", True, False)


def test_stage_flags_and_dedup(spark):
    fields = RAW_OPPORTUNITIES.fieldNames()

    def opp(**kw):
        r = {f: None for f in fields}
        r.update(kw)
        return tuple(r[f] for f in fields)

    raw = spark.createDataFrame(
        [opp(opportunity_id="x", stage_name=None), opp(opportunity_id="y", stage_name="Closed Won"),
         opp(opportunity_id="y", stage_name="Closed Won")],
        RAW_OPPORTUNITIES,
    )
    got = {r.opportunity_id: (r.is_won, r.is_lost, r.is_open) for r in stg_opportunities(raw).collect()}
    assert got == {"x": (False, False, False), "y": (True, False, False)}


def test_date_spine(spark):
    from funnelworks.operators.reshape import date_spine

    days = date_spine(spark, "2020-01-01", "2030-01-01")
    agg = days.agg({"date_day": "min"}).collect()[0][0], days.agg({"date_day": "max"}).collect()[0][0], days.count()
    assert agg == (dt.date(2020, 1, 1), dt.date(2029, 12, 31), 3653)
