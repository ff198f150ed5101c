"""Hand-built rows for the cohort, CAC and engagement rules (FIXTURES §4)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from funnelworks.plans.audits import lead_rows_dated
from funnelworks.plans.contracts_catalog import INT_EXPENSES_CHANNEL_MONTH, INT_LEADS_ENRICHED
from funnelworks.plans.intermediate import cohort_stats, int_audit_by_month
from funnelworks.plans.marts import mart_cac_ltv, mart_gtm_funnel
from funnelworks.sources.schemas import RAW_LEADS, RAW_OPPORTUNITIES

D, T = dt.date, dt.datetime


def enriched_rows(spark, rows):
    names = INT_LEADS_ENRICHED.fieldNames()
    full = []
    for r in rows:
        base = {n: None for n in names}
        base.update(r)
        full.append(tuple(base[n] for n in names))
    return spark.createDataFrame(full, INT_LEADS_ENRICHED)


def test_cohort_cac_and_engagement_rules(spark):
    e = enriched_rows(
        spark,
        [
            # inbound: form in March, called in April -> March cohort; converted and won
            dict(lead_sk="a", lead_id="a", channel="inbound", form_submission_date=D(2024, 3, 30),
                 first_sales_call_at=T(2024, 4, 2), is_converted=True, is_won=True, is_lost=False,
                 total_activity_count=4, speed_to_first_contact_hours=Decimal("72.00"),
                 days_in_funnel=Decimal("10.00"), predicted_monthly_gmv_usd=Decimal("10000.00"),
                 demo_set_date=D(2024, 4, 5), demo_held=True),
            # inbound, not converted: counted in activity only
            dict(lead_sk="b", lead_id="b", channel="inbound", form_submission_date=D(2024, 3, 1),
                 first_sales_call_at=T(2024, 3, 1, 5), is_converted=False, is_won=None,
                 total_activity_count=2, speed_to_first_contact_hours=Decimal("5.00"),
                 days_in_funnel=Decimal("1.00")),
            # outbound without first call: excluded from every cohort
            dict(lead_sk="c", lead_id="c", channel="outbound", is_converted=True, is_won=True,
                 total_activity_count=9),
            # outbound in March with no win
            dict(lead_sk="d", lead_id="d", channel="outbound", first_sales_call_at=T(2024, 3, 10),
                 is_converted=False, is_won=False, total_activity_count=1),
            # inbound in May: no cost row for May -> absent from the CAC mart
            dict(lead_sk="e", lead_id="e", channel="inbound", form_submission_date=D(2024, 5, 2),
                 is_converted=False, total_activity_count=0),
        ],
    )
    stats = cohort_stats(e)
    cost = spark.createDataFrame(
        [("x", D(2024, 3, 1), "inbound", Decimal("900.00"), Decimal("100.00"), Decimal("1000.00")),
         ("y", D(2024, 3, 1), "outbound", Decimal("500.00"), Decimal("0.00"), Decimal("500.00"))],
        INT_EXPENSES_CHANNEL_MONTH,
    )
    cac = {(r.month_date, r.channel): r for r in mart_cac_ltv(stats, cost).collect()}
    assert set(cac) == {(D(2024, 3, 1), "inbound"), (D(2024, 3, 1), "outbound")}
    inbound = cac[(D(2024, 3, 1), "inbound")]
    assert inbound.new_customers_won == 1 and inbound.cac_usd == Decimal("1000.00")
    assert inbound.avg_estimated_ltv_usd == Decimal("12000.00") and inbound.cac_ltv_ratio == Decimal("12.0000")
    outbound = cac[(D(2024, 3, 1), "outbound")]
    assert outbound.new_customers_won == 0 and outbound.cac_usd is None and outbound.cac_ltv_ratio is None

    funnel = {(r.month_date, r.channel): r for r in mart_gtm_funnel(stats).collect()}
    march_in = funnel[(D(2024, 3, 1), "inbound")]
    assert march_in.leads_created == 2 and march_in.demos_set == 1 and march_in.demos_held == 1
    assert march_in.avg_speed_to_first_contact_hours == Decimal("72.00")  # converted lead only
    assert march_in.avg_days_in_funnel == Decimal("10.00")
    assert march_in.avg_activity_count == Decimal("3.00")  # all leads of the cohort
    assert (D(2024, 5, 1), "inbound") in funnel
    assert all(r.channel != "outbound" or r.month_date == D(2024, 3, 1) for r in funnel.values())


def test_audit_roll_up_drops_undated_findings(spark):
    f = RAW_LEADS.fieldNames()

    def lead(**kw):
        r = {x: None for x in f}
        r.update(kw)
        return tuple(r[x] for x in f)

    raw = spark.createDataFrame(
        [
            lead(lead_id="a", form_submission_date="0024-03-05", status="Incorrect_Contact_Data"),  # 2 findings
            lead(lead_id="b", form_submission_date="2024-03-07", status="New"),  # clean, counts in volume
            lead(lead_id="c", status="Incorrect_Contact_Data"),  # no form date: dropped
        ],
        RAW_LEADS,
    )
    empty_opps = spark.createDataFrame([], RAW_OPPORTUNITIES)
    from funnelworks.plans.audits import opp_rows_dated

    out = sorted(
        (r.audit_category, r.finding_count, r.affected_records, r.monthly_record_count, r.pct_of_monthly_total)
        for r in int_audit_by_month(lead_rows_dated(raw), opp_rows_dated(empty_opps)).collect()
    )
    assert out == [
        ("dirty_status_value", 1, 1, 2, Decimal("0.5000")),
        ("millennium_date_defect", 1, 1, 2, Decimal("0.5000")),
    ]
    _ = F
