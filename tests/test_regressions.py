"""Regression tests for the documented decisions and a
property test of the exact rounding helper."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from funnelworks.functions import exact_ratio, safe_divide
from funnelworks.plans.marts import mart_data_quality_monitor

D = dt.date


def _cac(spark, rows):
    return spark.createDataFrame(
        rows,
        "cac_ltv_sk string, month_date date, channel string, total_cost_usd decimal(20,2), new_customers_won bigint, "
        "cac_usd decimal(12,2), avg_predicted_monthly_gmv_usd decimal(12,2), avg_estimated_ltv_usd decimal(12,2), "
        "cac_ltv_ratio decimal(14,4)",
    )


def _audit(spark, rows):
    return spark.createDataFrame(
        rows,
        "audit_month_sk string, month_date date, source_table string, audit_category string, finding_count int, "
        "affected_records int, monthly_record_count int, pct_of_monthly_total decimal(6,4)",
    )


def test_monitor_counts_scope_per_category_and_drops_zero_win_cost(spark):
    m1, m2 = D(2024, 1, 1), D(2024, 2, 1)
    cac = _cac(
        spark,
        [
            ("a", m1, "inbound", Decimal("1000.00"), 4, Decimal("250.00"), None, Decimal("7000.00"), None),
            ("b", m1, "outbound", Decimal("900.00"), 0, None, None, None, None),  # zero wins: null CAC
            ("c", m2, "inbound", Decimal("500.00"), 1, Decimal("500.00"), None, Decimal("6000.00"), None),
        ],
    )
    audit = _audit(
        spark,
        [
            ("x", m1, "leads", "stale_lead", 3, 3, 100, None),
            ("y", m1, "leads", "millennium_date_defect", 5, 5, 100, None),  # same 100 leads counted again (X4)
            ("z", m1, "opportunities", "missing_attribution", 2, 2, 10, None),
        ],
    )
    out = {r.month_date: r for r in mart_data_quality_monitor(cac, audit).collect()}
    jan, feb = out[m1], out[m2]
    assert jan.total_records_in_scope == 210  # X4: per-category volumes summed
    assert jan.total_audit_affected_records == 10  # X5: per-category distincts summed
    assert jan.blended_cac_usd == Decimal("250.00")  # X12: 900 of the zero-win channel drops out
    assert jan.total_cost_usd == Decimal("1900.00")
    assert jan.estimated_monthly_ltv_usd == Decimal("28000.00")
    assert jan.mom_revenue_change_usd is None and feb.mom_revenue_change_usd == Decimal("-22000.00")
    assert feb.total_audit_findings == 0 and feb.overall_audit_density is None
    assert feb.mom_audit_findings_change == -10
    assert jan.overall_audit_density == Decimal("0.0476")


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**9, 10**9), st.integers(1, 10**6)), min_size=1, max_size=20))
def test_exact_ratio_rounds_half_up_like_decimal(spark, pairs):
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [r[0] for r in df.select(exact_ratio("n", "d").cast("decimal(20,4)")).collect()]
    want = [(Decimal(n) / Decimal(d)).quantize(Decimal("0.0001"), rounding=ROUND_HALF_UP) for n, d in pairs]
    assert got == want


def test_safe_divide_takes_ordinary_operands(spark):
    def one(num, den):
        return spark.range(1).select(safe_divide(F.expr(num), F.expr(den))).first()[0]

    third = one("double(1) / 3", "2")
    assert abs(third - Decimal(1) / 6) < Decimal("1e-13")
    assert abs(one("1", "cast(0.000000001 as decimal(20,9))") - 10**9) < Decimal("1e-5")  # as doubles
    assert abs(one("5", "cast(0.000000001 as double)") - 5 * 10**9) < Decimal("1e-5")
    assert one("3", "bigint(1000000000000)") == Decimal("0.000000000003")
    assert one("20000000000000000", "3").quantize(Decimal("0.000001")) == Decimal("6666666666666666.666667")
    assert one("0.1D", "0.3D") == Decimal("0.33333333333333")
    assert one("7", "0") is None and one("null", "2") is None and one("2", "cast(null as double)") is None
