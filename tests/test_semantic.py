"""Filters over several models, qualified dimensions and the specification."""

import datetime as dt
from dataclasses import replace
from decimal import Decimal

import pytest

from funnelworks.plans.semantic import (
    METRICS,
    SEMANTIC_MODELS,
    Entity,
    Measure,
    Metric,
    MetricRegistry,
    SemanticModel,
    default_group_by,
    metric_query,
)
from funnelworks.plans.semantic_spec import SPEC, SpecTable

MONTH = dt.date(2024, 1, 1)


@pytest.fixture
def marts(spark):
    cac = [("a", MONTH, "inbound", Decimal("90.00"), 3, Decimal("30.00")), ("b", MONTH, "outbound", Decimal("50.00"), 1, Decimal("50.00"))]
    leads = [("1", "inbound", "hot", False), ("2", "inbound", "hot", True), ("3", "inbound", "warm", False), ("4", "outbound", "hot", False)]
    return {
        "mart_cac_ltv": spark.createDataFrame(
            cac, "cac_ltv_sk string, month_date date, channel string, total_cost_usd decimal(20,2), new_customers_won long, cac_usd decimal(12,2)"
        ),
        "mart_leading_indicators": spark.createDataFrame(
            [(*x, None, None, None, None) for x in leads],
            "lead_sk string, channel string, conversion_probability_tier string, is_disqualified boolean, is_converted boolean, "
            "has_olo_tool boolean, connected_with_decision_maker boolean, last_sales_activity_at timestamp_ntz",
        ),
    }


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_filters_over_models_and_together(marts):
    got = rows(metric_query(marts, ["hot_lead_count", "cac_usd"], ["channel"], "inbound_active"))
    assert got == [("inbound", 1, Decimal("30.000000"))]
    both = ["inbound_active", "conversion_probability_tier = 'warm'"]
    assert rows(metric_query(marts, ["total_lead_count"], ["channel"], both)) == [("inbound", 1)]
    with pytest.raises(ValueError, match="hot_leads: gtm_channel_month has not"):
        metric_query(marts, ["total_lead_count", "cac_usd"], ["channel"], "hot_leads")
    with pytest.raises(ValueError, match="inbound_active: gtm_channel_month has not the dimensions of: is_disqualified"):
        metric_query(marts, ["cac_usd"], ["channel"], "inbound_active")
    with pytest.raises(ValueError, match="gtm_channel_month"):
        metric_query(marts, ["cac_usd"], ["channel"], "total_cost_usd > 5")  # no dimension


def test_qualified_dimensions(marts):
    got = rows(metric_query(marts, ["total_lead_count"], ["lead__conversion_probability_tier", "lead__channel"]))
    assert got == [("hot", "inbound", 2), ("hot", "outbound", 1), ("warm", "inbound", 1)]
    assert rows(metric_query(marts, ["cac_usd"], ["channel_month__channel"])) == [
        ("inbound", Decimal("30.000000")), ("outbound", Decimal("50.000000")),
    ]
    with pytest.raises(KeyError, match="no path from lead_universe to entity channel_month"):
        metric_query(marts, ["total_lead_count"], ["channel_month__channel"])


def test_joins_over_entities(spark, marts):
    calls = SemanticModel(
        "calls", "calls", {}, ["kind"], [Measure("n_calls", "count", "call")], "", [Entity("call", "primary", "call"), Entity("lead", "foreign", "l")]
    )
    notes = SemanticModel("notes", "notes", {}, [], [Measure("n_notes", "count", "c")], "", [Entity("call", "foreign", "c")])
    reg = MetricRegistry([*SEMANTIC_MODELS, calls, notes], [*METRICS, Metric("calls", "n_calls")])
    tables = {
        **marts,
        "calls": spark.createDataFrame([("x", "1", "in"), ("y", "1", "out"), ("z", "4", "in"), ("w", None, "in")], "call string, l string, kind string"),
        "notes": spark.createDataFrame([("x",), ("x",), ("z",), ("q",)], "c string"),
    }
    got = rows(metric_query(tables, ["calls"], ["kind", "lead__channel"], registry=reg).na.fill("-"))
    assert got == [("in", "-", 1), ("in", "inbound", 1), ("in", "outbound", 1), ("out", "inbound", 1)]
    # over two joins, each to a unique key: no row of notes is lost or multiplied
    got = rows(metric_query(tables, ["n_notes"], ["lead__channel"], registry=reg).na.fill("-"))
    assert got == [("-", 1), ("inbound", 2), ("outbound", 1)]
    with pytest.raises(ValueError, match="multiplies rows: lead_universe to calls over lead"):
        metric_query(tables, ["total_lead_count"], ["call__kind"], registry=reg)


def test_specification_is_merged_and_checked(spark, marts):
    reg = MetricRegistry()
    assert rows(metric_query(marts, ["gtm_channel_month.total_cost_usd"], ["channel"])) == [("inbound", Decimal("90.00")), ("outbound", Decimal("50.00"))]
    with pytest.raises(KeyError, match="gtm_funnel, lead_universe"):
        reg.base_metrics("avg_speed_to_first_contact_hours")
    with pytest.raises(KeyError, match="unknown metric or measure"):
        reg.base_metrics("nothing")
    with pytest.raises(ValueError, match="declared twice"):
        MetricRegistry(spec=[SpecTable("mart_cac_ltv", {}, [("cac_usd", "cac_usd", "number", "sum")])])
    with pytest.raises(KeyError, match="no model"):
        MetricRegistry(spec=[SpecTable("other", {}, [])])
    own = [replace(SEMANTIC_MODELS[0], measures=[Measure("cac_usd", "average", "cac_usd")])]
    spec = [replace(SPEC[0], measures=[("cac_usd", "cac_usd", "number", "avg")])]
    MetricRegistry(own, [], spec).check(marts)
    with pytest.raises(TypeError, match="gtm_channel_month.channel: boolean declared"):
        MetricRegistry(own, [], [replace(spec[0], dimensions={"channel": "boolean"})]).check(marts)


def test_declared_metrics_have_one_measure():
    reg = MetricRegistry()
    for name in reg.metrics:
        assert [reg.model_of_measure(base.measure).name for base in reg.base_metrics(name)]
        assert default_group_by(name)


def test_speed_metric_is_that_of_the_funnel(spark, marts):
    funnel = [("inbound", MONTH, "10.00"), ("inbound", MONTH, "25.01"), ("inbound", MONTH, None), ("outbound", MONTH, None)]
    tables = {
        **marts,
        "mart_gtm_funnel": spark.createDataFrame(funnel, "channel string, month_date date, hours string").selectExpr(
            "channel", "month_date", "cast(hours as decimal(10,2)) as avg_speed_to_first_contact_hours"
        ),
        "mart_leading_indicators": marts["mart_leading_indicators"].selectExpr("*", "cast(lead_sk as decimal(10,2)) as speed_to_first_contact_hours"),
    }
    name = "avg_speed_to_first_contact"
    got = rows(metric_query(tables, [name], default_group_by(name)))
    assert got == [("inbound", MONTH, Decimal("17.505000")), ("outbound", MONTH, None)]
    # beside the measure of the same name of the leads
    got = rows(metric_query(tables, [name, "lead_universe.avg_speed_to_first_contact_hours"], ["channel"]))
    assert got == [("inbound", Decimal("17.505000"), Decimal("2.000000")), ("outbound", None, Decimal("4.000000"))]


def test_marts_meet_the_specification(spark):
    from funnelworks.catalog import mart_tables, models

    MetricRegistry().check(mart_tables(models(spark, "/root/testdata/sf0.001")))
