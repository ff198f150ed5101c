"""Contracts, schema guard, one-scan audits, data-test operators."""

import pytest
from pyspark.sql import functions as F

from funnelworks.operators import quality as dq
from funnelworks.operators.contracts import ContractError, check_schema_unchanged, contract, enforce_contract
from funnelworks.plans.audits import audit_leads, audit_opportunities, lead_rows_dated, opp_rows_dated
from funnelworks.plans.intermediate import int_audit_by_month
from funnelworks.sources.schemas import RAW_LEADS, RAW_OPPORTUNITIES


def test_enforce_contract(spark):
    c = contract(("a", "int"), ("b", "string"))
    df = spark.createDataFrame([(1, 2)], "b int, a int")
    with pytest.raises(ContractError):
        enforce_contract(df, c)  # b retyped
    with pytest.raises(ContractError):
        enforce_contract(spark.createDataFrame([(1,)], "a int"), c)  # missing b
    with pytest.raises(ContractError):
        enforce_contract(spark.createDataFrame([(1, "x", 2)], "a int, b string, z int"), c)  # extra z
    ok = enforce_contract(spark.createDataFrame([("x", 1)], "b string, a int"), c)
    assert ok.columns == ["a", "b"]
    casted = enforce_contract(spark.createDataFrame([(1, 2)], "b int, a long"), c, cast=True)
    assert [f.dataType.simpleString() for f in casted.schema.fields] == ["int", "string"]


def test_schema_guard():
    a = contract(("a", "int"), ("b", "string"))
    check_schema_unchanged(a, a)
    with pytest.raises(ContractError):
        check_schema_unchanged(contract(("a", "bigint"), ("b", "string")), a)
    with pytest.raises(ContractError):
        check_schema_unchanged(contract(("b", "string"), ("a", "int")), a)


def _lead(**kw):
    r = {f: None for f in RAW_LEADS.fieldNames()}
    r.update(kw)
    return tuple(r[f] for f in RAW_LEADS.fieldNames())


def test_lead_audit_categories(spark):
    raw = spark.createDataFrame(
        [
            _lead(lead_id="m", form_submission_date="0024-03-05", status="New"),
            _lead(lead_id="d", status="Incorrect_Contact_Data"),
            _lead(lead_id="two", form_submission_date="0024-03-05", first_sales_call_date="2024-03-04 10:00:00",
                  status="Working"),
            _lead(lead_id="s", form_submission_date="2020-05-01", first_sales_call_date="2024-02-01 05:00:00"),
            _lead(lead_id="c", status="Converted", converted_opportunity_id="  "),
            _lead(lead_id="clean", form_submission_date="2024-03-05", status="New"),
        ],
        RAW_LEADS,
    )
    got = sorted((r.record_key, r.audit_category, r.diagnostic_info) for r in audit_leads(raw).collect())
    assert got == [
        ("c", "converted_missing_opp", "status: Converted"),
        ("d", "dirty_status_value", "raw value: Incorrect_Contact_Data"),
        ("m", "millennium_date_defect", "raw value: 0024-03-05"),
        ("s", "stale_lead", "submission: 2020-05-01 | first_call: 2024-02-01 05:00:00"),
        ("two", "millennium_date_defect", "raw value: 0024-03-05"),
        ("two", "negative_speed_to_contact", "speed_hours: -14.0"),
    ]


def test_opportunity_duplicate_audit(spark):
    f = RAW_OPPORTUNITIES.fieldNames()

    def opp(**kw):
        r = {x: None for x in f}
        r.update(kw)
        return tuple(r[x] for x in f)

    row = opp(opportunity_id="o1", stage_name="Closed Lost", lost_reason_c=" ", how_did_you_hear_about_us_c="Ads",
              close_date="0024-02-01")
    raw = spark.createDataFrame([row, row, opp(opportunity_id="o2", how_did_you_hear_about_us_c="x")], RAW_OPPORTUNITIES)
    got = sorted((r.record_key, r.audit_category) for r in audit_opportunities(raw).collect())
    assert got == [("o1", "duplicate_row"), ("o1", "millennium_date_defect"), ("o1", "missing_lost_reason")]


def _opportunities(spark):
    f = RAW_OPPORTUNITIES.fieldNames()

    def opp(**kw):
        r = dict.fromkeys(f) | {"how_did_you_hear_about_us_c": "Ads"} | kw
        return tuple(r[x] for x in f)

    jan, feb = "2024-01-05 00:00:00", "2024-02-05 00:00:00"
    dirty = opp(opportunity_id="o1", stage_name="Closed Lost", lost_reason_c=" ", created_date=jan)
    changed = opp(opportunity_id="o1", stage_name="Closed Lost", account_id="a", created_date=feb)
    nulls = [opp(account_id="a", created_date=jan), opp(account_id="b", created_date=jan, how_did_you_hear_about_us_c="")]
    rows = [dirty, dirty, changed, opp(opportunity_id="o2", created_date=feb), opp(opportunity_id="o3", stage_name="Closed Lost")]
    return spark.createDataFrame(rows + nulls, RAW_OPPORTUNITIES)


def test_audit_of_copies_changed_rows_and_null_ids(spark):
    got = [(r.record_key or "", r.audit_category, r.diagnostic_info) for r in audit_opportunities(_opportunities(spark)).collect()]
    lost = ("missing_lost_reason", "stage_name: Closed Lost | business_issue: null")
    assert sorted(got) == [
        ("", "duplicate_row", "2 total rows for this opportunity_id"),
        ("", "missing_attribution", "stage_name: null"),
        ("o1", "duplicate_row", "3 total rows for this opportunity_id"),
        ("o1", *lost),
        ("o1", *lost),  # two unlike rows with equal findings
        ("o3", *lost),
    ]
    assert audit_opportunities(spark.createDataFrame([], RAW_OPPORTUNITIES)).count() == 0


def test_month_counts_of_opportunity_findings(spark):
    no_leads = lead_rows_dated(spark.createDataFrame([], RAW_LEADS))
    rows = int_audit_by_month(no_leads, opp_rows_dated(_opportunities(spark))).collect()
    got = sorted((str(r.month_date)[:7], r.audit_category, r.finding_count, r.affected_records, r.monthly_record_count) for r in rows)
    assert got == [
        ("2024-01", "duplicate_row", 1, 1, 3),  # of o1; null ids aren't joined
        ("2024-01", "missing_attribution", 1, 0, 3),
        ("2024-01", "missing_lost_reason", 1, 1, 3),
        ("2024-02", "duplicate_row", 1, 1, 2),
        ("2024-02", "missing_lost_reason", 1, 1, 2),
    ]


def test_audits_read_opportunities_once(spark, tmp_dir):
    _opportunities(spark).write.parquet(f"{tmp_dir}/opps")
    raw = spark.read.schema(RAW_OPPORTUNITIES).parquet(f"{tmp_dir}/opps")
    no_leads = lead_rows_dated(spark.createDataFrame([], RAW_LEADS))
    for df in (audit_opportunities(raw), int_audit_by_month(no_leads, opp_rows_dated(raw))):
        assert df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1


def test_generic_data_tests(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "zz"), (3, None)], "k int, v string")
    assert dq.not_null(df, "k").count() == 1
    assert [tuple(r) for r in dq.unique(df, "k").collect()] == [(1, 2)]
    assert sorted(r.v for r in dq.accepted_values(df, "v", ["a", "b"]).collect()) == ["zz"]
    assert dq.expression_is_true(df, "k > 0").count() == 0  # null passes
    assert dq.accepted_range(df, "k", 0, 2).count() == 1
    parent = spark.createDataFrame([(1,)], "k int")
    assert dq.relationships(df, "k", parent, "k").count() == 1
    assert dq.not_null_proportion(df, "v", 0.8).count() == 1
    assert dq.not_null_proportion(df, "v", 0.75).count() == 0
