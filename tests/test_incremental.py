"""Keyed refresh semantics (FIXTURES §4 incremental rows)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from funnelworks.operators.contracts import ContractError
from funnelworks.plans.incremental_marts import build_mart_data_quality_monitor
from funnelworks.plans.marts import mart_data_quality_monitor
from funnelworks.streaming.incremental import (
    changed_months,
    expire_versions,
    lookback_filter,
    read_current,
    refresh_by_key,
    refresh_partitions,
    watermark_filter,
    with_dependents,
)

D = dt.date


def test_partition_refresh_replaces_only_batch_keys(spark, tmp_dir):
    path = f"{tmp_dir}/mart"
    first = spark.createDataFrame(
        [(D(2024, 1, 1), "inbound", 1), (D(2024, 5, 1), "inbound", 2), (D(2024, 5, 1), "outbound", 3)],
        "month_date date, channel string, v int",
    )
    refresh_partitions(spark, first, path, ["month_date", "channel"], full_refresh=True)
    batch = spark.createDataFrame([(D(2024, 5, 1), "inbound", 20), (D(2024, 6, 1), "inbound", 30)],
                                  "month_date date, channel string, v int")
    out = refresh_partitions(spark, batch, path, ["month_date", "channel"])
    got = sorted((r.month_date, r.channel, r.v) for r in out.collect())
    assert got == [
        (D(2024, 1, 1), "inbound", 1),  # older month untouched
        (D(2024, 5, 1), "inbound", 20),  # changed key replaced
        (D(2024, 5, 1), "outbound", 3),  # key absent from the batch kept
        (D(2024, 6, 1), "inbound", 30),  # new key inserted
    ]
    assert out.columns == ["month_date", "channel", "v"]


def test_partition_refresh_schema_change_fails(spark, tmp_dir):
    path = f"{tmp_dir}/mart"
    refresh_partitions(spark, spark.createDataFrame([(D(2024, 1, 1), "a", 1)], "month_date date, channel string, v int"),
                       path, ["month_date", "channel"], full_refresh=True)
    with pytest.raises(ContractError):
        refresh_partitions(spark, spark.createDataFrame([(D(2024, 1, 1), "a", 1)],
                                                        "month_date date, channel string, v bigint"),
                           path, ["month_date", "channel"])


def test_key_refresh_and_watermark(spark, tmp_dir):
    base = f"{tmp_dir}/leads"
    t = dt.datetime
    v1 = spark.createDataFrame(
        [("a", "working", t(2024, 1, 1)), ("b", "working", t(2024, 1, 5)), ("c", "new", None)],
        "lead_sk string, status string, last_at timestamp_ntz",
    )
    refresh_by_key(spark, v1, base, "lead_sk", full_refresh=True)
    source = spark.createDataFrame(
        [("a", "working", t(2024, 1, 1)), ("b", "disqualified", t(2024, 1, 5)), ("d", "new", t(2024, 2, 1)),
         ("e", "new", None)],
        "lead_sk string, status string, last_at timestamp_ntz",
    )
    stored = read_current(spark, base)
    batch = watermark_filter(source, stored, "last_at")
    # tie with the watermark reprocesses (b); null activity is not picked up (e)
    assert sorted(r.lead_sk for r in batch.collect()) == ["b", "d"]
    out = refresh_by_key(spark, batch, base, "lead_sk")
    got = sorted((r.lead_sk, r.status) for r in out.collect())
    assert got == [("a", "working"), ("b", "disqualified"), ("c", "new"), ("d", "new")]
    assert read_current(spark, base).count() == 4
    with_nulls = watermark_filter(source, read_current(spark, base), "last_at", include_nulls=True)
    assert sorted(r.lead_sk for r in with_nulls.collect()) == ["d", "e"]


def test_lookback_filter(spark):
    df = spark.createDataFrame([(D(2024, 3, 1),), (D(2024, 4, 1),), (D(2024, 6, 1),)], "m date")
    assert [r.m for r in lookback_filter(df, "m", "2024-06-15", 2).collect()] == [D(2024, 4, 1), D(2024, 6, 1)]
    _ = F


def test_first_run_applies_no_filter(spark, tmp_dir):
    """S12: with no stored target, an incremental call builds everything."""
    from funnelworks.plans.incremental_marts import build_mart_gtm_funnel
    from funnelworks.plans.models import GtmModels
    from funnelworks.sources.gtm_raw import load_raw_sources

    m = GtmModels(load_raw_sources(spark, "/root/testdata/sf0.001"))
    first = build_mart_gtm_funnel(spark, m, f"{tmp_dir}/funnel", as_of="2024-06-15")
    assert first.count() == m.mart_gtm_funnel.count()
    assert first.filter(F.col("month_date") < D(2024, 4, 1)).count() > 0  # older months present


def _months(spark, *rows):
    return spark.createDataFrame([(D(2024, m, 1),) for m in rows], "month_date date")


@pytest.mark.parametrize(
    "now, changed, again",
    [
        ([1, 2, 3, 5], [2], [2, 3]),
        ([1, 2, 3, 5], [5], [5]),
        ([1, 2, 5], [3], [5]),  # a month that is gone
        ([3, 5], [1, 2], [3]),
        ([1, 5], [2, 3, 5], [5]),
        ([1, 2, 3], [], []),
        ([], [1], []),
    ],
)
def test_months_that_depend_on_changed_ones(spark, now, changed, again):
    got = with_dependents(_months(spark, *now), _months(spark, *changed)).collect()
    assert sorted(r[0].month for r in got) == again


def _monitor_inputs(spark, rows, findings):
    from funnelworks.plans import contracts_catalog as C

    cac = spark.createDataFrame(
        [(f"k{m}", D(2024, m, 1), "inbound", Decimal(100), won, Decimal(50), None, Decimal(ltv), None) for m, won, ltv in rows],
        C.MART_CAC_LTV,
    )
    audit = spark.createDataFrame(
        [(f"a{m}", D(2024, m, 1), "leads", "stale_lead", n, n, 100, Decimal("0.01")) for m, n in findings], C.INT_AUDIT_BY_MONTH
    )
    return cac, audit


def test_monitor_after_a_late_correction(spark, tmp_dir):
    base = f"{tmp_dir}/monitor"
    before = _monitor_inputs(spark, [(1, 1, 10), (2, 1, 20), (3, 2, 30), (5, 1, 40), (6, 1, 1)], [(1, 4), (2, 5), (3, 6), (5, 7)])
    # February is corrected, May is gone
    after = _monitor_inputs(spark, [(1, 1, 10), (2, 3, 25), (3, 2, 30), (6, 1, 1)], [(1, 4), (2, 9), (3, 6)])
    build_mart_data_quality_monitor(spark, *before, base, full_refresh=True)
    old = stored_files(spark, base)
    changed = changed_months(before[0], after[0]).union(changed_months(before[1], after[1])).distinct()
    got = build_mart_data_quality_monitor(spark, *after, base, changed)
    full = mart_data_quality_monitor(*after)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, full.collect()))
    new = stored_files(spark, base)
    assert {p[-5:-3] for p in new if new[p] == old.get(p)} == {"01"} and {p[-5:-3] for p in new} == {"01", "02", "03", "06"}


def test_audit_months_without_findings_go(spark, tmp_dir):
    base, schema = f"{tmp_dir}/audit", "month_date date, source_table string, n int"
    first = [(D(2024, m, 1), "leads", m) for m in (1, 4, 5)] + [(None, "leads", 0)]
    keys = ["month_date", "source_table"]
    refresh_partitions(spark, spark.createDataFrame(first, schema), base, keys)
    batch = spark.createDataFrame([(D(2024, 4, 1), "leads", 40)], schema)
    out = refresh_partitions(spark, batch, base, keys, covers=lambda m: "2024-04-01" <= m <= "2024-12-01")
    assert sorted(r.n for r in out.collect()) == [0, 1, 40]


def files(df):
    return {r[0] for r in df.select("_metadata.file_path").distinct().collect()}


def stored_files(spark, base):
    """Files of the newest commit, by part."""
    from funnelworks.streaming.incremental import _newest

    return {f.partition("/")[2]: files(spark.read.parquet(f"{base}/{f}")) for f in _newest(spark, base)[1]}


def test_only_touched_buckets_are_written_again(spark, tmp_dir):
    base = f"{tmp_dir}/leads"
    full = spark.range(400).select(F.format_string("k%03d", "id").alias("lead_sk"), F.lit("old").alias("status"))
    refresh_by_key(spark, full, base, "lead_sk", full_refresh=True, buckets=16)
    before = stored_files(spark, base)
    batch = spark.createDataFrame([("k007", "new"), ("k007x", "new")], "lead_sk string, status string")
    # the source is read once: what it gives a second time must not matter
    out = refresh_by_key(spark, batch.withColumn("status", F.concat("status", F.lit("1"))), base, "lead_sk", buckets=16)
    after = stored_files(spark, base)
    changed = {part for part in after if after[part] != before.get(part)}
    assert set(before) == set(after) and len(before) == 16 and 1 <= len(changed) <= 2
    got = {r.lead_sk: r.status for r in out.collect()}
    assert len(got) == 401 and {k for k, v in got.items() if v == "new1"} == {"k007", "k007x"}
    with pytest.raises(ValueError, match="not in 8 buckets"):
        refresh_by_key(spark, batch, base, "lead_sk", buckets=8)
    gone = expire_versions(spark, base, keep=1)
    assert {g.partition("/")[2] for g in gone} == changed and read_current(spark, base).count() == 401
    assert expire_versions(spark, base, keep=1) == []  # what is gone is listed by old commits only


def test_a_killed_full_refresh_leaves_the_old_mart(spark, tmp_dir, monkeypatch):
    base = f"{tmp_dir}/mart"
    schema = "month_date date, channel string, v int"
    refresh_partitions(spark, spark.createDataFrame([(D(2024, 1, 1), "a", 1), (D(2024, 2, 1), "b", 2)], schema), base, ["month_date", "channel"])
    new = spark.createDataFrame([(D(2024, 3, 1), "c", 3)], schema)
    real = type(spark).createDataFrame

    def dies(self, rows, schema=None, *args, **kwargs):
        if schema == "version int, folder string":
            raise KeyboardInterrupt  # after the data is written, before the commit
        return real(self, rows, schema, *args, **kwargs)

    monkeypatch.setattr(type(spark), "createDataFrame", dies)
    with pytest.raises(KeyboardInterrupt):
        refresh_partitions(spark, new, base, ["month_date", "channel"], full_refresh=True)
    monkeypatch.undo()
    assert sorted(r.v for r in read_current(spark, base).collect()) == [1, 2]
    out = refresh_partitions(spark, new, base, ["month_date", "channel"], full_refresh=True)
    assert [tuple(r) for r in out.collect()] == [(D(2024, 3, 1), "c", 3)]


def test_refresh_with_nothing(spark, tmp_dir):
    schema = "month_date date, channel string, v int"
    none, one = spark.createDataFrame([], schema), spark.createDataFrame([(None, "a b/c:d%", 1)], schema)
    assert refresh_partitions(spark, none, f"{tmp_dir}/p", ["month_date", "channel"]).count() == 0
    assert [tuple(r) for r in refresh_partitions(spark, one, f"{tmp_dir}/p", ["month_date", "channel"]).collect()] == [(None, "a b/c:d%", 1)]
    assert refresh_partitions(spark, none, f"{tmp_dir}/p", ["month_date", "channel"]).count() == 1
    assert refresh_by_key(spark, none, f"{tmp_dir}/k", "channel").count() == 0
    assert refresh_by_key(spark, one, f"{tmp_dir}/k", "channel").count() == 1
    assert refresh_by_key(spark, none, f"{tmp_dir}/k", "channel").count() == 1
