"""Join helper, metric queries across semantic models, end-to-end pipeline."""

import os

from pyspark.sql import functions as F

from funnelworks.operators.joins import left_join_keyed, left_join_spread_nulls
from funnelworks.plans.semantic import metric_query
from funnelworks.plans.pipeline import run_pipeline
from funnelworks.sources.gtm_raw import load_raw_sources
from funnelworks.streaming.incremental import read_current

SF = "/root/testdata/sf0.001"


def test_left_join_spread_nulls(spark):
    left = spark.createDataFrame([("a", "k1"), ("b", None), ("c", None), ("d", "k9")], "id string, k string")
    right = spark.createDataFrame([("k1", 1), ("k2", 2)], "rk string, v int")
    out = left_join_spread_nulls(left, right, "k", "rk", ["id"])
    got = sorted((r.id, r.v) for r in out.collect())
    assert got == [("a", 1), ("b", None), ("c", None), ("d", None)]
    assert out.columns == ["id", "k", "rk", "v"]


def test_left_join_keyed_shuffles_rows_with_a_key_only(spark, tmp_dir):
    spark.createDataFrame([("a", "k1"), ("b", None), ("c", None), ("d", "k9"), ("e", "k1")], "id string, k string").write.parquet(f"{tmp_dir}/l")
    spark.createDataFrame([("k1", 1), ("k1", 2), (None, 3)], "rk string, v int").write.parquet(f"{tmp_dir}/r")
    left, right = spark.read.parquet(f"{tmp_dir}/l"), spark.read.parquet(f"{tmp_dir}/r")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = left_join_keyed(left, right, "k", "rk")
        plan = out._jdf.queryExecution().executedPlan().toString()
        same = left_join_spread_nulls(left, right, "k", "rk", ["id"])
        key = lambda r: str(tuple(r))
        assert out.columns == same.columns
        assert sorted(out.collect(), key=key) == sorted(same.collect(), key=key)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    joined, rest = plan.split("null AS rk")  # the second branch of the union comes last
    assert joined.count("Exchange hashpartitioning") == 2 and "Exchange" not in rest and "isnotnull(k" in joined
    assert left_join_keyed(left.limit(0), right, "k", "rk").count() == 0


def test_metric_query_across_models(spark):
    cac = spark.createDataFrame(
        [("2024-01-01", "inbound", 2.0), ("2024-02-01", "inbound", 4.0)], "m string, channel string, r double"
    ).select(F.to_date("m").alias("month_date"), "channel", F.col("r").cast("decimal(8,4)").alias("cac_ltv_ratio"))
    fun = spark.createDataFrame(
        [("2024-02-01", "inbound", 0.5), ("2024-03-01", "outbound", 0.25)], "m string, channel string, r double"
    ).select(F.to_date("m").alias("month_date"), "channel", F.col("r").cast("decimal(6,4)").alias("lead_to_demo_set_rate"))
    out = metric_query(
        {"mart_cac_ltv": cac, "mart_gtm_funnel": fun}, ["cac_ltv_ratio", "lead_to_demo_set_rate"], ["month_date__month"]
    )
    got = sorted((str(r[0]), r[1], r[2]) for r in out.collect())
    assert [g[0] for g in got] == ["2024-01-01", "2024-02-01", "2024-03-01"]  # full outer on the dimension
    assert got[1][1] == 4 and got[1][2] == 0.5 and got[0][2] is None and got[2][1] is None


def test_pipeline_full_then_incremental(spark, tmp_dir):
    raw = load_raw_sources(spark, SF)
    target = os.path.join(tmp_dir, "marts")
    paths = run_pipeline(spark, raw, target, full_refresh=True)
    n_leads = read_current(spark, paths["mart_leading_indicators"]).count()
    results = spark.read.parquet(paths["dq_test_results"])
    assert results.count() == 111 + 5 and results.filter("test_kind = 'unique' and failures > 0").count() == 0
    assert n_leads == raw.leads.count()
    before = read_current(spark, paths["mart_cac_ltv"]).count()
    run_pipeline(spark, raw, target, full_refresh=False, as_of="2024-06-15")
    assert read_current(spark, paths["mart_cac_ltv"]).count() == before  # same sources: same keys
    assert read_current(spark, paths["mart_leading_indicators"]).count() == n_leads
    assert spark.read.parquet(paths["mart_data_quality_monitor"]).count() > 0
