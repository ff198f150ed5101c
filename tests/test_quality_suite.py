"""Every kind of data test finds planted defects, and a table is read once."""

import re

from funnelworks.catalog import model_tables, models
from funnelworks.operators.quality import TestSpec, run_invariants, run_tests
from funnelworks.plans.pipeline import materialize
from funnelworks.plans.quality_suite import invariants, specs, with_defects

SF = "/root/testdata/sf0.001"


def test_planted_defects_are_found(spark):
    tables = model_tables(models(spark, SF))
    for name in ("mart_cac_ltv", "mart_leading_indicators", "stg_leads"):
        tables[name] = materialize(spark, tables[name], name)
    own = [s for s in specs() if s.model in ("mart_cac_ltv", "mart_leading_indicators")]
    clean = {r.test_name: r.failures for r in run_tests(tables, own).collect()}
    bad = with_defects(tables)
    found = {r.test_name: r.failures for r in run_tests(bad, own).collect()}
    assert len(found) == len(own) == len(clean)
    assert all(clean[f"{k}"] == 0 for k in clean if "not_null__" not in k)
    worse = {s.kind for s in own if found[s.name] > clean[s.name]}
    assert worse == {"unique", "accepted_values", "expression_is_true", "accepted_range", "not_null_proportion", "relationships"}
    assert all(r.failures == 0 for r in run_invariants(invariants(tables)).collect())
    assert all(r.failures > 0 for r in run_invariants(invariants(bad)).collect())


def test_a_table_is_read_once(spark, tmp_dir):
    rows = [(1, "a", 5), (2, "a", None), (2, "b", -1), (None, "c", 7)]
    path = f"{tmp_dir}/t"
    spark.createDataFrame(rows, "id int, kind string, n int").write.parquet(path)
    own = [
        TestSpec("t", "unique", "id"), TestSpec("t", "unique", "kind"), TestSpec("t", "not_null", "n"), TestSpec("t", "not_null", "id"),
        TestSpec("t", "accepted_values", "kind", {"values": ["a"]}), TestSpec("t", "expression_is_true", "n", {"expression": "> 0"}),
        TestSpec("t", "accepted_range", "n", {"min_value": 0, "max_value": 6}, "kind <> 'c'"),
        TestSpec("t", "not_null_proportion", "n", {"at_least": 0.75}), TestSpec("t", "not_null_proportion", "id", {"at_least": 0.8}),
    ]
    df = run_tests({"t": spark.read.parquet(path)}, own)
    assert [r.failures for r in df.collect()] == [1, 1, 1, 1, 2, 1, 1, 0, 1]
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert len(re.findall(r"Scan parquet", final)) == 1
    assert run_tests({"t": spark.read.parquet(path).limit(0)}, own).agg({"failures": "sum"}).first()[0] == 0
