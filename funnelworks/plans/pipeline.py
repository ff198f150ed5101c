"""End-to-end build: raw sources → all marts written under a target folder.

The enriched lead table feeds the funnel, CAC/LTV, leading-indicator and
profile models; it is written once as a table (cutting its lineage, so a
lost executor recomputes from the written files, not from the raw join) and
every consumer reads it back.  Marts are written with their incremental
strategy; ``full_refresh`` rebuilds them.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

from funnelworks.plans import incremental_marts as inc
from funnelworks.plans.intermediate import cohort_stats, int_leads_enriched
from funnelworks.plans.models import GtmModels
from funnelworks.session import scratch_path
from funnelworks.sources.gtm_raw import RawSources


def materialize(spark: SparkSession, df, name: str, path: str | None = None):
    """Write df as a Parquet table (under the shared checkpoint folder unless
    a path is given) and return it re-read: lineage is cut, and every later
    consumer scans files instead of recomputing the plan."""
    path = path or scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def materialized_models(spark: SparkSession, raw: RawSources, folder: str | None = None) -> GtmModels:
    """A model graph whose shared bases are stored once: the raw lead and
    opportunity exports and the enriched leads.  Every other model is a narrow
    map or a small aggregate over those tables."""

    def where(name: str) -> str | None:
        return os.path.join(folder, name) if folder else None

    stored = RawSources(
        leads=materialize(spark, raw.leads, "raw_leads", where("raw_leads")),
        opportunities=materialize(spark, raw.opportunities, "raw_opportunities", where("raw_opportunities")),
        expenses_advertising=raw.expenses_advertising,
        expenses_salary=raw.expenses_salary,
    )
    m = GtmModels(stored)
    enriched = int_leads_enriched(m.stg_leads, m.stg_opportunities, stored=True)
    m.__dict__["int_leads_enriched"] = materialize(spark, enriched, "int_leads_enriched", where("int_leads_enriched"))
    return m


def run_pipeline(
    spark: SparkSession,
    raw: RawSources,
    target_dir: str,
    full_refresh: bool = True,
    as_of: str | None = None,
    lookback_months: int = inc.DEFAULT_LOOKBACK_MONTHS,
    run_tests: bool = True,
) -> dict[str, str]:
    """Build every mart (each with its refresh strategy), then run the
    declared data tests and the singular invariants over the stored tables
    and write their summary."""
    from funnelworks.operators.quality import run_invariants
    from funnelworks.operators.quality import run_tests as _run_tests
    from funnelworks.plans.quality_suite import invariants, specs

    m = materialized_models(spark, raw, os.path.join(target_dir, "_bases"))
    paths = {
        name: os.path.join(target_dir, name)
        for name in ("mart_cac_ltv", "mart_gtm_funnel", "mart_leading_indicators", "mart_data_quality_monitor")
    }
    # Both month marts share one lookback and one cohort aggregate: compute it
    # once (month × channel grain, tiny) instead of scanning the enriched
    # leads once per mart.
    incremental = {k: not full_refresh and inc.table_exists(spark, paths[k]) for k in ("mart_cac_ltv", "mart_gtm_funnel")}
    stats = None
    if len(set(incremental.values())) == 1:  # both marts take the same batch
        since = inc.lookback_start(as_of, lookback_months) if incremental["mart_cac_ltv"] else None
        stats = materialize(
            spark, cohort_stats(m.int_leads_enriched, since), "cohort_stats", os.path.join(target_dir, "_bases", "cohort_stats")
        )
    cac = inc.build_mart_cac_ltv(spark, m, paths["mart_cac_ltv"], as_of, lookback_months, full_refresh, stats)
    funnel = inc.build_mart_gtm_funnel(spark, m, paths["mart_gtm_funnel"], as_of, lookback_months, full_refresh, stats)
    leads = inc.build_mart_leading_indicators(spark, m, paths["mart_leading_indicators"], full_refresh)
    # The monitor is a full-rebuild table over the stored CAC mart.
    m.__dict__.update(mart_cac_ltv=cac, mart_gtm_funnel=funnel, mart_leading_indicators=leads)
    m.__dict__["mart_data_quality_monitor"] = materialize(
        spark, m.mart_data_quality_monitor, "mart_data_quality_monitor", paths["mart_data_quality_monitor"]
    )
    if run_tests:
        from funnelworks.catalog import MODEL_KEYS

        tables = {name: getattr(m, name) for name in MODEL_KEYS}
        paths["dq_test_results"] = os.path.join(target_dir, "dq_test_results")
        results = _run_tests(tables, specs()).unionByName(run_invariants(invariants(tables)))
        results.write.mode("overwrite").parquet(paths["dq_test_results"])
    return paths
