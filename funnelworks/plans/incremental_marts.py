"""Incremental builds of the three incremental marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelworks.plans import audits, marts
from funnelworks.plans.intermediate import cohort_stats, int_audit_by_month
from funnelworks.plans.models import GtmModels
from funnelworks.streaming.incremental import (  # noqa: F401 (re-exported for the pipeline)
    changed_months,
    lookback_start,
    read_current,
    refresh_by_key,
    refresh_partitions,
    table_exists,
    watermark_filter,
    with_dependents,
)

MONTH_KEYS = ["month_date", "channel"]
DEFAULT_LOOKBACK_MONTHS = 2


def _since(spark: SparkSession, path: str, as_of: str | None, months: int, full_refresh: bool):
    incremental = not full_refresh and table_exists(spark, path)
    if incremental and as_of is None:
        raise ValueError("an incremental run needs as_of (the run date)")
    return lookback_start(as_of, months) if incremental else None


def cac_ltv_batch(m: GtmModels, since=None, stats: DataFrame | None = None) -> DataFrame:
    stats = cohort_stats(m.int_leads_enriched, since) if stats is None else stats
    return marts.mart_cac_ltv(stats, m.int_expenses_channel_month)


def gtm_funnel_batch(m: GtmModels, since=None, stats: DataFrame | None = None) -> DataFrame:
    stats = cohort_stats(m.int_leads_enriched, since) if stats is None else stats
    return marts.mart_gtm_funnel(stats)


def build_mart_cac_ltv(
    spark: SparkSession, m: GtmModels, path: str, as_of: str | None = None,
    lookback_months: int = DEFAULT_LOOKBACK_MONTHS, full_refresh: bool = False, stats: DataFrame | None = None,
) -> DataFrame:
    """``stats``: a precomputed cohort aggregate for the same lookback (the
    pipeline computes it once for both month marts)."""
    since = _since(spark, path, as_of, lookback_months, full_refresh)
    return refresh_partitions(spark, cac_ltv_batch(m, since, stats), path, MONTH_KEYS, full_refresh)


def build_mart_gtm_funnel(
    spark: SparkSession, m: GtmModels, path: str, as_of: str | None = None,
    lookback_months: int = DEFAULT_LOOKBACK_MONTHS, full_refresh: bool = False, stats: DataFrame | None = None,
) -> DataFrame:
    since = _since(spark, path, as_of, lookback_months, full_refresh)
    return refresh_partitions(spark, gtm_funnel_batch(m, since, stats), path, MONTH_KEYS, full_refresh)


def leading_indicators_batch(
    spark: SparkSession, m: GtmModels, base: str, full_refresh: bool = False, include_null_watermark: bool = False
) -> DataFrame:
    enriched = m.int_leads_enriched
    stored = None if full_refresh else read_current(spark, base)
    if stored is not None:
        enriched = watermark_filter(enriched, stored, "last_sales_activity_at", include_null_watermark)
    return marts.mart_leading_indicators(enriched)


def build_mart_leading_indicators(
    spark: SparkSession, m: GtmModels, base: str, full_refresh: bool = False, include_null_watermark: bool = False
) -> DataFrame:
    batch = leading_indicators_batch(spark, m, base, full_refresh, include_null_watermark)
    return refresh_by_key(spark, batch, base, "lead_sk", full_refresh)


def audit_by_month_batch(m: GtmModels, since=None) -> DataFrame:
    """Month counts from ``since`` on; the months are cut on the source rows,
    before the counts.  Ids are exact: a month's distinct records lie in that
    month, and raw rows of an opportunity are counted over all months."""
    leads, opps = audits.lead_rows_dated(m.raw.leads), audits.opp_rows_dated(m.raw.opportunities)
    if since is not None:
        leads, opps = (rows.filter(F.col("month_date") >= since) for rows in (leads, opps))
    return int_audit_by_month(leads, opps)


def build_int_audit_by_month(
    spark: SparkSession, m: GtmModels, path: str, as_of: str | None = None,
    lookback_months: int = DEFAULT_LOOKBACK_MONTHS, full_refresh: bool = False,
) -> DataFrame:
    """A month × source of the lookback without findings any more loses its rows."""
    since = _since(spark, path, as_of, lookback_months, full_refresh)
    first = None if since is None else spark.range(1).select(since).first()[0].isoformat()
    covers = None if first is None else lambda month: month >= first
    return refresh_partitions(
        spark, audit_by_month_batch(m, since), path, ["month_date", "source_table"], full_refresh, covers
    )


def build_mart_data_quality_monitor(
    spark: SparkSession, cac_ltv: DataFrame, audit_by_month: DataFrame, path: str,
    changed: DataFrame | None = None, full_refresh: bool = False,
) -> DataFrame:
    """``changed``: months whose rows in either input differ from those of the
    stored monitor (``changed_months``).  They and the months whose change
    against the month before depends on them are written again, others keep
    their files; a changed month that is gone from the CAC mart goes."""
    monitor = marts.mart_data_quality_monitor(cac_ltv, audit_by_month)
    if full_refresh or changed is None or not table_exists(spark, path):
        return refresh_partitions(spark, monitor, path, ["month_date"], full_refresh=True)
    again = with_dependents(cac_ltv.select("month_date").distinct(), changed)
    gone = {str(r[0]) for r in changed.collect()}  # months only
    batch = monitor.join(again, "month_date", "left_semi").select(*monitor.columns)
    return refresh_partitions(spark, batch, path, ["month_date"], covers=gone.__contains__)
