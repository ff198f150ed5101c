"""The model graph: raw sources → staging → intermediate → marts.

``GtmModels`` builds each model lazily as a DataFrame the first time it is
asked for and memoises it, so one Catalyst plan per mart is composed from
shared sub-plans.  Nothing here runs a job; ``pipeline.run_pipeline``
materialises the shared layers once when several marts are written.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from funnelworks.plans import audits, intermediate, marts, staging
from funnelworks.sources.gtm_raw import RawSources, load_raw_sources


class GtmModels:
    def __init__(self, raw: RawSources):
        self.raw = raw

    @classmethod
    def from_driver_tables(cls, spark: SparkSession, sf_dir: str) -> GtmModels:
        return cls(load_raw_sources(spark, sf_dir))

    # ---- staging -----------------------------------------------------------
    @cached_property
    def stg_expenses_advertising(self) -> DataFrame:
        return staging.stg_expenses_advertising(self.raw.expenses_advertising)

    @cached_property
    def stg_expenses_salary(self) -> DataFrame:
        return staging.stg_expenses_salary(self.raw.expenses_salary)

    @cached_property
    def stg_leads(self) -> DataFrame:
        return staging.stg_leads(self.raw.leads)

    @cached_property
    def stg_opportunities(self) -> DataFrame:
        return staging.stg_opportunities(self.raw.opportunities)

    @cached_property
    def audit_leads(self) -> DataFrame:
        return audits.audit_leads(self.raw.leads)

    @cached_property
    def audit_opportunities(self) -> DataFrame:
        return audits.audit_opportunities(self.raw.opportunities)

    # ---- intermediate ------------------------------------------------------
    @cached_property
    def int_expenses_channel_month(self) -> DataFrame:
        return intermediate.int_expenses_channel_month(self.stg_expenses_salary, self.stg_expenses_advertising)

    @cached_property
    def int_leads_enriched(self) -> DataFrame:
        return intermediate.int_leads_enriched(self.stg_leads, self.stg_opportunities)

    @cached_property
    def cohort_stats(self) -> DataFrame:
        return intermediate.cohort_stats(self.int_leads_enriched)

    @cached_property
    def int_funnel(self) -> DataFrame:
        return intermediate.int_funnel(self.int_leads_enriched, self.cohort_stats)

    @cached_property
    def int_restaurant_profile(self) -> DataFrame:
        return intermediate.int_restaurant_profile(self.int_leads_enriched)

    @cached_property
    def int_audit_by_month(self) -> DataFrame:
        return intermediate.int_audit_by_month(
            audits.lead_rows_dated(self.raw.leads), audits.opp_rows_dated(self.raw.opportunities)
        )

    # ---- marts -------------------------------------------------------------
    @cached_property
    def mart_cac_ltv(self) -> DataFrame:
        return marts.mart_cac_ltv(self.cohort_stats, self.int_expenses_channel_month)

    @cached_property
    def mart_gtm_funnel(self) -> DataFrame:
        return marts.mart_gtm_funnel(self.cohort_stats)

    @cached_property
    def mart_leading_indicators(self) -> DataFrame:
        return marts.mart_leading_indicators(self.int_leads_enriched)

    @cached_property
    def mart_data_quality_monitor(self) -> DataFrame:
        return marts.mart_data_quality_monitor(self.mart_cac_ltv, self.int_audit_by_month)
