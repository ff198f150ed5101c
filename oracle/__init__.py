"""Independent DuckDB SQL oracles for every registered query."""

from oracle import models as _models  # noqa: F401
from oracle.cte import sql

ORACLE: dict[str, str] = {}

for _key, _cte in [
    ("src_leads", "raw_leads"),
    ("src_opportunities", "raw_opportunities"),
    ("src_expenses_advertising", "raw_expenses_advertising"),
    ("src_expenses_salary", "raw_expenses_salary"),
]:
    ORACLE[_key] = sql(f"SELECT * FROM {_cte}", _cte)

for _key in [
    "stg_expenses_advertising",
    "stg_expenses_salary",
    "stg_leads",
    "stg_opportunities",
    "audit_leads",
    "audit_opportunities",
    "int_expenses_channel_month",
    "int_leads_enriched",
    "int_funnel",
    "int_restaurant_profile",
    "int_audit_by_month",
    "mart_cac_ltv",
    "mart_gtm_funnel",
    "mart_leading_indicators",
    "mart_data_quality_monitor",
]:
    ORACLE[_key] = sql(f"SELECT * FROM {_key}", _key)

from oracle.reports import REPORTS  # noqa: E402

ORACLE.update(REPORTS)

from oracle.quality import QUALITY  # noqa: E402

ORACLE.update(QUALITY)

from oracle.functions import FUNCS  # noqa: E402

ORACLE.update(FUNCS)

from oracle.ops import OPS  # noqa: E402

ORACLE.update(OPS)

from oracle.incremental import INC  # noqa: E402

ORACLE.update(INC)
