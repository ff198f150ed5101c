"""Oracle: expected table states after the incremental scenarios
(snapshot = orders placed before 1998 built in full, then all orders
refreshed as of 2024-06-15 with a two-month lookback)."""

import re

from oracle.cte import CTES, snapshot_ctes, sql, sql_with

INC: dict[str, str] = {}
SNAP = [("orders_s", "SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'")]
CUTOFF = "DATE '2024-04-01'"


def _snap(root: str):
    return SNAP + snapshot_ctes(root, "_s", {"orders": "orders_s"})


for key, mart in [("inc_month_channel_refresh", "mart_cac_ltv"), ("inc_funnel_refresh", "mart_gtm_funnel")]:
    INC[key] = sql_with(
        _snap(mart),
        f"""
SELECT * FROM {mart} WHERE month_date >= {CUTOFF}
UNION ALL
SELECT * FROM {mart}_s s WHERE NOT EXISTS (
  SELECT 1 FROM {mart} f WHERE f.month_date >= {CUTOFF} AND f.month_date = s.month_date AND f.channel = s.channel)
""",
        mart,
    )

INC["inc_lead_refresh"] = sql_with(
    _snap("mart_leading_indicators"),
    """
SELECT * FROM mart_leading_indicators WHERE last_sales_activity_at >= (
  SELECT max(last_sales_activity_at) FROM mart_leading_indicators_s WHERE last_sales_activity_at IS NOT NULL)
UNION ALL
SELECT * FROM mart_leading_indicators_s s WHERE s.lead_sk NOT IN (
  SELECT lead_sk FROM mart_leading_indicators WHERE last_sales_activity_at >= (
    SELECT max(last_sales_activity_at) FROM mart_leading_indicators_s WHERE last_sales_activity_at IS NOT NULL))
""",
    "mart_leading_indicators",
)
INC["inc_lookback_filter"] = sql(f"SELECT * FROM mart_gtm_funnel WHERE month_date >= {CUTOFF}")
INC["inc_watermark_filter"] = sql_with(
    _snap("mart_leading_indicators"),
    """
SELECT lead_id, last_sales_activity_at FROM int_leads_enriched WHERE last_sales_activity_at >= (
  SELECT max(last_sales_activity_at) FROM mart_leading_indicators_s WHERE last_sales_activity_at IS NOT NULL)
""",
    "int_leads_enriched",
)

# Findings by month: the lookback's months as of now, older ones as of the snapshot.
AUDIT_NOW = f"""
SELECT * FROM int_audit_by_month WHERE month_date >= {CUTOFF}
UNION ALL SELECT * FROM int_audit_by_month_s WHERE month_date < {CUTOFF}
"""
INC["inc_audit_month_refresh"] = sql_with(_snap("int_audit_by_month"), AUDIT_NOW, "int_audit_by_month")

# The monitor of the refreshed tables, computed in full.
_tail = [
    ("cac_now", f"SELECT * FROM mart_cac_ltv WHERE month_date >= {CUTOFF} UNION ALL "
                f"SELECT * FROM mart_cac_ltv_s WHERE month_date < {CUTOFF}"),
    ("audit_now", AUDIT_NOW),
]
_monitor = ["findings_of_month", "money_of_month", "monitored_month", "mart_data_quality_monitor"]
for _name in _monitor:
    _body = CTES[_name]
    for _old, _new in [(n, f"{n}_now") for n in _monitor] + [("mart_cac_ltv", "cac_now"), ("int_audit_by_month", "audit_now")]:
        _body = re.sub(rf"\b{_old}\b", _new, _body)
    _tail.append((f"{_name}_now", _body))
INC["inc_monitor_refresh"] = sql_with(
    list(dict(_snap("mart_cac_ltv") + _snap("int_audit_by_month")).items()),
    "SELECT * FROM (WITH " + ", ".join(f"{n} AS ({b})" for n, b in _tail) + " SELECT * FROM mart_data_quality_monitor_now)",
    "mart_cac_ltv",
    "int_audit_by_month",
)
