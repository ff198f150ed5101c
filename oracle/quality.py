"""Oracle: data tests as DuckDB SQL (one SELECT per declared test)."""

from funnelworks.plans.quality_suite import specs
from oracle.cte import cte, rdiv, sql

QUALITY: dict[str, str] = {}


def _lit(v) -> str:
    return "'" + str(v).replace("'", "''") + "'"


def _test_sql(s) -> str:
    head = f"SELECT {_lit(s.name)} AS test_name, {_lit(s.model)} AS model, {_lit(s.column)} AS column_name, " \
           f"{_lit(s.kind)} AS test_kind, "
    w = f"({s.where}) AND " if s.where else ""
    c = s.column
    if s.kind == "not_null":
        return head + f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS failures FROM {s.model}"
    if s.kind == "unique":
        return head + f"CAST(count(*) AS BIGINT) AS failures FROM (SELECT {c} FROM {s.model} WHERE {c} IS NOT NULL " \
                      f"GROUP BY {c} HAVING count(*) > 1) t"
    if s.kind == "accepted_values":
        vals = ", ".join(_lit(v) for v in s.args["values"])
        return head + f"CAST(count(*) AS BIGINT) AS failures FROM (SELECT {c} FROM {s.model} WHERE {w}{c} NOT IN ({vals}) " \
                      f"GROUP BY {c}) t"
    if s.kind == "expression_is_true":
        return head + f"CAST(count(*) FILTER (WHERE {w}NOT ({c} {s.args['expression']})) AS BIGINT) AS failures FROM {s.model}"
    if s.kind == "accepted_range":
        lo, hi = s.args["min_value"], s.args["max_value"]
        return head + f"CAST(count(*) FILTER (WHERE {w}NOT ({c} >= {lo} AND {c} <= {hi})) AS BIGINT) AS failures FROM {s.model}"
    if s.kind == "not_null_proportion":
        return head + f"CAST(count(*) AS BIGINT) AS failures FROM (SELECT count({c}) AS nn, count(*) AS n FROM {s.model}) t " \
                      f"WHERE nn < {s.args['at_least']} * n"
    if s.kind == "relationships":
        return head + f"CAST(count(*) AS BIGINT) AS failures FROM {s.model} x WHERE {c} IS NOT NULL AND {c} NOT IN " \
                      f"(SELECT {s.args['field']} FROM {s.args['to']} WHERE {s.args['field']} IS NOT NULL)"
    raise ValueError(s.kind)


def suite_sql(kind=None) -> str:
    return sql("\nUNION ALL\n".join(_test_sql(s) for s in specs(kind)))


for kind, key in [
    ("not_null", "dq_not_null"),
    ("unique", "dq_unique"),
    ("accepted_values", "dq_accepted_values"),
    ("expression_is_true", "dq_expression"),
    ("accepted_range", "dq_range"),
    ("not_null_proportion", "dq_not_null_proportion"),
]:
    QUALITY[key] = suite_sql(kind)
QUALITY["dq_suite"] = suite_sql()

QUALITY["dq_relationships"] = sql(
    "SELECT o_orderkey, o_custkey FROM orders o WHERE o_custkey IS NOT NULL "
    "AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)"
)
LEAD_FK = (
    "SELECT lead_id FROM mart_leading_indicators m WHERE lead_id IS NOT NULL "
    "AND NOT EXISTS (SELECT 1 FROM stg_leads s WHERE s.lead_id = m.lead_id)"
)
QUALITY["dq_lead_fk"] = sql(LEAD_FK)
QUALITY["dq_raw_duplicate_ids"] = sql(
    "SELECT opportunity_id, count(*) AS n_records FROM raw_opportunities WHERE opportunity_id IS NOT NULL "
    "GROUP BY opportunity_id HAVING count(*) > 1"
)
QUALITY["dq_raw_status_values"] = sql(
    "SELECT status, count(*) AS n_records FROM raw_leads WHERE status NOT IN ('New', 'Working', 'Demo Set', "
    "'Sales Nurture', 'Marketing Nurture', 'Converted', 'Disqualified', 'Not Interested', 'Incorrect Contact Data', "
    "'No Longer With Company', 'No Show', 'Postpone', 'Restaurant Confirmed', 'Nurturing') GROUP BY status"
)
TWO_CHANNELS = (
    "SELECT month_date, count(*) AS channel_count, list_sort(list(channel)) AS channels_present "
    "FROM mart_cac_ltv GROUP BY month_date HAVING count(*) <> 2"
)
QUALITY["dq_two_channels"] = sql(TWO_CHANNELS)


def _cac_gap(bound: int) -> str:
    ratio_num = "CAST(outbound_cac * 100 AS HUGEINT)"
    ratio_den = "CAST(inbound_cac * 100 AS HUGEINT)"
    return (
        f"SELECT month_date, inbound_cac, outbound_cac, {rdiv(ratio_num, ratio_den, 2, 12)} AS cac_ratio FROM ("
        "SELECT month_date, max(CASE WHEN channel = 'inbound' THEN cac_usd END) AS inbound_cac, "
        "max(CASE WHEN channel = 'outbound' THEN cac_usd END) AS outbound_cac "
        "FROM mart_cac_ltv WHERE cac_usd IS NOT NULL GROUP BY month_date) p "
        f"WHERE inbound_cac <> 0 AND {ratio_num} > {bound} * {ratio_den}"
    )


QUALITY["dq_cac_gap"] = sql(_cac_gap(10))
QUALITY["dq_cac_gap_2x"] = sql(_cac_gap(1))
CONVERTED = (
    "SELECT lead_id, lead_sk, channel, is_converted, is_disqualified, connected_with_decision_maker, "
    "speed_to_first_contact_hours, total_activity_count, predicted_monthly_gmv_usd, conversion_probability_tier "
    "FROM mart_leading_indicators WHERE is_converted = true AND is_disqualified IS NOT true "
    "AND conversion_probability_tier <> 'converted'"
)
QUALITY["dq_converted_tier"] = sql(CONVERTED)
DISQUALIFIED = (
    "SELECT lead_id, lead_sk, status, is_disqualified, conversion_probability_tier FROM mart_leading_indicators "
    "WHERE is_disqualified = true AND conversion_probability_tier IS NOT NULL"
)
QUALITY["dq_disqualified_tier"] = sql(DISQUALIFIED)
LEAD_COUNT = (
    "SELECT s.n AS staging_leads, m.n AS mart_leads, m.n - s.n AS delta FROM "
    "(SELECT count(*) AS n FROM stg_leads) s CROSS JOIN (SELECT count(*) AS n FROM mart_leading_indicators) m "
    "WHERE s.n <> m.n"
)
QUALITY["dq_lead_count"] = sql(LEAD_COUNT)

# ---- the same tests over models with planted defects -----------------------------------
_LEADS = """
SELECT * REPLACE (
  CASE WHEN is_converted AND lead_id LIKE '%2' THEN 'cold' WHEN is_disqualified AND lead_id LIKE '%3' THEN 'warm'
       ELSE conversion_probability_tier END AS conversion_probability_tier,
  CASE WHEN lead_id LIKE '%4' THEN -1 ELSE total_activity_count END AS total_activity_count,
  CASE WHEN lead_id LIKE '%5' THEN 'partner' ELSE channel END AS channel,
  CASE WHEN lead_id LIKE '%6' THEN 'same' ELSE lead_sk END AS lead_sk,
  CASE WHEN lead_id LIKE '%7' THEN 2000000.00 ELSE predicted_monthly_gmv_usd END AS predicted_monthly_gmv_usd,
  CASE WHEN lead_id LIKE '%8' THEN speed_to_first_contact_hours END AS speed_to_first_contact_hours,
  CASE WHEN lead_id LIKE '%9' THEN 'X' || lead_id ELSE lead_id END AS lead_id)
FROM mart_leading_indicators WHERE lead_id NOT LIKE '%00'
"""
_CAC = """
SELECT * REPLACE (
  CASE WHEN channel = 'outbound' THEN cac_usd * 50 ELSE cac_usd END AS cac_usd,
  CASE WHEN month(month_date) = 4 THEN -total_cost_usd ELSE total_cost_usd END AS total_cost_usd)
FROM mart_cac_ltv WHERE NOT (channel = 'outbound' AND month(month_date) = 2)
"""
cte("planted_leads", _LEADS)
cte("planted_cac", _CAC)


def _planted(text: str) -> str:
    """A test's own SELECT over the planted models."""
    for name, other in (("mart_leading_indicators", "planted_leads"), ("mart_cac_ltv", "planted_cac")):
        text = text.replace(f"FROM {name}", f"FROM {other}")
    return text


QUALITY["dq_planted_suite"] = sql("\nUNION ALL\n".join(_planted(_test_sql(s)) for s in specs()))
for key, text in [
    ("two_channels_per_month", TWO_CHANNELS),
    ("outbound_cac_not_extreme", _cac_gap(10)),
    ("converted_not_cold", CONVERTED),
    ("disqualified_tier_null", DISQUALIFIED),
    ("lead_count_matches_staging", LEAD_COUNT),
    ("lead_fk", LEAD_FK),
]:
    QUALITY[f"dq_planted_{key}"] = sql(_planted(text))
