"""The analyst-facing table specification, as data, and its loader.

The specification lists for each mart its typed dimensions, measures with a
default aggregation, and named filters.  ``load_spec`` merges it into the
governed models (what they already declare stays) and ``check_models`` holds
every dimension, measure and filter against the schemas of the marts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

AGGREGATIONS = {"sum": "sum", "avg": "average", "count": "count"}
KINDS = {
    "text": (T.StringType,),
    "boolean": (T.BooleanType,),
    "date": (T.DateType, T.TimestampType, T.TimestampNTZType),
    "number": (T.NumericType,),
}


@dataclass(frozen=True)
class SpecTable:
    table: str
    dimensions: Mapping[str, str]  # name -> text | boolean | date | number
    measures: Sequence[tuple[str, str, str, str]]  # name, expression, type, default aggregation
    filters: Mapping[str, Sequence[str]] = field(default_factory=dict)  # name -> conditions that all hold


_JAN_JUN = "month_date between '2024-01-01' and '2024-06-01'"

# Tables, measures and filters of the specification.
SPEC = [
    SpecTable(
        "mart_cac_ltv",
        {"month_date": "date", "channel": "text"},
        [
            ("total_cost_usd", "total_cost_usd", "number", "sum"),
            ("new_customers_won", "new_customers_won", "number", "sum"),
            ("cac_usd", "cac_usd", "number", "avg"),
            ("avg_estimated_ltv_usd", "avg_estimated_ltv_usd", "number", "avg"),
            ("cac_ltv_ratio", "cac_ltv_ratio", "number", "avg"),
        ],
        {
            "inbound_only": ["channel = 'inbound'"],
            "outbound_only": ["channel = 'outbound'"],
            "jan_jun_2024": [_JAN_JUN],
        },
    ),
    SpecTable(
        "mart_gtm_funnel",
        {"month_date": "date", "channel": "text"},
        [
            ("leads_created", "leads_created", "number", "sum"),
            ("demos_set", "demos_set", "number", "sum"),
            ("demos_held", "demos_held", "number", "sum"),
            ("closed_won", "closed_won", "number", "sum"),
            ("lead_to_demo_set_rate", "lead_to_demo_set_rate", "number", "avg"),
            ("demo_to_close_rate", "demo_to_close_rate", "number", "avg"),
            ("overall_conversion_rate", "overall_conversion_rate", "number", "avg"),
            ("avg_speed_to_first_contact_hours", "avg_speed_to_first_contact_hours", "number", "avg"),
            ("avg_days_in_funnel", "avg_days_in_funnel", "number", "avg"),
        ],
        {
            "outbound_2024": ["channel = 'outbound'", _JAN_JUN],
            "inbound_2024": ["channel = 'inbound'", _JAN_JUN],
        },
    ),
    SpecTable(
        "mart_leading_indicators",
        {
            "channel": "text",
            "conversion_probability_tier": "text",
            "is_converted": "boolean",
            "is_disqualified": "boolean",
            "connected_with_decision_maker": "boolean",
            "has_olo_tool": "boolean",
        },
        [
            ("lead_count", "lead_sk", "text", "count"),
            ("avg_predicted_monthly_gmv_usd", "predicted_monthly_gmv_usd", "number", "avg"),
            ("avg_speed_to_first_contact_hours", "speed_to_first_contact_hours", "number", "avg"),
            ("avg_activity_density_score", "activity_density_score", "number", "avg"),
        ],
        {
            "hot_leads": ["conversion_probability_tier = 'hot'"],
            "warm_leads": ["conversion_probability_tier = 'warm'"],
            "cold_leads": ["conversion_probability_tier = 'cold'"],
            "converted_customers": ["conversion_probability_tier = 'converted'"],
            "active_unscored": ["is_disqualified = false", "conversion_probability_tier is not null"],
            "inbound_active": ["channel = 'inbound'", "is_disqualified = false"],
            "outbound_active": ["channel = 'outbound'", "is_disqualified = false"],
        },
    ),
]


def load_spec(models: Sequence, spec: Sequence[SpecTable], measure_class: type) -> list:
    """``models`` with the specification's dimensions, measures and filters.
    A measure of the same name and expression is kept as it is; the same name
    for another aggregation of the same model raises."""
    by_table = {m.table: m for m in models}
    out = dict(by_table)
    for s in spec:
        if s.table not in by_table:
            raise KeyError(f"the specification names {s.table}, which no model has")
        model = by_table[s.table]
        have = {m.name: m for m in model.measures}
        new = []
        for name, expr, kind, agg in s.measures:
            if kind not in KINDS or agg not in AGGREGATIONS:
                raise ValueError(f"{s.table}.{name}: type {kind}, aggregation {agg}")
            made = measure_class(name, AGGREGATIONS[agg], expr, kind)
            if name not in have:
                new.append(made)
            elif (have[name].agg, have[name].expr) != (made.agg, made.expr):
                raise ValueError(f"{s.table}.{name} is declared twice, differently")
        dims = [d for d in s.dimensions if d not in model.dimensions and d not in model.time_dimensions]
        out[s.table] = replace(
            model,
            measures=[*model.measures, *new],
            dimensions=[*model.dimensions, *dims],
            types={**model.types, **s.dimensions},
            filters={**model.filters, **{k: tuple(v) for k, v in s.filters.items()}},
        )
    return list(out.values())


def check_models(models: Sequence, tables: Mapping[str, DataFrame]) -> None:
    """Every dimension, measure and filter must be resolved by its mart and
    have the declared type; plans are analysed, no data is read."""
    for model in models:
        src = tables[model.table]
        for name in [*model.dimensions, *model.time_dimensions]:
            kind = src.select(F.col(name)).schema[0].dataType
            if name in model.types and not isinstance(kind, KINDS[model.types[name]]):
                raise TypeError(f"{model.name}.{name}: {model.types[name]} declared, {kind.simpleString()} found")
        for m in model.measures:
            kind = src.select(F.expr(m.expr)).schema[0].dataType
            if m.kind and not isinstance(kind, KINDS[m.kind]):
                raise TypeError(f"{model.name}.{m.name}: {m.kind} declared, {kind.simpleString()} found")
        dims = src.select(*dict.fromkeys([*model.dimensions, *model.time_dimensions]))
        for conditions in model.filters.values():
            for c in conditions:
                _ = dims.where(F.expr(c)).schema
