"""Governed metrics: semantic models, measures, metrics and a metric query.

A semantic model names a mart, its entities, its time and categorical
dimensions and its measures (an aggregation over a column expression).  A
metric is a measure, optionally filtered, or a ratio of two metrics; a bare
measure can be queried like a metric.  ``metric_query`` resolves metrics to
measures, builds ONE partially aggregated group-by per semantic model
involved, and full-outer-joins the per-model results on the requested
dimensions (null-safe), so metrics from different marts line up by key.

Dimensions may be qualified by an entity (``lead__channel``): the model's own,
or one that it reaches over entities that are unique on the other side, so
that no join multiplies rows.  Filters are conditions that all hold; in a
query over several models each condition goes to the models that have its
dimensions.

Averages divide an exact sum by a count (decimal, no double rounding) and
are returned as decimal(18,6); ratio metrics likewise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelworks.functions import exact_ratio
from funnelworks.plans.semantic_spec import SPEC, check_models, load_spec

AVG_TYPE = "decimal(18,6)"


@dataclass(frozen=True)
class Measure:
    name: str
    agg: str  # sum | average | count
    expr: str
    kind: str = ""  # type of the expression, if declared


@dataclass(frozen=True)
class Entity:
    name: str
    type: str  # primary | unique | foreign
    expr: str


@dataclass(frozen=True)
class SemanticModel:
    name: str
    table: str
    time_dimensions: Mapping[str, str]  # name -> grain
    dimensions: Sequence[str]
    measures: Sequence[Measure]
    default_time: str
    entities: Sequence[Entity] = ()
    filters: Mapping[str, Sequence[str]] = field(default_factory=dict)  # conditions that all hold
    types: Mapping[str, str] = field(default_factory=dict)

    def measure(self, name: str) -> Measure:
        for m in self.measures:
            if m.name == name:
                return m
        raise KeyError(name)


@dataclass(frozen=True)
class Metric:
    name: str
    measure: str | None = None
    filter: str | None = None
    numerator: str | None = None
    denominator: str | None = None


# Semantic models, measures and metrics of the governed layer.
SEMANTIC_MODELS = [
    SemanticModel(
        "gtm_channel_month",
        "mart_cac_ltv",
        {"month_date": "month"},
        ["channel"],
        [
            Measure("total_cost_usd", "sum", "total_cost_usd"),
            Measure("new_customers_won", "sum", "new_customers_won"),
            Measure("avg_estimated_ltv_usd", "average", "avg_estimated_ltv_usd"),
            Measure("cac_usd", "average", "cac_usd"),
            Measure("cac_ltv_ratio", "average", "cac_ltv_ratio"),
        ],
        "month_date",
        [Entity("channel_month", "primary", "cac_ltv_sk")],
    ),
    SemanticModel(
        "gtm_funnel",
        "mart_gtm_funnel",
        {"month_date": "month"},
        ["channel"],
        [
            Measure("leads_created", "sum", "leads_created"),
            Measure("demos_set", "sum", "demos_set"),
            Measure("demos_held", "sum", "demos_held"),
            Measure("closed_won", "sum", "closed_won"),
            Measure("closed_lost", "sum", "closed_lost"),
            Measure("avg_lead_to_demo_set_rate", "average", "lead_to_demo_set_rate"),
            Measure("avg_overall_conversion_rate", "average", "overall_conversion_rate"),
            Measure("avg_speed_to_first_contact_hours", "average", "avg_speed_to_first_contact_hours"),
            Measure("avg_days_in_funnel", "average", "avg_days_in_funnel"),
        ],
        "month_date",
        [Entity("funnel_channel_month", "primary", "gtm_funnel_sk")],
    ),
    SemanticModel(
        "lead_universe",
        "mart_leading_indicators",
        {"last_sales_activity_at": "day"},
        ["channel", "conversion_probability_tier", "is_converted", "is_disqualified", "has_olo_tool",
         "connected_with_decision_maker"],
        [
            Measure("lead_count", "count", "lead_sk"),
            Measure("converted_lead_count", "sum", "case when is_converted = true then 1 else 0 end"),
            Measure("avg_predicted_monthly_gmv_usd", "average", "predicted_monthly_gmv_usd"),
            Measure("avg_activity_density_score", "average", "activity_density_score"),
            Measure("avg_speed_to_first_contact_hours_lead", "average", "speed_to_first_contact_hours"),
        ],
        "last_sales_activity_at",
        [Entity("lead", "primary", "lead_sk")],
    ),
]

METRICS = [
    Metric("cac_usd", "cac_usd"),
    Metric("cac_ltv_ratio", "cac_ltv_ratio"),
    Metric("total_gtm_spend", "total_cost_usd"),
    Metric("new_customers_won", "new_customers_won"),
    Metric("avg_estimated_ltv", "avg_estimated_ltv_usd"),
    Metric("leads_created", "leads_created"),
    Metric("inbound_conversion_rate", "avg_overall_conversion_rate"),
    Metric("lead_to_demo_set_rate", "avg_lead_to_demo_set_rate"),
    # The specification gives the leads a measure of this name, too.
    Metric("avg_speed_to_first_contact", "gtm_funnel.avg_speed_to_first_contact_hours"),
    Metric("avg_days_in_funnel", "avg_days_in_funnel"),
    Metric("total_lead_count", "lead_count"),
    Metric("converted_lead_count", "converted_lead_count"),
    Metric("hot_lead_count", "lead_count", "conversion_probability_tier = 'hot'"),
    Metric("warm_lead_count", "lead_count", "conversion_probability_tier = 'warm'"),
    Metric("cold_lead_count", "lead_count", "conversion_probability_tier = 'cold'"),
    Metric("converted_customer_count", "lead_count", "conversion_probability_tier = 'converted'"),
    Metric("avg_prospect_gmv", "avg_predicted_monthly_gmv_usd"),
    Metric("pipeline_conversion_rate", numerator="converted_lead_count", denominator="total_lead_count"),
]


class MetricRegistry:
    """Models with the specification merged in, and metrics."""

    def __init__(self, models=SEMANTIC_MODELS, metrics=METRICS, spec=SPEC):
        self.models = {m.name: m for m in load_spec(models, spec, Measure)}
        self.metrics = {m.name: m for m in metrics}

    def check(self, tables: Mapping[str, DataFrame]) -> None:
        """Raise unless the marts resolve all that the models declare."""
        check_models(list(self.models.values()), tables)

    def model_of_measure(self, measure: str) -> SemanticModel:
        """The model of a measure: ``name``, or ``model.name`` where several have it."""
        if "." in measure:
            model, _, name = measure.partition(".")
            if model in self.models:
                self.models[model].measure(name)
                return self.models[model]
        found = [m for m in self.models.values() if any(x.name == measure for x in m.measures)]
        if not found:
            raise KeyError(f"unknown metric or measure {measure}")
        if len(found) > 1:
            raise KeyError(f"measure {measure} is in {', '.join(m.name for m in found)}: name it model.{measure}")
        return found[0]

    def metric(self, name: str) -> Metric:
        """A declared metric, or a bare measure as one."""
        if name in self.metrics:
            return self.metrics[name]
        self.model_of_measure(name)
        return Metric(name, name)

    def base_metrics(self, name: str) -> list[Metric]:
        metric = self.metric(name)
        if metric.measure is not None:
            return [metric]
        return self.base_metrics(metric.numerator) + self.base_metrics(metric.denominator)

    def entity_path(self, model: SemanticModel, entity: str) -> list[tuple[Entity, SemanticModel, Entity]]:
        """Joins (own key, other model, its key) from a model to the one whose
        primary entity it is; empty if that is the model itself.  Only steps
        to a key that is unique on the other side are taken: any other would
        multiply the model's rows, and so its measures."""
        reached: dict[str, list] = {model.name: []}
        queue, multiplied = [model], None
        while queue:
            here = queue.pop(0)
            if any(e.name == entity and e.type in ("primary", "unique") for e in here.entities):
                return reached[here.name]
            for own in here.entities:
                for other in self.models.values():
                    for key in other.entities:
                        if key.name != own.name or other.name in reached:
                            continue
                        if key.type == "foreign":
                            multiplied = f"{here.name} to {other.name} over {key.name}"
                            continue
                        reached[other.name] = [*reached[here.name], (own, other, key)]
                        queue.append(other)
        if multiplied:
            raise ValueError(f"{entity} is reached only by a join that multiplies rows: {multiplied}")
        raise KeyError(f"no path from {model.name} to entity {entity}")


def _time(grain: str | None, column: Column) -> Column:
    return F.date_trunc(grain, column).cast("date") if grain else column


def _dimension(reg: MetricRegistry, model: SemanticModel, dim: str, tables: Mapping[str, DataFrame], src: DataFrame):
    """(frame with the dimension as a column of that name, which the frame
    keeps beside its own).  ``dim``: 'channel', a time dimension with grain
    ('month_date__month', 'metric_time__month'), either with an entity in
    front ('lead__channel')."""
    parts = dim.split("__")
    known = {e.name for m in reg.models.values() for e in m.entities}
    holder, joins = model, []
    if len(parts) > 1 and parts[0] in known:
        joins, parts = reg.entity_path(model, parts[0]), parts[1:]
        holder = joins[-1][1] if joins else model
    base, grain = parts[0], parts[1] if len(parts) > 1 else None
    if base == "metric_time":  # each model's default aggregation time dimension
        base = holder.default_time
    if base not in holder.time_dimensions and (grain or base not in holder.dimensions):
        raise KeyError(f"{holder.name} has no {'time dimension' if grain else 'dimension'} {base}")
    if not joins:
        return src.withColumn(dim, _time(grain, F.col(base)))
    key = joins[0][0].expr
    reachable = tables[joins[0][1].table]
    at = joins[0][2].expr
    frame = reachable.select(F.expr(at).alias("__key"), *[F.expr(j[0].expr).alias(f"__next{i}") for i, j in enumerate(joins[1:2])],
                             *([_time(grain, F.col(base)).alias("__dim")] if len(joins) == 1 else []))
    for i, (_, other, to) in enumerate(joins[1:], 1):
        last = i == len(joins) - 1
        extra = [_time(grain, F.col(base)).alias("__dim")] if last else [F.expr(joins[i + 1][0].expr).alias(f"__next{i}")]
        right = tables[other.table].select(F.expr(to.expr).alias("__to"), *extra)
        frame = frame.join(right, frame[f"__next{i - 1}"] == right["__to"], "left").drop(f"__next{i - 1}", "__to")
    joined = src.withColumn("__own", F.expr(key)).join(frame, F.col("__own") == F.col("__key"), "left")
    return joined.withColumn(dim, F.col("__dim")).drop("__own", "__key", "__dim")


def _resolves(frame: DataFrame, condition: str) -> bool:
    try:
        _ = frame.where(F.expr(condition)).schema
    except AnalysisException as error:
        if (error.getCondition() or "").startswith("UNRESOLVED_COLUMN"):
            return False
        raise
    return True


def conditions(reg: MetricRegistry, where: str | Sequence[str] | None) -> list[tuple[str, list[str]]]:
    """(filter, its conditions): each entry is the name of a declared filter,
    whose conditions are known one by one, or a SQL predicate as a whole."""
    named = {name: list(parts) for m in reg.models.values() for name, parts in m.filters.items()}
    entries = [where] if isinstance(where, str) else list(where or ())
    return [(entry, named.get(entry, [entry])) for entry in entries]


def _filtered(model: SemanticModel, src: DataFrame, filters: list[tuple[str, list[str]]], alone: bool) -> DataFrame:
    """Rows of a model that meet the conditions it has the dimensions of.  A
    filter of which none applies, and in a query of one model any condition
    that doesn't, raises."""
    dims = src.select(*dict.fromkeys([*model.dimensions, *model.time_dimensions])).schema
    dims = src.sparkSession.createDataFrame([], dims)  # other columns of the mart stay out of reach
    for name, parts in filters:
        own = [p for p in parts if _resolves(dims, p)]
        if not own or (alone and len(own) < len(parts)):
            missing = next(p for p in parts if p not in own)
            raise ValueError(f"filter {name}: {model.name} has not the dimensions of: {missing}")
        for p in own:
            src = src.where(F.expr(p))
    return src


def _measure_aggs(measure: Measure, filt: str | None, out: str) -> list[Column]:
    """Aggregations producing a measure; averages as (sum, count) pairs."""
    value = F.expr(measure.expr)
    if filt:
        value = F.when(F.expr(filt), value)
    if measure.agg == "sum":
        return [F.sum(value).alias(out)]
    if measure.agg == "count":
        return [F.count(value).alias(out)]
    if measure.agg == "average":
        return [F.sum(value).alias(f"{out}__sum"), F.count(value).alias(f"{out}__n")]
    raise ValueError(measure.agg)


def metric_query(
    tables: Mapping[str, DataFrame],
    metrics: Sequence[str],
    group_by: Sequence[str] = (),
    where: str | Sequence[str] | None = None,
    registry: MetricRegistry | None = None,
) -> DataFrame:
    """Metrics, or bare measures, grouped by dimensions.  ``tables`` maps mart
    names to frames; ``where`` is a SQL predicate over dimensions, the name of
    a declared filter, or several of either that all hold, applied before
    aggregation.  Over several models each condition applies to the models
    that declare its dimensions; a filter that says nothing about one of the
    models raises an error that names it."""
    reg = registry or MetricRegistry()
    per_model: dict[str, list[tuple[Metric, str]]] = {}
    for name in metrics:
        for base in reg.base_metrics(name):
            model = reg.model_of_measure(base.measure)
            entry = (base, f"_m_{base.name}".replace(".", "__"))
            if entry not in per_model.setdefault(model.name, []):
                per_model[model.name].append(entry)
    frames = []
    filters = conditions(reg, where)
    for model_name, items in per_model.items():
        model = reg.models[model_name]
        src = _filtered(model, tables[model.table], filters, len(per_model) == 1)
        for d in group_by:
            src = _dimension(reg, model, d, tables, src)
        own = [(metric, model.measure(metric.measure.rpartition(".")[2]), out) for metric, out in items]
        aggs = [a for metric, measure, out in own for a in _measure_aggs(measure, metric.filter, out)]
        grouped = src.groupBy(*group_by).agg(*aggs) if group_by else src.agg(*aggs)
        cols = list(group_by)
        for _, measure, out in own:
            if measure.agg == "average":
                cols.append(exact_ratio(f"{out}__sum", f"{out}__n").cast(AVG_TYPE).alias(out))
            else:
                cols.append(F.col(out))
        frames.append(grouped.select(*cols))
    if len(frames) == 1:
        result = frames[0]
    else:
        # Per-model results are small (one row per dimension value); join them
        # on the shared dimensions, null-safe, keeping keys seen by any model.
        def outer(a: DataFrame, b: DataFrame) -> DataFrame:
            if not group_by:
                return a.crossJoin(b)
            b2 = b.select(*[F.col(d).alias(f"__r_{d}") for d in group_by], *[c for c in b.columns if c not in group_by])
            cond = reduce(lambda x, y: x & y, [F.col(d).eqNullSafe(F.col(f"__r_{d}")) for d in group_by])
            j = a.join(b2, cond, "full_outer")
            keys = [F.coalesce(F.col(d), F.col(f"__r_{d}")).alias(d) for d in group_by]
            return j.select(*keys, *[c for c in j.columns if c not in group_by and not c.startswith("__r_")])

        result = reduce(outer, frames)
    out_cols = list(group_by)
    for name in metrics:
        metric = reg.metric(name)
        if metric.measure is not None:
            out_cols.append(F.col(f"_m_{name}".replace(".", "__")).alias(name.replace(".", "__")))
        else:
            out_cols.append(
                exact_ratio(f"_m_{metric.numerator}", f"_m_{metric.denominator}").cast(AVG_TYPE).alias(name)
            )
    return result.select(*out_cols)


def metrics_by_filter(
    tables: Mapping[str, DataFrame],
    model: str,
    metrics: Sequence[str],
    group_by: Sequence[str],
    registry: MetricRegistry | None = None,
) -> DataFrame:
    """Every declared filter of a model beside the others, in one pass over
    its mart: a column ``filter__metric`` for each filter and metric."""
    reg = registry or MetricRegistry()
    made = []
    for name, parts in reg.models[model].filters.items():
        for metric in metrics:
            base = reg.metric(metric)
            own = [*parts, *([base.filter] if base.filter else [])]
            made.append(Metric(f"{name}__{metric}", base.measure, " and ".join(f"({p})" for p in own)))
    inner = MetricRegistry(list(reg.models.values()), [*reg.metrics.values(), *made], ())
    return metric_query(tables, [m.name for m in made], group_by, registry=inner)


# Default grouping per semantic model for the single-metric queries.
DEFAULT_GROUP_BY = {
    "gtm_channel_month": ["channel", "month_date__month"],
    "gtm_funnel": ["channel", "month_date__month"],
    "lead_universe": ["channel"],
}


def default_group_by(metric: str, registry: MetricRegistry | None = None) -> list[str]:
    reg = registry or MetricRegistry()
    base = reg.base_metrics(metric)[0]
    return DEFAULT_GROUP_BY[reg.model_of_measure(base.measure).name]


# ---- verified queries ------------------------------------------------------
WINDOW = ("2024-01-01", "2024-06-01")


def vq_outbound_cac(cac: DataFrame) -> DataFrame:
    return cac.filter((F.col("channel") == "outbound") & F.col("month_date").between(*WINDOW)).select(
        "month_date", "cac_usd", "new_customers_won", "cac_ltv_ratio"
    ).orderBy("month_date")


def vq_funnel_rates(funnel: DataFrame) -> DataFrame:
    return funnel.filter(F.col("month_date").between(*WINDOW)).select(
        "channel", "month_date", "leads_created", "lead_to_demo_set_rate", "demo_to_close_rate", "overall_conversion_rate"
    ).orderBy("channel", "month_date")


def _avg0(col: str, precision: int = 14) -> Column:
    return F.round(exact_ratio(F.sum(col), F.count(col)), 0).cast(f"decimal({precision},0)")


def vq_lead_tier_counts(leads: DataFrame) -> DataFrame:
    dq = F.col("is_disqualified")
    return (
        leads.filter((dq == F.lit(False)) | dq.isNull())
        .groupBy("channel", "conversion_probability_tier")
        .agg(F.count(F.lit(1)).alias("lead_count"), _avg0("predicted_monthly_gmv_usd").alias("avg_gmv_usd"))
        .orderBy("channel", "conversion_probability_tier")
    )


def vq_cac_ltv_trend(cac: DataFrame) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy("channel").orderBy("month_date")
    prev = F.lag("cac_ltv_ratio").over(w)
    return cac.select(
        "channel",
        "month_date",
        "cac_usd",
        "avg_estimated_ltv_usd",
        "cac_ltv_ratio",
        prev.alias("prev_month_ratio"),
        (F.col("cac_ltv_ratio") - prev).cast("decimal(15,4)").alias("mom_change"),
    ).orderBy("channel", "month_date")


def vq_hot_pipeline(leads: DataFrame) -> DataFrame:
    return (
        leads.filter(F.col("conversion_probability_tier") == "hot")
        .groupBy("channel")
        .agg(
            F.count(F.lit(1)).alias("hot_lead_count"),
            _avg0("predicted_monthly_gmv_usd").alias("avg_gmv_usd"),
            _avg0("estimated_annual_ltv_usd").alias("avg_ltv_usd"),
            F.round(F.sum("estimated_annual_ltv_usd"), 0).cast("decimal(20,0)").alias("total_pipeline_ltv_usd"),
        )
    )


def vq_speed_impact(funnel: DataFrame) -> DataFrame:
    return funnel.filter((F.col("channel") == "inbound") & F.col("month_date").between(*WINDOW)).select(
        "month_date", "channel", "avg_speed_to_first_contact_hours", "overall_conversion_rate", "lead_to_demo_set_rate"
    ).orderBy("month_date")
