"""Data tests as DataFrame operators.

Each generic test returns the violating rows (a passing test returns an
empty frame), like a warehouse test query.  ``run_tests`` evaluates a list of
declared tests and returns one summary row per test with its failure count.
All tests of a table share ONE scan and one aggregate: every row gives a
(test, key) entry for each test it says something about (the values of unique
columns; values that aren't accepted; an empty key for a row that fails),
counted by test and key with partial sums before the shuffle.  Foreign keys
need one anti join each.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelworks.functions import exact_ratio


# ---- generic tests: violating rows -------------------------------------------
def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def unique(df: DataFrame, col: str) -> DataFrame:
    """Values occurring more than once (nulls ignored), with their count."""
    return (
        df.filter(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def _where(df: DataFrame, where: str | None) -> DataFrame:
    return df.filter(F.expr(where)) if where else df


def _not_accepted(col: str, values: Sequence) -> Column:
    return ~F.col(col).isin(*values)


def accepted_values(df: DataFrame, col: str, values: Sequence, where: str | None = None) -> DataFrame:
    """Distinct values outside the accepted list (nulls pass), with counts."""
    return (
        _where(df, where)
        .filter(_not_accepted(col, values))
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def relationships(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child rows whose non-null key has no parent row (anti join)."""
    keys = parent.select(F.col(parent_col).alias("__pk"))
    c = child.filter(F.col(col).isNotNull())
    return c.join(keys, c[col] == keys["__pk"], "left_anti")


def expression_is_true(df: DataFrame, expression: str, where: str | None = None) -> DataFrame:
    """Rows where the expression is false (null results pass)."""
    return _where(df, where).filter(~F.expr(expression))


def _in_range(col: str, lo, hi, inclusive: bool = True) -> Column:
    c = F.col(col)
    return (c >= lo) & (c <= hi) if inclusive else (c > lo) & (c < hi)


def accepted_range(df: DataFrame, col: str, lo, hi, inclusive: bool = True, where: str | None = None) -> DataFrame:
    return _where(df, where).filter(~_in_range(col, lo, hi, inclusive))


def not_null_proportion(df: DataFrame, col: str, at_least: float) -> DataFrame:
    """One row with the measured proportion when it is below the bound."""
    from decimal import Decimal

    counts = df.agg(F.count(col).alias("__nn"), F.count(F.lit(1)).alias("__n"))
    bound = F.lit(Decimal(str(at_least))) * F.col("__n")
    return counts.filter(F.col("__nn") < bound).select(
        exact_ratio("__nn", "__n").cast("decimal(10,6)").alias("not_null_proportion")
    )


# ---- declared test suites ---------------------------------------------------------
@dataclass(frozen=True)
class TestSpec:
    model: str
    kind: str  # not_null | unique | accepted_values | expression_is_true | accepted_range | not_null_proportion | relationships
    column: str
    args: Mapping = field(default_factory=dict)
    where: str | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}__{self.model}__{self.column}"


ROW_LEVEL = {"not_null", "expression_is_true", "accepted_range"}


def _row_failure(spec: TestSpec) -> Column:
    """Boolean: this row violates the (row-level) test."""
    if spec.kind == "not_null":
        bad = F.col(spec.column).isNull()
    elif spec.kind == "expression_is_true":
        bad = ~F.expr(f"{spec.column} {spec.args['expression']}")
    else:
        bad = ~_in_range(spec.column, spec.args["min_value"], spec.args["max_value"], spec.args.get("inclusive", True))
    if spec.where:
        bad = F.expr(spec.where) & bad
    return F.coalesce(bad, F.lit(False))


def _summary_row(spec: TestSpec, failures: Column) -> list[Column]:
    return [
        F.lit(spec.name).alias("test_name"),
        F.lit(spec.model).alias("model"),
        F.lit(spec.column).alias("column_name"),
        F.lit(spec.kind).alias("test_kind"),
        failures.cast("bigint").alias("failures"),
    ]


def _entry(spec: TestSpec) -> Column:
    """What a row adds to a test: a key, or null for nothing."""
    value = F.col(spec.column).cast("string")
    if spec.kind in ROW_LEVEL:
        return F.when(_row_failure(spec), F.lit(""))
    if spec.kind == "unique":
        return value
    if spec.kind == "not_null_proportion":
        return F.when(value.isNull(), F.lit("null")).otherwise(F.lit("set"))
    bad = _not_accepted(spec.column, spec.args["values"])
    return F.when(F.expr(spec.where) & bad if spec.where else bad, value)


def _failures(spec: TestSpec, test: Column, key: Column, n: Column) -> Column:
    """Failures of a test from its counted keys."""
    if spec.kind == "unique":
        return F.count_if(test & (n > 1))
    if spec.kind == "accepted_values":
        return F.count_if(test)
    total = F.coalesce(F.sum(F.when(test, n)), F.lit(0))
    if spec.kind == "not_null_proportion":
        from decimal import Decimal

        found = F.coalesce(F.sum(F.when(test & (key == "set"), n)), F.lit(0))
        return (found < F.lit(Decimal(str(spec.args["at_least"]))) * total).cast("int")
    return total


def _table_tests(df: DataFrame, specs: Sequence[TestSpec]) -> DataFrame:
    entries = F.array(*[F.struct(F.lit(i).alias("test"), _entry(s).alias("key")) for i, s in enumerate(specs)])
    told = df.select(F.explode(F.filter(entries, lambda e: e["key"].isNotNull())).alias("e")).select("e.test", "e.key")
    counted = told.groupBy("test", "key").agg(F.count(F.lit(1)).alias("n"))
    own = [_failures(s, F.col("test") == i, F.col("key"), F.col("n")).alias(f"f{i}") for i, s in enumerate(specs)]
    summary = F.array(*[F.struct(*_summary_row(s, F.col(f"f{i}"))) for i, s in enumerate(specs)])
    return counted.agg(*own).select(F.explode(summary).alias("t")).select("t.*")


def run_tests(tables: Mapping[str, DataFrame], specs: Sequence[TestSpec]) -> DataFrame:
    """Summary (test_name, model, column_name, test_kind, failures) of the
    declared tests; failures = rows the test query would return.  Each table
    is read once, and once more on either side of a foreign key."""
    parts: list[DataFrame] = []
    by_model: dict[str, list[TestSpec]] = {}
    for spec in specs:
        if spec.kind == "relationships":
            bad = relationships(tables[spec.model], spec.column, tables[spec.args["to"]], spec.args["field"])
            parts.append(bad.agg(*_summary_row(spec, F.count(F.lit(1)))))
        else:
            by_model.setdefault(spec.model, []).append(spec)
    parts += [_table_tests(tables[model], own) for model, own in by_model.items()]
    return reduce(DataFrame.unionByName, parts)


def run_invariants(found: Mapping[str, tuple[str, DataFrame]]) -> DataFrame:
    """The same summary for singular tests: name -> (model, violating rows)."""
    parts = [
        bad.agg(*_summary_row(TestSpec(model, "singular", name), F.count(F.lit(1)))) for name, (model, bad) in found.items()
    ]
    return reduce(DataFrame.unionByName, parts)
