"""Non-blocking dead-letter audit as a one-scan rule engine.

A rule is (category, detail, predicate, diagnostic).  Instead of one filtered
scan per rule glued together with UNION ALL, every rule is evaluated on the
same row: the matching rules become an array of structs that is exploded, so a
source is read once however many rules there are.  A null predicate does not
match (same as a WHERE clause).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelworks.functions._col import as_col
from funnelworks.functions.keys import surrogate_key


@dataclass(frozen=True)
class AuditRule:
    category: str
    detail: str
    predicate: Column
    diagnostic: Column


def _finding(rule: AuditRule) -> Column:
    return F.when(
        rule.predicate,
        F.struct(
            F.lit(rule.category).alias("audit_category"),
            F.lit(rule.detail).alias("audit_detail"),
            rule.diagnostic.cast("string").alias("diagnostic_info"),
        ),
    )


def findings_array(rules: Sequence[AuditRule]) -> Column:
    """Array of the findings that hold for the current row (possibly empty)."""
    return F.array_compact(F.array(*[_finding(r) for r in rules]))


def audit(
    df: DataFrame,
    record_key: Column | str,
    rules: Sequence[AuditRule],
    source_table: str,
    carry: Sequence[Column] = (),
) -> DataFrame:
    """One row per (record, matching rule): audit_sk, source_table,
    record_key, audit_category, audit_detail, diagnostic_info, plus any
    ``carry`` columns taken from the same source row."""
    exploded = df.select(
        as_col(record_key).cast("string").alias("record_key"),
        *carry,
        F.explode(findings_array(rules)).alias("f"),
    )
    return exploded.select(
        surrogate_key("record_key", "f.audit_category").alias("audit_sk"),
        F.lit(source_table).alias("source_table"),
        "record_key",
        F.col("f.audit_category").alias("audit_category"),
        F.col("f.audit_detail").alias("audit_detail"),
        F.col("f.diagnostic_info").alias("diagnostic_info"),
        *[c for c in exploded.columns if c not in ("record_key", "f")],
    )
