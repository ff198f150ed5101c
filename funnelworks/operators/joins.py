"""Join helpers for skewed or sparse keys.

``left_join_spread_nulls``: in a shuffled equi-join every row whose key is
null hashes to the same partition, although it can never match.  When most
left keys are null (unconverted leads have no opportunity id) that single
task would receive most of the table.  The helper joins on a two-part key —
(key or a per-row hash, key-is-null flag) — so null-key rows spread over all
partitions and still never match, in a single scan of the left side.  Hot
non-null keys are left to AQE's skew-join splitting (enabled in session conf).

``left_join_keyed``: for a left side that is a stored table.  Only rows with a
key are joined; the others get null columns and are never shuffled, at the cost
of a second scan.  Over a computed left side that would compute it twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_spread_nulls(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, salt_cols: list[str] | None = None
) -> DataFrame:
    """left ⟕ right on left[left_key] = right[right_key]; all left columns,
    then all right columns; null left keys never match.  ``salt_cols`` (a
    row identifier, by default every left column) spreads the null keys."""
    lk = F.col(left_key)
    salt = F.xxhash64(*[F.col(c) for c in (salt_cols or left.columns)]).cast("string")
    l2 = left.withColumn("__jk", F.coalesce(lk, salt)).withColumn("__jn", lk.isNull())
    r2 = right.withColumn("__rk", F.col(right_key)).withColumn("__rn", F.lit(False))
    joined = l2.join(r2, (l2["__jk"] == r2["__rk"]) & (l2["__jn"] == r2["__rn"]), "left")
    return joined.drop("__jk", "__jn", "__rk", "__rn")


def left_join_keyed(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """The rows and columns of ``left_join_spread_nulls``; null left keys don't take part in the join."""
    keyed = left.filter(F.col(left_key).isNotNull())
    joined = keyed.join(right, keyed[left_key] == right[right_key], "left")
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields]
    return joined.union(left.filter(F.col(left_key).isNull()).select("*", *nulls))
