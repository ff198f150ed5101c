"""Declared output contracts.

A contract is an ordered list of (name, type).  ``enforce_contract`` checks a
model's DataFrame against it at plan time (no job runs): missing, extra or
retyped columns raise ``ContractError``; on success the columns come back in
contract order.  ``check_schema_unchanged`` is the guard incremental targets
use before appending to an existing table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
import re

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

_SIMPLE = {
    "string": StringType(),
    "date": DateType(),
    "boolean": BooleanType(),
    "int": IntegerType(),
    "bigint": LongType(),
    "double": DoubleType(),
    "timestamp_ntz": TimestampNTZType(),
}


def type_of(name: str) -> DataType:
    m = re.fullmatch(r"decimal\((\d+),(\d+)\)", name.replace(" ", ""))
    return DecimalType(int(m.group(1)), int(m.group(2))) if m else _SIMPLE[name]


class ContractError(ValueError):
    pass


def contract(*fields: tuple[str, str]) -> StructType:
    """contract(("lead_sk", "string"), ("month_date", "date"), ...)"""
    return StructType([StructField(n, type_of(t), True) for n, t in fields])


def _same_type(a: DataType, b: DataType) -> bool:
    return a.simpleString() == b.simpleString()


def schema_diff(actual: StructType, declared: StructType) -> list[str]:
    problems = []
    have = {f.name: f.dataType for f in actual.fields}
    want = {f.name: f.dataType for f in declared.fields}
    for name in want:
        if name not in have:
            problems.append(f"missing column {name}")
        elif not _same_type(have[name], want[name]):
            problems.append(f"{name}: {have[name].simpleString()} != declared {want[name].simpleString()}")
    for name in have:
        if name not in want:
            problems.append(f"extra column {name}")
    return problems


def enforce_contract(df: DataFrame, declared: StructType, cast: bool = False) -> DataFrame:
    """Return df with exactly the declared columns in declared order.

    With ``cast=True`` the columns are first cast to the declared types (the
    "final cast projection" of a model); a missing or extra column still
    raises.  Casting is ANSI: a value that does not fit raises at run time.
    """
    if cast:
        names = set(df.columns)
        missing = [f.name for f in declared.fields if f.name not in names]
        extra = [n for n in df.columns if n not in {f.name for f in declared.fields}]
        if missing or extra:
            raise ContractError(f"contract violated: missing={missing} extra={extra}")
        df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in declared.fields])
    problems = schema_diff(df.schema, declared)
    if problems:
        raise ContractError("contract violated: " + "; ".join(problems))
    return df.select(*[f.name for f in declared.fields])


def check_schema_unchanged(new: StructType, existing: StructType) -> None:
    """Fail (rather than evolve) when an incremental batch's schema differs
    from the stored target's, including column order."""
    problems = schema_diff(new, existing)
    if not problems and [f.name for f in new.fields] != [f.name for f in existing.fields]:
        problems = ["column order changed"]
    if problems:
        raise ContractError("schema change on incremental target: " + "; ".join(problems))
