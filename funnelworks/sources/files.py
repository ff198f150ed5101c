"""File sources for real exports: CSV seeds and Parquet/CSV dumps of the CRM
tables, always read with the fixed all-text schema (no inference)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from funnelworks.sources.schemas import RAW_ADVERTISING, RAW_LEADS, RAW_OPPORTUNITIES, RAW_SALARY


def read_text_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header row, all columns text.  Columns are found by header
    name, in any order and case; a missing one raises, further ones are left
    out.  Quoted fields may hold commas, doubled quotes and line breaks; a row
    with another number of fields than the header raises."""
    raw = (
        spark.read.option("header", True)
        .option("mode", "FAILFAST")
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )
    found = {c.strip().lower(): c for c in raw.columns}
    missing = [f.name for f in schema.fields if f.name.lower() not in found]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)} in the header")
    return raw.select(*(F.col(f"`{found[f.name.lower()]}`").alias(f.name) for f in schema.fields))


def read_advertising_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_text_csv(spark, path, RAW_ADVERTISING)


def read_salary_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_text_csv(spark, path, RAW_SALARY)


def read_leads(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_text_csv(spark, path, RAW_LEADS) if fmt == "csv" else spark.read.schema(RAW_LEADS).parquet(path)


def read_opportunities(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_text_csv(spark, path, RAW_OPPORTUNITIES) if fmt == "csv" else spark.read.schema(RAW_OPPORTUNITIES).parquet(path)
