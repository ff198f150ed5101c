"""Keyed incremental refresh of mart tables stored as Parquet.

Two delete+insert strategies, both safe to re-run after a failure:

* ``refresh_partitions`` — unique key = the partition columns (month_date,
  channel): exactly the key values present in the batch are replaced.
* ``refresh_by_key`` — unique key = one column (lead_sk): the table is split
  into buckets by a hash of the key, and the buckets that the batch touches
  become old ⟕anti batch-keys ∪ batch.

Both write into a NEW version folder (a path is never overwritten while it is
being read) and then commit it: readers take the newest commit, so a job
killed half-way, also in a full refresh, leaves the table as it was.
``expire_versions`` deletes what no recent commit lists.

Batch selection: ``lookback_filter`` (trailing N months from an explicit
``as_of`` date — never the wall clock) and ``high_watermark`` (rows at or
after the newest value already stored; a null-valued row never passes, which
is the documented gap of this strategy — ``include_nulls`` re-admits them).
Without a stored target (first run) or with ``full_refresh`` no filter is
applied.  A batch whose schema differs from the stored table fails.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from funnelworks.operators.contracts import check_schema_unchanged
from funnelworks.session import scratch_path


# ---- batch selection ------------------------------------------------------------
def lookback_start(as_of: str, months: int) -> Column:
    """First day of the month ``months`` before as_of's month."""
    return F.add_months(F.trunc(F.lit(as_of).cast("date"), "month"), -months)


def lookback_filter(df: DataFrame, month_col: Column | str, as_of: str, months: int) -> DataFrame:
    col = F.col(month_col) if isinstance(month_col, str) else month_col
    return df.filter(col >= lookback_start(as_of, months))


def high_watermark(target: DataFrame, col: str) -> Column:
    """max(col) of the stored target as a scalar subquery (evaluated once,
    then a literal to the filter — Parquet min/max pruning applies)."""
    return target.filter(F.col(col).isNotNull()).agg(F.max(col)).scalar()


def watermark_filter(df: DataFrame, target: DataFrame, col: str, include_nulls: bool = False) -> DataFrame:
    cond = F.col(col) >= high_watermark(target, col)
    if include_nulls:
        cond = cond | F.col(col).isNull()
    return df.filter(cond)


# ---- months that a refresh has to compute again -------------------------------------
def changed_months(before: DataFrame, after: DataFrame, month: str = "month_date") -> DataFrame:
    """Months whose rows differ between two states of one month-grain table."""
    return before.exceptAll(after).union(after.exceptAll(before)).select(month).distinct()


def with_dependents(months: DataFrame, changed: DataFrame, month: str = "month_date") -> DataFrame:
    """Of ``months`` (those that exist now) the changed ones and each one whose
    predecessor changed or vanished, so whose ``lag`` differs.  Both frames hold
    months only, so the windows run over a calendar's worth of rows."""
    marked = (
        months.select(month, F.lit(1).alias("now"), F.lit(0).alias("hit"))
        .unionByName(changed.select(month, F.lit(0).alias("now"), F.lit(1).alias("hit")))
        .groupBy(month)
        .agg(F.max("now").alias("now"), F.max("hit").alias("hit"))
    )
    # a month that exists now closes the run of those that vanished before it
    earlier = Window.orderBy(month).rowsBetween(Window.unboundedPreceding, -1)
    runs = marked.withColumn("run", F.coalesce(F.sum("now").over(earlier), F.lit(0)))
    in_run = runs.withColumn("run_hit", F.max("hit").over(Window.partitionBy("run"))).filter(F.col("now") == 1)
    before = F.lag("hit").over(Window.orderBy(month))
    return in_run.withColumn("before", before).filter((F.col("run_hit") == 1) | (F.col("before") == 1)).select(month)


# ---- versioned folders ------------------------------------------------------------
# A table is a folder of versions and of commits.  A version holds the parts
# (partition folders) that one run wrote; a commit lists, for its version, the
# folder of every part of the table, in one file written last.  A run that dies
# before that leaves the table as it was; readers of an older commit keep it.
_VERSION = re.compile(r"/(version-\d+)/(.+)/[^/]+$")


def _commits(spark: SparkSession, base: str) -> DataFrame | None:
    try:
        return spark.read.schema("version int, folder string").parquet(os.path.join(base, "_commits"))
    except AnalysisException:  # no such path
        return None


def _newest(spark: SparkSession, base: str) -> tuple[int, list[str]]:
    """Newest version (0 if there is none) and the folders of its parts."""
    commits = _commits(spark, base)
    if commits is None:
        return 0, []
    newest = commits.agg(F.max("version")).first()[0]
    if newest is None:
        return 0, []
    rows = commits.where((F.col("version") == newest) & F.col("folder").isNotNull()).orderBy("folder").collect()  # a row a part
    return newest, [r.folder for r in rows]


def table_exists(spark: SparkSession, base: str) -> bool:
    return _newest(spark, base)[0] > 0


def _read(spark: SparkSession, base: str, folders: list[str], schema: StructType | None) -> DataFrame | None:
    by_version: dict[str, list[str]] = {}
    for f in folders:
        by_version.setdefault(f.split("/")[0], []).append(os.path.join(base, f))
    frames = []
    for version, paths in by_version.items():
        reader = spark.read.schema(schema) if schema is not None else spark.read
        frames.append(reader.option("basePath", os.path.join(base, version)).parquet(*paths))
    if not frames:
        return None if schema is None else spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, frames)


def read_current(spark: SparkSession, base: str, schema: StructType | None = None) -> DataFrame | None:
    """The newest committed state, without the bucket column of a keyed table."""
    version, folders = _newest(spark, base)
    if not version:
        return None
    found = _read(spark, base, folders, schema)
    return found if found is None else found.drop(*[c for c in found.columns if c.startswith(_BUCKET)])


def _write_version(spark: SparkSession, rows: DataFrame, base: str, parts: list[str], old: list[str], version: int) -> None:
    """Write parts as a new version, then commit them and the other old parts."""
    target = os.path.join(base, f"version-{version:08d}")
    # what an uncommitted attempt left there is replaced; committed versions are never rewritten
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*parts).parquet(target)
    try:
        files = spark.read.parquet(target).select("_metadata.file_path").distinct().collect()  # some files a part
    except AnalysisException:  # nothing was written
        files = []
    own = {unquote(m[2]): f"{m[1]}/{unquote(m[2])}" for f in files if (m := _VERSION.search(f.file_path))}
    folders = [*own.values(), *[f for f in old if f.partition("/")[2] not in own]]
    rows = [(version, None), *[(version, f) for f in folders]]
    commit = spark.createDataFrame(rows, "version int, folder string").coalesce(1)
    commit.write.mode("append").parquet(os.path.join(base, "_commits"))


def expire_versions(spark: SparkSession, base: str, keep: int = 2) -> list[str]:
    """Delete the folders that none of the newest ``keep`` commits lists, and
    return the names of those deleted.  Commits stay; reading an expired one fails."""
    commits = _commits(spark, base)
    if commits is None:
        return []
    newest = commits.select("version").distinct().orderBy(F.desc("version")).limit(max(keep, 1))
    live = commits.join(F.broadcast(newest), "version", "left_semi").select("folder").distinct()  # ``keep`` rows
    gone = [r.folder for r in commits.where(F.col("folder").isNotNull()).select("folder").distinct().join(live, "folder", "left_anti").collect()]
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = {folder: jvm.org.apache.hadoop.fs.Path(os.path.join(base, folder)) for folder in gone}
    return sorted(folder for folder, path in paths.items() if path.getFileSystem(conf).delete(path, True))


# ---- strategies -------------------------------------------------------------------
_BUCKET = "bucket_of_"
#: Buckets of a keyed table; a refresh rewrites those that the batch touches.
BUCKETS = 64


def refresh_partitions(
    spark: SparkSession,
    batch: DataFrame,
    path: str,
    keys: list[str],
    full_refresh: bool = False,
    covers: Callable[[str], bool] | None = None,
) -> DataFrame:
    """delete+insert on the partition key columns; returns the stored table
    in the batch's column order and types.  Partitions that the batch doesn't
    hold keep their files; a full refresh replaces all of them by one commit.
    ``covers`` tells for which values of the first key (as text) the batch is
    the whole truth: stored partitions of those that it doesn't hold go."""
    schema = batch.schema
    version, old = _newest(spark, path)
    if full_refresh or not version:
        old = []
    elif old:
        stored = {f.name: f for f in _read(spark, path, old[:1], None).schema}
        stored |= {k: schema[k] for k in keys if k in stored}  # folder names tell no types
        check_schema_unchanged(schema, StructType([stored[c] for c in batch.columns if c in stored]))
    if covers is not None:
        old = [f for f in old if not covers(f.split("/")[1].partition("=")[2])]
    _write_version(spark, batch, path, keys, old, version + 1)
    return read_current(spark, path, schema).select(*schema.fieldNames())


def refresh_by_key(
    spark: SparkSession,
    batch: DataFrame,
    base: str,
    key: str,
    full_refresh: bool = False,
    buckets: int = BUCKETS,
) -> DataFrame:
    """delete+insert on one key column.  The table is split by a hash of the
    key; only buckets with a key of the batch are read and written again.  The
    batch is stored first, so its source is read once."""
    schema, name = batch.schema, f"{_BUCKET}{buckets}"
    version, old = _newest(spark, base)
    if full_refresh:
        old = []
    if old and not old[0].split("/")[1].startswith(f"{name}="):
        raise ValueError(f"{base} is stored as {old[0].split('/')[1]}, not in {buckets} buckets")
    path = scratch_path(spark, "refresh-batch")
    batch.withColumn(name, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")).write.parquet(path)
    new = spark.read.schema(StructType([*schema.fields, StructField(name, IntegerType())])).parquet(path)
    if old:
        check_schema_unchanged(schema, _read(spark, base, old[:1], None).drop(name).schema)
        touched = {f"{name}={r[0]}" for r in new.select(name).distinct().collect()}  # ``buckets`` rows at most
        stored = _read(spark, base, [f for f in old if f.split("/")[1] in touched], new.schema)
        keys = new.select(F.col(key).alias("__k")).distinct()
        new = stored.join(keys, stored[key] == keys["__k"], "left_anti").unionByName(new)
    # a bucket's rows lie together, so that it has few files; a batch's hot key is one row of the table
    _write_version(spark, new.repartition(name, F.pmod(F.xxhash64(key, F.lit(1)), F.lit(4))), base, [name], old, version + 1)
    return read_current(spark, base, schema)
