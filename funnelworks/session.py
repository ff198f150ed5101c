"""Session settings the library relies on.

The library never creates a cluster session behind the caller's back: every
public function takes an existing ``SparkSession``.  ``get_session`` is a
convenience for tests, the bench and local runs; ``apply_conf`` pins the few
settings whose defaults would change results (ANSI, time zone) or waste work
at scale (AQE, skew join).
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings that change results if left at a different value.
RESULT_CONF = {
    "spark.sql.ansi.enabled": "true",  # malformed casts and decimal overflow raise
    "spark.sql.session.timeZone": "UTC",
}

# Settings for the execution model: runtime re-planning, skew splitting,
# partition coalescing.  All are safe at any scale.
EXECUTION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def apply_conf(spark: SparkSession) -> SparkSession:
    for key, value in {**RESULT_CONF, **EXECUTION_CONF}.items():
        spark.conf.set(key, value)
    return spark


def get_session(master: str | None = None, shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and the bench (UI off, no extra ports)."""
    builder = (
        SparkSession.builder.master(master or os.environ.get("SPARK_MASTER", "local[8]"))
        .appName("funnelworks")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Wide projections generate long methods; let HotSpot JIT-compile
        # them instead of interpreting (JVM flag, applies at JVM start).
        .config("spark.driver.extraJavaOptions", "-XX:-DontCompileHugeMethods")
        .config("spark.executor.extraJavaOptions", "-XX:-DontCompileHugeMethods")
    )
    for key, value in {**RESULT_CONF, **EXECUTION_CONF}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for lineage cuts, if any."""
    value = spark.conf.get("spark.checkpoint.dir", None)
    if value:
        return value
    return spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the configured checkpoint folder; only when the session names
    none (local runs, tests) register a scratch folder of our own."""
    existing = checkpoint_dir(spark)
    if existing:
        return existing
    master = spark.sparkContext.master
    if not re.match(r"local($|\[)", master):
        raise ValueError(
            f"spark.checkpoint.dir is not set: on {master} intermediate tables need a folder that all executors share"
        )
    scratch = tempfile.mkdtemp(prefix="funnelworks-ckpt-", dir=os.environ.get("FUNNELWORKS_SCRATCH", "/tmp"))
    spark.sparkContext.setCheckpointDir(scratch)
    return scratch


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh table location under the shared checkpoint folder."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/funnelworks/{name}-{uuid.uuid4().hex[:12]}"
