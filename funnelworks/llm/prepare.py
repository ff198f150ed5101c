"""Session set-up of the registered queries."""

from __future__ import annotations

from pyspark.sql import SparkSession

from funnelworks.llm.ship import ship_package
from funnelworks.session import apply_conf, ensure_checkpoint_dir

#: Rows handed to Python at once; a row is a whole text.
BATCH_ROWS = "1000"


def prepared(spark: SparkSession) -> SparkSession:
    apply_conf(spark)
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark
