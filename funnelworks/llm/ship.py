"""Make the package importable in Python workers, as ``--py-files`` would."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import funnelworks

_SENT = "funnelworks.llm.sent"


def ship_package(spark: SparkSession) -> None:
    """Add a zip of this package to the application's Python files, once per
    application; the driver serves it to every executor."""
    context = spark.sparkContext
    if os.environ.get(_SENT) == context.applicationId:
        return
    root = Path(funnelworks.__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="funnelworks-")) / "funnelworks.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(str(target))
    os.environ[_SENT] = context.applicationId
