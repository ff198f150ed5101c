"""Files and tables in the shared folder, and joins against checked sizes.

Intermediate tables go below the folder that ``spark.checkpoint.dir`` names
(a local scratch folder only where the session names none).  Binary outputs
that no Spark sink can write are written from tasks through ``pyarrow.fs``:
under a temporary name first, then renamed, with names and bytes that depend
on the task's input alone, so a task that is run again after a lost executor
replaces its own file with the same one.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelworks.session import scratch_path

__all__ = ["BROADCAST_BYTES", "broadcast_if_small", "exists", "open_in", "open_out", "read_table", "remove", "scratch_path", "stored"]

#: Largest table, as rows times ROW_BYTES, that is sent to every executor.
BROADCAST_BYTES = 32 << 20
ROW_BYTES = 48


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back:
    cuts the lineage, so later reads survive lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, row_bytes: int = ROW_BYTES, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only when the (stored) table's counted rows fit the
    limit; larger tables are left to a shuffled join."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def _located(uri: str):
    """File system and path; Spark writes local URIs with one slash."""
    return pafs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri)


def exists(uri: str) -> bool:
    files, path = _located(uri)
    return files.get_file_info(path).type == pafs.FileType.File


def remove(uri: str) -> None:
    files, path = _located(uri)
    files.delete_file(path)


@contextmanager
def open_out(uri: str) -> Iterator:
    """A new file at ``uri``, visible under its name only when complete."""
    files, path = _located(uri)
    folder, _, name = path.rpartition("/")
    files.create_dir(folder, recursive=True)
    part = f"{folder}/.{name}.{uuid.uuid4().hex}"
    out = files.open_output_stream(part)
    try:
        yield out
    except BaseException:
        out.close()
        files.delete_file(part)
        raise
    out.close()
    files.move(part, path)


def open_in(uri: str):
    """A seekable file."""
    files, path = _located(uri)
    return files.open_input_file(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
