"""Where intermediate tables go: the shared folder the cluster names."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_local: list[tempfile.TemporaryDirectory] = []

_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"

#: Partition folders a task writes side by side; only past them does it sort what rows are left.
OPEN_FOLDERS = 32

_gate = threading.Lock()
_writing = 0
_before: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; a temporary folder only in local mode."""
    configured = spark.conf.get(_SETTING, None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"{_SETTING} must name a folder every executor can reach")
    if not _local:
        _local.append(tempfile.TemporaryDirectory(prefix="sedimenta-", ignore_cleanup_errors=True))
    return _local[0].name


def new_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet, under the shared folder."""
    return f"{shared_folder(spark)}/sedimenta/{label}-{uuid.uuid4().hex}"


def new_database(spark: SparkSession, label: str) -> str:
    """A fresh database whose tables live under the shared folder."""
    name = f"{label}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE `{name}` LOCATION '{new_path(spark, label)}'")
    return name


@contextmanager
def unsorted_folders(spark: SparkSession) -> Iterator[None]:
    """Writes by partition keep a file open for each folder, in place of a sort of all rows of a task.

    A setting of the session, so writes that run side by side share it; a session with one of its own keeps it.
    """
    global _writing, _before
    with _gate:
        if not _writing:
            _before = spark.conf.get(_WRITERS, None)
            if int(_before or 0) <= 0:
                spark.conf.set(_WRITERS, str(OPEN_FOLDERS))
        _writing += 1
    try:
        yield
    finally:
        with _gate:
            _writing -= 1
            if not _writing:
                spark.conf.unset(_WRITERS) if _before is None else spark.conf.set(_WRITERS, _before)


def stage(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, label)
    writer = df.write.mode("error")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with unsorted_folders(spark):
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
