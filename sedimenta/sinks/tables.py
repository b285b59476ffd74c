"""Table creation, evolution and writes."""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.util import inheritable_thread_target

from sedimenta.functions.naming import quote_table
from sedimenta.functions.partitioning import PartitionField, parse_partition, partition_spec
from sedimenta.functions.schema import TYPE_TEXT_LIMIT, check_type_sizes, ddl_columns
from sedimenta.operators.align import align_to, losses
from sedimenta.sources.tables import table_schema

# What created tables are stored as, and the metadata kept by formats with history.
TABLE_FORMAT = "parquet"
PARQUET_OPTIONS = {"compression": "snappy"}
V2_PROPERTIES = {
    "format-version": "2",
    "write.format.default": "parquet",
    "write.parquet.compression-codec": "snappy",
    "write.metadata.delete-after-commit.enabled": "true",
    "write.metadata.previous-versions-max": "10",
}

_log = logging.getLogger(__name__)

_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"

_gate = threading.Condition()
_holders: dict[str, int] = {"dynamic": 0, "static": 0}
_before: list[str] = []


@contextmanager
def _overwrite_mode(spark: SparkSession, mode: str) -> Iterator[None]:
    """Set the session's overwrite mode for a write to a catalog table, which takes no option.

    Writes of one mode run side by side; a write of the other mode waits for them.
    """
    other = "static" if mode == "dynamic" else "dynamic"
    with _gate:
        _gate.wait_for(lambda: not _holders[other])
        if not _holders[mode]:
            _before[:] = [spark.conf.get(_OVERWRITE_MODE)]
            spark.conf.set(_OVERWRITE_MODE, mode)
        _holders[mode] += 1
    try:
        yield
    finally:
        with _gate:
            _holders[mode] -= 1
            if not _holders[mode]:
                spark.conf.set(_OVERWRITE_MODE, _before[0])
                _gate.notify_all()


def is_v2(spark: SparkSession, table: str) -> bool:
    """Does the identifier name a catalog of its own, rather than the built-in one?"""
    parts = table.replace("`", "").split(".")
    return len(parts) > 2 and parts[0] != "spark_catalog" and bool(
        spark.conf.get(f"spark.sql.catalog.{parts[0]}", ""))


def string_options(options: dict[str, Any] | None) -> dict[str, str]:
    """Only text settings are meant for the writer."""
    return {k: v for k, v in (options or {}).items() if isinstance(v, str)}


def _fields(partition_by: Sequence[str | Column] | None) -> list[PartitionField]:
    return [parse_partition(e) for e in partition_by or [] if isinstance(e, str)]


def with_partition_values(df: DataFrame, partition_by: Sequence[str | Column] | None) -> DataFrame:
    """C21 on the built-in catalog: time transforms become columns of their own."""
    for p in _fields(partition_by):
        if p.transform in ("years", "months", "days", "hours"):
            df = df.withColumn(p.materialised_name, p.as_value())
    return df


def create_table(spark: SparkSession, table: str, schema: T.StructType,
                 partition_by: Sequence[str | Column] | None = None, *,
                 file_format: str = TABLE_FORMAT, properties: dict[str, str] | None = None,
                 location: str | None = None) -> bool:
    """Create an empty table unless it exists; was it created?"""
    name = quote_table(table)
    if spark.catalog.tableExists(name):
        return False
    empty = spark.createDataFrame([], schema)
    if is_v2(spark, table):
        writer = empty.writeTo(name)
        for key, value in {**V2_PROPERTIES, **(properties or {})}.items():
            writer = writer.tableProperty(key, value)
        if partition_by:
            writer = writer.partitionedBy(*partition_spec(partition_by))
        writer.create()
        return True
    fields = _fields(partition_by)
    shaped = with_partition_values(empty, partition_by).schema
    by_name = {f.name.lower(): f.name for f in shaped.fields}
    folders = [by_name[p.materialised_name.lower()] for p in fields if p.transform != "bucket"]
    buckets = [p for p in fields if p.transform == "bucket"]
    if len(buckets) > 1:
        raise ValueError("the built-in catalog takes one bucket transform")
    text = f"CREATE TABLE {name} ({ddl_columns(shaped)}) USING {file_format}"
    options = PARQUET_OPTIONS if file_format == "parquet" else {}
    if options:
        text += " OPTIONS (" + ", ".join(f"'{k}' '{v}'" for k, v in options.items()) + ")"
    if folders:
        text += " PARTITIONED BY (" + ", ".join(quote_table(f"`{c}`") for c in folders) + ")"
    for b in buckets:
        text += f" CLUSTERED BY (`{b.column}`) INTO {b.buckets} BUCKETS"
    if location:
        text += f" LOCATION '{location}'"
    if properties:
        text += " TBLPROPERTIES (" + ", ".join(f"'{k}' = '{v}'" for k, v in properties.items()) + ")"
    spark.sql(text)
    return True


def sync_schema(spark: SparkSession, schema: T.StructType, table: str) -> list[str]:
    """Add the columns the table lacks, all in one statement; names are case-blind."""
    stored = table_schema(spark, table)
    known = {f.name.lower() for f in stored.fields}
    new = [f for f in schema.fields if f.name.lower() not in known]
    if new:
        name = quote_table(table)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({ddl_columns(T.StructType(new))})")
        spark.catalog.refreshTable(name)
    return [f.name for f in new]


def append(df: DataFrame, table: str, options: dict[str, Any] | None = None) -> None:
    """B2. The frame has the table's columns in the table's order."""
    if is_v2(df.sparkSession, table):
        df.writeTo(quote_table(table)).options(**string_options(options)).append()
    else:
        df.write.options(**string_options(options)).insertInto(quote_table(table))


def overwrite_partitions(df: DataFrame, table: str, options: dict[str, Any] | None = None) -> None:
    """Replace the partitions the frame has rows for, keep the others."""
    if is_v2(df.sparkSession, table):
        df.writeTo(quote_table(table)).options(**string_options(options)).overwritePartitions()
    else:
        with _overwrite_mode(df.sparkSession, "dynamic"):
            (df.write.options(**string_options(options))
             .insertInto(quote_table(table), overwrite=True))


def replace_all(df: DataFrame, table: str) -> None:
    """Replace every row."""
    if is_v2(df.sparkSession, table):
        df.writeTo(quote_table(table)).overwrite(F.lit(True))
    else:
        with _overwrite_mode(df.sparkSession, "static"):
            df.write.insertInto(quote_table(table), overwrite=True)


def _write(df: DataFrame, table: str, mode: str, options: dict[str, Any] | None) -> None:
    if mode == "append":
        append(df, table, options)
    elif mode == "overwrite":
        overwrite_partitions(df, table, options)
    else:
        raise ValueError(f"unsupported write mode: {mode!r}")


def align_for(spark: SparkSession, df: DataFrame, table: str) -> DataFrame:
    """Sync the table with the frame, then the frame with the table."""
    sync_schema(spark, df.schema, table)
    return align_to(df, table_schema(spark, table))


def _watch_losses(spark: SparkSession, df: DataFrame, table: str) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """The frame with a count, kept during its write, of values its table's types cannot hold."""
    sync_schema(spark, df.schema, table)
    return watch_losses(df, table, table_schema(spark, table))


def watch_losses(df: DataFrame, table: str, stored: T.StructType) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """The frame with a count, kept during its write, of values that the types of ``stored`` cannot hold."""
    return observe_losses(df, table, losses(df, stored))


def observe_losses(df: DataFrame, table: str, counts: dict[str, Column]) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """The frame with counts by column that are kept during its write and logged afterwards."""
    if not counts:
        return df, dict
    seen = Observation()
    watched = df.observe(seen, *[c.alias(f"_{i}") for i, c in enumerate(counts.values())])

    def result() -> dict[str, int]:
        lost = {name: seen.get[f"_{i}"] for i, name in enumerate(counts)}
        lost = {name: n for name, n in lost.items() if n}
        for name, n in lost.items():
            _log.warning("%s: %d values of %s do not fit its type and were written as null", table, n, name)
        return lost

    return watched, result


def write_safely(spark: SparkSession, df: DataFrame, table: str, mode: str = "append",
                 type_limit: int = TYPE_TEXT_LIMIT) -> dict[str, int]:
    """Check type sizes, sync, align, write. Returns the values lost per column, if any."""
    check_type_sizes(df.schema, table, type_limit)
    watched, lost = _watch_losses(spark, df, table)
    _write(align_to(watched, table_schema(spark, table)), table, mode, None)
    spark.catalog.refreshTable(quote_table(table))
    return lost()


def clear_partition(spark: SparkSession, table: str, column: str, value: str) -> bool:
    """Remove the rows of one value of a partition column; was that possible?"""
    name = quote_table(table)
    if is_v2(spark, table):
        spark.sql(f"DELETE FROM {name} WHERE `{column}` = '{value}'")
        return True
    if column.lower() not in [c.name.lower() for c in spark.catalog.listColumns(name) if c.isPartition]:
        return False
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (`{column}` = '{value}')")
    spark.catalog.refreshTable(name)
    return True


def database_folder(spark: SparkSession, table: str) -> str:
    """Where the tables of the table's database are."""
    *path, _ = table.replace("`", "").split(".")
    database = ".".join(path) or spark.catalog.currentDatabase()
    described = spark.sql(f"DESCRIBE DATABASE EXTENDED {quote_table(database)}")
    return next(r["info_value"] for r in described.collect() if r["info_name"] == "Location").rstrip("/")


def _clear_unfinished(spark: SparkSession, table: str) -> None:
    """Remove what a write that never committed has left where the table will be: folders without any data file."""
    name = table.replace("`", "").split(".")[-1]
    sensitive = spark.conf.get("spark.sql.caseSensitive") == "true"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{database_folder(spark, table)}/{name if sensitive else name.lower()}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(path) and all(s.getPath().getName().startswith(("_temporary", ".")) for s in fs.listStatus(path)):
        fs.delete(path, True)


def create_with_rows(spark: SparkSession, df: DataFrame, table: str, partition_by: Sequence[str | Column] | None = None,
                     options: dict[str, Any] | None = None) -> None:
    """A new table with its rows by one commit. A write that fails leaves no table.

    On the built-in catalog time transforms become columns (C21), and buckets are the writer's.
    """
    name = quote_table(table)
    if is_v2(spark, table):
        writer = df.writeTo(name).options(**string_options(options))
        for key, value in V2_PROPERTIES.items():
            writer = writer.tableProperty(key, value)
        if partition_by:
            writer = writer.partitionedBy(*partition_spec(partition_by))
        writer.createOrReplace()
        return
    fields = _fields(partition_by)
    shaped = with_partition_values(df, partition_by)
    by_name = {f.name.lower(): f.name for f in shaped.schema.fields}
    writer = shaped.write.format(TABLE_FORMAT).options(**PARQUET_OPTIONS | string_options(options)).mode("error")
    folders = [by_name[p.materialised_name.lower()] for p in fields if p.transform != "bucket"]
    if folders:
        writer = writer.partitionBy(*folders)
    buckets = [p for p in fields if p.transform == "bucket"]
    if len(buckets) > 1:
        raise ValueError("the built-in catalog takes one bucket transform")
    for b in buckets:
        writer = writer.bucketBy(b.buckets, by_name[b.column.lower()])
    _clear_unfinished(spark, table)
    writer.saveAsTable(name)


def by_partition(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Gather the rows of a partition before they are written, so that not every task leaves a
    file in every folder. A partition too large for one task is split again at run time."""
    return df.hint("rebalance", *columns) if columns else df


def create_or_append(spark: SparkSession, df: DataFrame, table: str,
                     partition_by: Sequence[str | Column] | None = None, mode: str = "append",
                     options: dict[str, Any] | None = None, gather: bool = False) -> dict[str, int]:
    """Create the table with its rows when absent (B7), else sync, align and write, then refresh.

    Returns the values lost per column, if any. ``gather`` shuffles the rows by partition first: worth it when a batch spans many.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unsupported write mode: {mode!r}")
    if not spark.catalog.tableExists(quote_table(table)):
        rows = by_partition(df, [p.column for p in _fields(partition_by) if p.transform == "identity"]) if gather else df
        create_with_rows(spark, rows, table, partition_by, options)
        spark.catalog.refreshTable(quote_table(table))
        return {}
    shaped = df if is_v2(spark, table) else with_partition_values(df, partition_by)
    watched, lost = _watch_losses(spark, shaped, table)
    aligned = align_to(watched, table_schema(spark, table))
    if gather:
        aligned = by_partition(aligned, [p.materialised_name for p in _fields(partition_by)
                                         if p.transform != "bucket"])
    _write(aligned, table, mode, options)
    spark.catalog.refreshTable(quote_table(table))
    return lost()


def write_all(writes: Sequence[Callable[[], Any]], parallelism: int = 8) -> list[Any]:
    """Run independent table writes side by side; the first failure is raised.

    Many child tables are small, so one after the other would leave a cluster idle.
    """
    session = SparkSession.getActiveSession()
    if len(writes) < 2 or session is None:
        return [w() for w in writes]
    inheriting = inheritable_thread_target(session)
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        futures = [pool.submit(inheriting(w)) for w in writes]
        return [f.result() for f in futures]
