"""A parameterised SQL file into a table."""

from __future__ import annotations

from typing import Any

from pyspark.sql import SparkSession
from pyspark.storagelevel import StorageLevel

from sedimenta.functions.naming import quote, quote_table
from sedimenta.operators.align import align_by_union
from sedimenta.operators.merge import latest_per_key
from sedimenta.plans.raw import table_name
from sedimenta.sinks.tables import (
    append, create_or_append, overwrite_partitions, string_options, sync_schema,
    with_partition_values,
)
from sedimenta.sinks.upsert import upsert
from sedimenta.sources.sql_text import read_sql
from sedimenta.sources.tables import table_schema

WRITE_MODES = ("append", "overwrite", "merge")


def sql_to_table(spark: SparkSession, config: dict[str, Any], start: str, end: str) -> int:
    """Run the query, keep one row per key, write by the configured mode.

    A missing table is created whatever the mode. The batch is computed once and released
    at the end; its row count is returned.
    """
    destination = config["destination"]
    options = destination.get("options", {})
    merge = options.get("merge_config", {})
    keys, order_by = merge.get("primary_key"), merge.get("timestamp_column")
    mode = destination.get("write_mode", "append")
    if mode not in WRITE_MODES:
        raise ValueError(f"unsupported write mode: {mode!r}")
    if mode == "merge" and not keys:
        raise ValueError("write mode merge needs options.merge_config.primary_key")
    keys = [keys] if isinstance(keys, str) else keys

    batch = read_sql(spark, config["source"]["query_path"], start, end)
    if keys:
        batch = latest_per_key(batch, keys, order_by)
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = batch.count()
        if rows == 0:
            return 0
        table = table_name(destination, destination["database_name"], destination["table_name"])
        partition_by = destination.get("partition_by")
        if table_schema(spark, table) is None:
            create_or_append(spark, batch, table, partition_by, "append", string_options(options))
            return rows
        shaped = with_partition_values(batch, partition_by)
        sync_schema(spark, shaped.schema, table)
        stored = spark.table(quote_table(table))
        # Wider values are cast by the write, which refuses what does not fit.
        aligned = align_by_union(shaped, stored).select(*[quote(c) for c in stored.columns])
        if mode == "append":
            append(aligned, table, options)
        elif mode == "overwrite":
            overwrite_partitions(aligned, table, options)
        else:
            upsert(spark, table, aligned, keys, order_by, merge.get("target_filter"))
        spark.catalog.refreshTable(quote_table(table))
        return rows
    finally:
        batch.unpersist()
