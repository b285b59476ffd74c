"""Upsert into a table, by MERGE where the catalog has it."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce
from urllib.parse import quote as url_quote
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from sedimenta.functions.naming import quote, quote_table
from sedimenta.functions.schema import nullable
from sedimenta.operators.merge import look_once, low_watermark, merge_frames, not_matched
from sedimenta.scratch import stage
from sedimenta.sinks.publish import (
    DROP, NULL_PARTITION, Step, apply, begin, can_publish, location_of, publish, recover, stage_rows, steps_for,
)
from sedimenta.sinks.tables import by_partition, is_v2, overwrite_partitions, replace_all


def merge_statement(table: str, view: str, keys: Sequence[str], order_by: str | None,
                    floor_column: str | None = None, floor: str | None = None) -> str:
    """The MERGE for catalogs that take one (E1; with a floor, E2)."""
    on = " AND ".join(f"target.{quote(k)} = source.{quote(k)}" for k in keys)
    if floor is not None:
        on = f"target.{quote(floor_column)} >= CAST('{floor}' AS TIMESTAMP) AND {on}"
    guard = f" AND source.{quote(order_by)} >= target.{quote(order_by)}" if order_by else ""
    return (f"MERGE INTO {quote_table(table)} AS target USING {view} AS source ON {on} "
            f"WHEN MATCHED{guard} THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *")


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(quote_table(table)) if c.isPartition]


def _same_partition(one: str, other: str, columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{one}.{quote(c)}").eqNullSafe(F.col(f"{other}.{quote(c)}")) for c in columns])


def _scope(target: DataFrame, touched: DataFrame, columns: list[str]) -> DataFrame:
    """The rows of the touched partitions. A set of literals for each column prunes folders, the join does the rest."""
    scope = target
    for c in columns:
        values = [r[0] for r in touched.select(c).distinct().collect()]
        known = F.col(quote(c)).isin([v for v in values if v is not None])
        scope = scope.where(known | F.col(quote(c)).isNull() if None in values else known)
    return scope.alias("t").join(touched.alias("p"), _same_partition("t", "p", columns), "left_semi")


def _touched(target: DataFrame, source: DataFrame, keys: Sequence[str], columns: list[str]) -> DataFrame:
    """Partitions the merge may change: of matched target rows, and of the batch itself."""
    matched = target.join(source.select(*keys), list(keys), "left_semi").select(*columns)
    return stage(matched.unionByName(source.select(*columns)).distinct(), "touched")


def _folder_name(row: Row, columns: list[str]) -> str:
    return "/".join(f"{url_quote(c, safe='')}={NULL_PARTITION if row[c] is None else url_quote(str(row[c]), safe='')}" for c in columns)


def _stored(df: DataFrame, target: DataFrame) -> DataFrame:
    """The rows in the table's types, as its files hold them; a value that does not fit ends the job, as it does on insert."""
    types = {f.name: f.dataType for f in target.schema.fields}
    fits = []
    for f in df.schema.fields:
        c, dtype = F.col(quote(f.name)), types.get(f.name, f.dataType)
        if nullable(dtype) != nullable(f.dataType):
            lost = c.isNotNull() & c.try_cast(dtype).isNull()
            c = F.when(lost, F.raise_error(F.lit(f"[OVERFLOW] a value of {f.name} does not fit {dtype.simpleString()}"))).otherwise(
                c.try_cast(dtype)).cast(dtype)
        fits.append(c.alias(f.name))
    return df.select(*fits)


def _switch_partitions(spark: SparkSession, table: str, source: DataFrame, keys: Sequence[str], order_by: str | None,
                       below: Column | None, columns: list[str]) -> None:
    """The touched partitions written once to a new folder, then all of them switched together."""
    target = spark.table(quote_table(table))
    touched = _touched(target, source, keys, columns)
    run = begin(spark, table, "merge")
    looked = _stored(look_once(_scope(target, touched, columns), source, keys, order_by, below), target)
    folder = stage_rows(run, by_partition(looked, columns), "rows", columns)
    written = spark.read.schema(looked.schema).parquet(folder)
    new = _stored(not_matched(written, source, keys).select(*target.columns), target)
    by_partition(new, columns).write.mode("append").partitionBy(*columns).parquet(folder)
    steps = steps_for(spark, table, folder, "overwrite")
    filled = {s.partition for s in steps}
    # An update may move the last row out of a partition.
    for row in touched.collect():
        name = _folder_name(row, columns)
        there = location_of(spark, table, name)
        if there is not None and unquote(name) not in {unquote(f) for f in filled}:
            steps.append(Step(DROP, table, name, None, there))
    publish(spark, run, steps)


def upsert(spark: SparkSession, table: str, source: DataFrame, keys: Sequence[str],
           order_by: str | None = None, prune_by: str | None = None) -> None:
    """Merge a batch with unique keys and the table's columns into the table.

    File tables cannot be overwritten while they are read. Of a partitioned one only the partitions that the batch
    touches are read in full, once, and written once to a new folder that they are switched to together; a merge that died
    is finished or undone by the next one. Tables without partitions, or with buckets, are staged and overwritten.
    """
    if not keys:
        raise ValueError("a merge needs primary_key")
    target = spark.table(quote_table(table))
    floor = low_watermark(source, prune_by).first()[0] if prune_by else None
    if is_v2(spark, table):
        view = f"_merge_{uuid.uuid4().hex}"
        source.createTempView(view)
        try:
            spark.sql(merge_statement(table, view, keys, order_by, prune_by,
                                      None if floor is None else str(floor)))
        finally:
            spark.catalog.dropTempView(view)
        return
    below = None if floor is None else F.col(quote(prune_by)) >= F.lit(floor)
    columns = partition_columns(spark, table)
    if columns and can_publish(spark, table, columns) and not _is_bucketed(spark, table):
        recover(spark, table)
        _switch_partitions(spark, table, source, keys, order_by, below, columns)
    elif columns:
        touched = _touched(target, source, keys, columns)
        merged = stage(merge_frames(_scope(target, touched, columns), source, keys, order_by, below), "merge")
        filled = merged.select(*columns).distinct().alias("m")
        emptied = touched.alias("p").join(filled, _same_partition("p", "m", columns), "left_anti").collect()
        overwrite_partitions(by_partition(merged, columns), table)
        apply(spark, [Step(DROP, table, _folder_name(row, columns), None, None) for row in emptied])
    else:
        replace_all(stage(merge_frames(target, source, keys, order_by, below), "merge"), table)
    spark.catalog.refreshTable(quote_table(table))


def _is_bucketed(spark: SparkSession, table: str) -> bool:
    return any(r["col_name"] == "Num Buckets" for r in spark.sql(f"DESCRIBE TABLE EXTENDED {quote_table(table)}").collect())
