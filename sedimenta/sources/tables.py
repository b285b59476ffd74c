"""Table lookups and date slices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions.naming import quote, quote_table


def table_schema(spark: SparkSession, table: str) -> T.StructType | None:
    """An existing table's schema, or None."""
    name = quote_table(table)
    return spark.table(name).schema if spark.catalog.tableExists(name) else None


def require_schema(spark: SparkSession, table: str) -> T.StructType:
    """A5: the schema of a table that must exist; metadata only."""
    return spark.table(quote_table(table)).schema


def on_date(df: DataFrame, column: str, date: str) -> DataFrame:
    """Rows of one day. Spark turns this into a range the scan can prune by."""
    return df.where(F.to_date(quote(column)) == F.lit(date).cast("date"))


def read_date_slice(spark: SparkSession, table: str, column: str, date: str) -> DataFrame | None:
    """One day of a table; None when the table does not exist."""
    name = quote_table(table)
    if not spark.catalog.tableExists(name):
        return None
    df = spark.table(name)
    if column.lower() not in (c.lower() for c in df.columns):
        raise ValueError(f"{table} has no column {column!r} to slice by")
    return on_date(df, column, date)
