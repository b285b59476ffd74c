"""Finding single records."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions.json_values import array_elements, field_value, key_kind
from sedimenta.functions.naming import quote


def _id_column(df: DataFrame, name: str) -> Column:
    """The id under whichever spellings the frame has."""
    spellings = [c for c in df.columns if c.lower() == name.lower()]
    if not spellings:
        raise ValueError(f"no column {name!r} among {df.columns}")
    return F.coalesce(*[F.col(quote(c)) for c in spellings])


def find_record(df: DataFrame, id_column: str, value: Any) -> DataFrame:
    """The record with this id; the filter reaches the scan, the limit ends it early."""
    return df.where(_id_column(df, id_column) == F.lit(value)).limit(1)


def require_record(df: DataFrame, id_column: str, value: Any) -> DataFrame:
    """D13 with the error for an id nobody has."""
    record = find_record(df, id_column, value)
    if record.isEmpty():
        raise LookupError(f"no record with {id_column} = {value!r}")
    return record


def inspect_key(df: DataFrame, json: str, id_column: str, key: str, sample: int = 3) -> DataFrame:
    """the first record (by id) with a value under ``key``: its kind, and the value.

    Arrays are cut to their first ``sample`` items, as the report shows them. Kept as a
    minimum over the id, so only one row per task moves.
    """
    value = field_value(F.try_parse_json(quote(json)), key, T.VariantType())
    found = df.select(_id_column(df, id_column).alias("id"), value.alias("value")).where(
        F.col("value").isNotNull() & ~F.is_variant_null("value"))
    first = found.agg(F.min_by(F.struct("id", F.to_json("value").alias("text")), "id").alias("row"))
    text = F.col("row.text")
    shown = F.coalesce(F.to_json(F.slice(array_elements(text), 1, sample)), text)
    return first.where(F.col("row").isNotNull()).select(
        "row.id", key_kind(F.parse_json(text)).alias("kind"), shown.alias("sample"))
