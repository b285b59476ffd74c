"""Header-less CSV with a table's schema (A4, A5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sedimenta.sources.tables import require_schema


# How the files are written.
CSV_OPTIONS = {"sep": ";", "escape": '"', "encoding": "UTF-8", "header": False, "mode": "PERMISSIVE"}


def read_csv(spark: SparkSession, paths: str | list[str], schema: T.StructType, glob: str | None = None) -> DataFrame:
    """A4: semicolons, doubled quotes, no header; short and unreadable fields become null.

    With ``glob`` the files of that name at any depth below a folder.
    """
    reader = spark.read.schema(schema).options(**CSV_OPTIONS)
    if glob:
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    return reader.csv(paths)


def read_csv_like(spark: SparkSession, paths: str | list[str], table: str, glob: str | None = None) -> DataFrame:
    """A4 with A5: the columns are those of an existing table."""
    return read_csv(spark, paths, require_schema(spark, table), glob)
