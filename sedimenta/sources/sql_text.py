"""Parameterised SQL as a source."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession


def date_window(day: str, start: str | None = None, end: str | None = None) -> tuple[str, str]:
    """The configured window, else the half-open day ``[day, day + 1)``."""
    if start and end:
        return start, end
    first = date.fromisoformat(day)
    return first.isoformat(), (first + timedelta(days=1)).isoformat()


def load_sql(spark: SparkSession, path: str) -> str:
    """Text of a SQL file on any file system Spark reads."""
    return spark.read.text(path, wholetext=True).first()["value"]


def run_sql(spark: SparkSession, text: str, start: str, end: str) -> DataFrame:
    """Run the text with its window filled in.

    ``:start_date`` and ``:end_date`` are bound as parameters; ``{start_date}`` and
    ``{end_date}`` are replaced in the text, as existing files expect.
    """
    filled = text.replace("{start_date}", start).replace("{end_date}", end)
    markers = {k: v for k, v in {"start_date": start, "end_date": end}.items() if f":{k}" in filled}
    return spark.sql(filled, args=markers) if markers else spark.sql(filled)


def read_sql(spark: SparkSession, path: str, start: str, end: str) -> DataFrame:
    """A SQL file as a DataFrame."""
    return run_sql(spark, load_sql(spark, path), start, end)
