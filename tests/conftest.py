from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session", autouse=True)
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .config("spark.checkpoint.dir", str(folder / "checkpoint"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def case_sensitive(spark):
    spark.conf.set("spark.sql.caseSensitive", True)
    yield
    spark.conf.unset("spark.sql.caseSensitive")


@pytest.fixture
def database(spark):
    from sedimenta.scratch import new_database

    return new_database(spark, "test")


def rows(df, *columns):
    """Rows as plain tuples, in a stable order."""
    df = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in df.collect()), key=repr)
