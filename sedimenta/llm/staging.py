"""Intermediate tables in the shared folder, whose shuffle files go as soon as the table is written."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sedimenta.scratch import new_path

_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage_lean(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` once and read it back; recovery from a lost executor then needs nothing before it."""
    spark = df.sparkSession
    path = new_path(spark, label)
    before = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.mode("error").option("compression", compression).parquet(path)
    finally:
        spark.conf.unset(_CLEAN) if before is None else spark.conf.set(_CLEAN, before)
    staged = spark.read.schema(df.schema).parquet(path)
    staged.staged_at = path
    return staged


def discard(*staged: DataFrame) -> None:
    """Delete staged tables that nothing will read again."""
    for df in staged:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.staged_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
