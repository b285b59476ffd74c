"""Which files to read, decided on names alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Paths, sizes and times of the files below ``path``; no content is read.

    Spark lists large trees as a distributed job of its own.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", "length", "modificationTime")


def check_path(path: str) -> None:
    if not path or not path.strip():
        raise ValueError(f"invalid input path: {path!r}")


def files_for_date(spark: SparkSession, path: str, date: str,
                   pattern: str | None = None) -> list[str]:
    """A3: files whose base name matches the pattern, with ``{date}`` filled in.

    Without a pattern the date itself is searched for, which the listing can already do by
    glob. The list goes to the driver because a reader takes its paths from there, as
    Spark's own file index would.
    """
    check_path(path)
    if pattern is None:
        chosen = list_files(spark, path, f"*{date}*")
    else:
        base_name = F.element_at(F.split("path", "/"), -1)
        chosen = list_files(spark, path).where(base_name.rlike(pattern.replace("{date}", date)))
    return [row["path"] for row in chosen.select("path").orderBy("path").collect()]


def has_files(spark: SparkSession, path: str, glob: str = "*.csv") -> bool:
    """Is there anything to read? A missing folder means no."""
    check_path(path)
    try:
        return not list_files(spark, path, glob).isEmpty()
    except Exception as error:  # the class differs between classic and Connect sessions
        if getattr(error, "getCondition", lambda: None)() == "PATH_NOT_FOUND":
            return False
        raise
