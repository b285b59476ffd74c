"""File sinks and the archive of processed inputs."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel


def write_orc(df: DataFrame, path: str) -> None:
    """Replace an ORC snapshot. The committer leaves ``_SUCCESS`` behind."""
    df.write.mode("overwrite").orc(path)


def write_json(df: DataFrame, path: str) -> None:
    """Export records as JSON, nulls included."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def _hadoop(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def has_success_marker(spark: SparkSession, path: str) -> bool:
    """Did the last write to ``path`` finish?"""
    fs, marker = _hadoop(spark, f"{path.rstrip('/')}/_SUCCESS")
    return fs.exists(marker)


def write_many(df: DataFrame, sinks: Sequence[Callable[[DataFrame], None]]) -> int:
    """Several sinks from one batch that is computed once; the number of rows (F1).

    An empty batch is not written. Lost blocks are computed again from the source.
    """
    batch = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = batch.count()
        if rows:
            for sink in sinks:
                sink(batch)
        return rows
    finally:
        batch.unpersist()


def _move(spark: SparkSession, source: str, target: str) -> None:
    fs, source_path = _hadoop(spark, source)
    _, target_path = _hadoop(spark, f"{target.rstrip('/')}/{source.rsplit('/', 1)[-1]}")
    if not fs.exists(source_path) and fs.exists(target_path):
        return  # moved before
    fs.mkdirs(target_path.getParent())
    fs.delete(target_path, False)
    if not fs.rename(source_path, target_path):
        raise OSError(f"could not move {source} to {target_path}")


def archive_files(spark: SparkSession, paths: Iterable[str], target: str, at_once: int = 256) -> int:
    """Move exactly these files to ``target``, flat by base name; files that are there already stay.

    The file system renames (or copies on its own side); no content passes the driver, and of the paths only as many as
    are moved at once. A file of an earlier load with the same name is replaced; two files of one load may not share a
    name, as one of them would be lost.
    """
    moved, left = 0, iter(paths)
    with ThreadPoolExecutor(max_workers=16) as pool:
        while some := list(islice(left, at_once)):
            repeated = sorted(n for n, uses in Counter(p.rsplit("/", 1)[-1] for p in some).items() if uses > 1)
            if repeated:
                raise ValueError(f"several inputs would be archived as one file: {repeated}")
            list(pool.map(lambda path: _move(spark, path, target), some))
            moved += len(some)
    return moved


def require_own_names(files: DataFrame, path: str = "path") -> None:
    """Refuse files of one load that would be archived under one name."""
    names = files.select(F.element_at(F.split(path, "/"), -1).alias("name")).groupBy("name").count()
    repeated = [r["name"] for r in names.where("count > 1").orderBy("name").limit(5).collect()]
    if repeated:
        raise ValueError(f"several inputs would be archived as one file: {repeated}")
