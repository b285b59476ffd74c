"""Which files have been loaded, as a table.

A load claims the files it finds under the id of its batch, reads exactly the claimed ones, and records when they are
loaded and when they are archived. Paths stay in tables and joins; the driver sees none but those it moves, one at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions.naming import quote_table
from sedimenta.sinks.tables import append, create_table

CLAIMED, LOADED, ARCHIVED, SUPERSEDED = "claimed", "loaded", "archived", "superseded"

_LEDGER = T.StructType([
    T.StructField("batch_id", T.StringType()), T.StructField("state", T.StringType()), T.StructField("path", T.StringType()),
    T.StructField("uri", T.StringType()), T.StructField("length", T.LongType()), T.StructField("modified", T.TimestampType()),
    T.StructField("moment", T.TimestampType())])


def ledger_of(table: str) -> str:
    *path, name = table.replace("`", "").split(".")
    return ".".join([*path, f"{name}__files"])


@dataclass(frozen=True)
class Ledger:
    """The files of one table's loads: a row for each claimed file, and one for each later state of a batch."""

    spark: SparkSession
    name: str

    @classmethod
    def open(cls, spark: SparkSession, table: str) -> Ledger:
        create_table(spark, ledger_of(table), _LEDGER)
        return cls(spark, ledger_of(table))

    def rows(self) -> DataFrame:
        self.spark.catalog.refreshTable(quote_table(self.name))
        return self.spark.table(quote_table(self.name))

    def _add(self, rows: DataFrame) -> None:
        append(rows.withColumn("moment", F.current_timestamp()).select(*_LEDGER.fieldNames()), self.name)

    def claim(self, files: DataFrame) -> str:
        """Claim ``files`` (path, uri, length, modified) for a new batch, in one write; the batch's id."""
        batch = uuid.uuid4().hex
        self._add(files.withColumns({"batch_id": F.lit(batch), "state": F.lit(CLAIMED)}))
        return batch

    def mark(self, batch: str, state: str) -> None:
        values = {f.name: F.lit(None).cast(f.dataType) for f in _LEDGER.fields} | {"batch_id": F.lit(batch), "state": F.lit(state)}
        self._add(self.spark.range(1).select(*[c.alias(n) for n, c in values.items()]))

    def claimed(self, batch: str) -> DataFrame:
        return self.rows().where((F.col("batch_id") == batch) & (F.col("state") == CLAIMED))

    def batches(self, having: str, lacking: list[str]) -> list[str]:
        """Batches that have reached a state and none of some others, oldest first. Open batches are few."""
        states = self.rows().groupBy("batch_id").agg(F.collect_set("state").alias("states"), F.min("moment").alias("begun"))
        lacks = [~F.array_contains("states", s) for s in lacking]
        found = states.where(F.array_contains("states", having))
        for condition in lacks:
            found = found.where(condition)
        return [r["batch_id"] for r in found.orderBy("begun", "batch_id").collect()]

    def paths(self, batch: str) -> Iterator[str]:
        """The claimed paths one after the other, from a partition of the table at a time."""
        return (r["path"] for r in self.claimed(batch).select("path").toLocalIterator())


def files_in(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """path, uri, length, modified of the files below a folder; no content is read."""
    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(folder))
    return listing.select("path", F.col("_metadata.file_path").alias("uri"), "length", F.col("modificationTime").alias("modified"))


def only_claimed(rows: DataFrame, claimed: DataFrame) -> DataFrame:
    """The rows read from claimed files, as these were when they were claimed."""
    columns = rows.columns
    at = rows.select("*", F.col("_metadata.file_path").alias("__uri"), F.col("_metadata.file_size").alias("__length"))
    of = claimed.select(F.col("uri").alias("__uri"), F.col("length").alias("__length"))
    return at.join(of, ["__uri", "__length"], "left_semi").select(*columns)
