"""The CSV full load as a file stream that archives what it has read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sedimenta.functions.naming import quote_table
from sedimenta.operators.align import align_to
from sedimenta.sinks.files import write_many, write_orc
from sedimenta.sinks.tables import replace_all
from sedimenta.sources.csv_scan import CSV_OPTIONS
from sedimenta.sources.tables import require_schema


def csv_stream(spark: SparkSession, path: str, schema: T.StructType, archive: str) -> DataFrame:
    """New CSV files in the folder ``path``; files of a finished batch move to ``archive``.

    Spark archives a batch's files while it plans a later batch, keeping their sub-folders,
    so a file leaves the input one run after it was read.
    """
    return (
        spark.readStream.schema(schema)
        .options(**CSV_OPTIONS)
        .option("pathGlobFilter", "*.csv")
        .option("cleanSource", "archive").option("sourceArchiveDir", archive)
        .csv(path)
    )


def run_csv_stream(spark: SparkSession, path: str, table: str, orc_location: str, archive: str,
                   checkpoint: str) -> StreamingQuery:
    """Load all files waiting in the folder ``path`` as one batch and stop.

    The checkpoint remembers which files were read, so a run that is repeated after a lost
    driver neither skips nor repeats a file.
    """
    stored = require_schema(spark, table)

    def load(batch: DataFrame, _: int) -> None:
        write_many(batch, [
            lambda df: replace_all(align_to(df, stored), table),
            lambda df: write_orc(df, orc_location),
        ])
        # Batches run in a session of their own; the caller's still lists the old files.
        spark.catalog.refreshTable(quote_table(table))

    return (csv_stream(spark, path, stored, archive).writeStream.foreachBatch(load)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
