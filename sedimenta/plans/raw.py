"""JSON files of one date into a raw table."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions.schema import check_type_sizes
from sedimenta.operators.align import align_to
from sedimenta.sinks.publish import (
    begin, can_publish, create_evolving, drop_step, publish, recover, reshape_steps, schema_versions, stage_rows,
    steps_for, target_schema,
)
from sedimenta.sinks.tables import clear_partition, create_table, sync_schema, watch_losses, write_safely
from sedimenta.sources.files import files_for_date
from sedimenta.sources.json_scan import (
    CORRUPT, INGESTED_AT, SOURCE_FILE, JsonScan, read_json, split_corrupt,
)
from sedimenta.sources.tables import table_schema

DEFAULT_CATALOG = "spark_catalog"
EXECUTION_DATE = "execution_date"
_log = logging.getLogger(__name__)


@dataclass(frozen=True)
class RawReport:
    files: int
    records: int
    corrupt: int
    lost_values: dict[str, int] = field(default_factory=dict)


def table_name(destination: dict[str, Any], database: str, table: str) -> str:
    return ".".join([destination.get("catalog_name", DEFAULT_CATALOG), database, table])


@dataclass(frozen=True)
class RawSettings:
    """The configuration of a raw load, checked."""

    path: str
    pattern: str | None
    multi_line: bool
    sampling_ratio: float | None
    table: str
    quarantine: str | None
    partition_by: list[str]
    mode: str
    evolve_nested: bool

    @classmethod
    def of(cls, config: dict[str, Any]) -> RawSettings:
        source, destination = config.get("source", {}), config.get("destination", {})
        missing = [name for name, given in (
            ("source.input_path", source.get("input_path")), ("destination.database", destination.get("database")),
            ("destination.table", destination.get("table"))) if not given]
        if missing:
            raise ValueError(f"{' and '.join(missing)} {'is' if len(missing) == 1 else 'are'} required")

        def full(name: str) -> str:
            return table_name(destination, destination["database"], name)

        held = destination.get("quarantine_table")
        return cls(source["input_path"], source.get("file_pattern"), source.get("multi_line", True), source.get("sampling_ratio"),
                   full(destination["table"]), full(held) if held else None, destination.get("partition_by") or [],
                   destination.get("write_mode", destination.get("mode", "append")), destination.get("evolve_nested", False))

    @property
    def at_once(self) -> bool:
        """Whether the load's date is the only partition, so that one write can serve both tables."""
        return ((self.quarantine is not None or self.evolve_nested) and self.mode in ("append", "overwrite")
                and [p.lower() for p in self.partition_by] == [EXECUTION_DATE])


def raw_ingest(spark: SparkSession, date: str, config: dict[str, Any]) -> RawReport:
    """Select files, read them resiliently, create the table if needed, write safely.

    Records and corrupt records are counted by the write itself. Corrupt records stay in the
    table as rows of nulls, unless ``destination.quarantine_table`` takes them: then, with a table partitioned by
    ``execution_date`` of the built-in catalog, one write parts good and corrupt records by folder, and both tables show
    them together. A load that died is finished or undone by the next one; in append mode, a load of the same date that
    finds its committed predecessor unfinished only finishes that, and reports no files.

    With ``destination.evolve_nested`` and such a partition the table is created to evolve: nested fields that are new,
    at any level, are added to its types, earlier rows have null there, and its properties keep every schema it had.
    """
    load = RawSettings.of(config)
    at_once = load.at_once and can_publish(spark, load.table, load.partition_by)
    if load.evolve_nested and not at_once:
        raise ValueError("evolve_nested needs a table of the built-in catalog partitioned by execution_date")
    if at_once and date in recover(spark, load.table) and load.mode == "append":
        return RawReport(0, 0, 0)
    files = files_for_date(spark, load.path, date, load.pattern)
    if not files:
        return RawReport(0, 0, 0)
    stored = table_schema(spark, load.table)
    evolves = load.evolve_nested and (stored is None or bool(schema_versions(spark, load.table)))
    scan = read_json(spark, files, stored, multi_line=load.multi_line,
                     sampling_ratio=load.sampling_ratio, evolve_nested=evolves)
    write = _write_parted if at_once else _write_apart if load.quarantine else _write_whole
    records, corrupt, lost = write(spark, scan, load, date)
    for column, n in scan.lost().items():
        _log.warning("%s: %d values in new nested fields of %s are not in its type and were left out", load.table, n, column)
        lost[column] = lost.get(column, 0) + n
    return RawReport(len(files), records, corrupt, lost)


def _dated(df: DataFrame, date: str) -> DataFrame:
    return df.withColumn(EXECUTION_DATE, F.lit(date).cast("date"))


def _write_whole(spark: SparkSession, scan: JsonScan, load: RawSettings, date: str) -> tuple[int, int, dict[str, int]]:
    """Good and corrupt records into one table."""
    counts = Observation()
    records = scan.frame.observe(counts, F.count(F.lit(1)).alias("records"), F.count(CORRUPT).alias("corrupt"))
    dated = _dated(records.drop(CORRUPT), date)
    create_table(spark, load.table, dated.schema, load.partition_by)
    lost = write_safely(spark, dated, load.table, load.mode)
    return counts.get["records"], counts.get["corrupt"], lost


def _write_parted(spark: SparkSession, scan: JsonScan, load: RawSettings, date: str) -> tuple[int, int, dict[str, int]]:
    """Parse once, write once: good and corrupt records in folders of their own, each the table's partition."""
    run = begin(spark, load.table, date)
    counts = Observation()
    frame = scan.frame.observe(counts, F.count_if(F.col(CORRUPT).isNull()).alias("records"), F.count(CORRUPT).alias("corrupt"))
    good = _dated(frame, date)
    main = target_schema(spark, load.table, T.StructType([f for f in good.schema.fields if f.name != CORRUPT]), load.evolve_nested)
    check_type_sizes(main, load.table)
    watched, lost = watch_losses(good, load.table, main)
    held = T.StructType([good.schema[c] for c in (CORRUPT, SOURCE_FILE, INGESTED_AT, EXECUTION_DATE)])
    part = F.when(F.col(CORRUPT).isNull() | F.lit(load.quarantine is None), "good").otherwise("corrupt")
    kept = T.StructType([*main.fields, T.StructField(CORRUPT, T.StringType()), T.StructField("_part", T.StringType())])
    both = align_to(watched.withColumn("_part", part), kept)
    folder = stage_rows(run, both, "records", ["_part", EXECUTION_DATE])
    found = lost()
    seen = counts.get
    if load.evolve_nested:
        create_evolving(spark, load.table, main, load.partition_by)
        steps = reshape_steps(spark, load.table, main)
    else:
        create_table(spark, load.table, main, load.partition_by)
        steps = []
    if not steps:
        sync_schema(spark, main, load.table)
    records, corrupt = seen["records"], seen["corrupt"]
    if load.quarantine is None:
        records += corrupt
    if records:
        steps += steps_for(spark, load.table, f"{folder}/_part=good", load.mode)
    if load.quarantine is not None:
        create_table(spark, load.quarantine, held, load.partition_by)
        if corrupt:
            steps += steps_for(spark, load.quarantine, f"{folder}/_part=corrupt", load.mode)
        elif load.mode == "overwrite":
            steps += drop_step(spark, load.quarantine, EXECUTION_DATE, date)  # an earlier run's
    publish(spark, run, steps)
    return records, corrupt, found


def _write_apart(spark: SparkSession, scan: JsonScan, load: RawSettings, date: str) -> tuple[int, int, dict[str, int]]:
    """Both tables by writes of their own, for tables that one write cannot serve."""
    good, bad = split_corrupt(scan)
    bad = _dated(bad, date)
    created = create_table(spark, load.quarantine, bad.schema, [EXECUTION_DATE])
    bad_counts, counts = Observation(), Observation()
    watched = bad.observe(bad_counts, F.count(F.lit(1)).alias("corrupt"))
    if load.mode == "overwrite" and not created:
        clear_partition(spark, load.quarantine, EXECUTION_DATE, date)  # also when this run has no bad record
    write_safely(spark, watched, load.quarantine, "append")
    dated = _dated(good.observe(counts, F.count(F.lit(1)).alias("records")), date)
    create_table(spark, load.table, dated.schema, load.partition_by)
    lost = write_safely(spark, dated, load.table, load.mode)
    return counts.get["records"], bad_counts.get["corrupt"], lost
