"""A day of a raw table into a main table and its child tables."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions.naming import quote_table, resolve_case_conflicts
from sedimenta.functions.partitioning import parse_partition
from sedimenta.operators.align import align_to
from sedimenta.operators.nested import (
    MapChild, NestedField, NormalisationPlan, explode_array, fix_case_conflicts, main_projection,
    map_array_child, map_child, map_child_fields, map_children, plan_normalisation, stage_map_elements,
    with_names,
)
from sedimenta.plans.fanout import CHILD, ChildRows, layers, wide_rows
from sedimenta.plans.raw import table_name
from sedimenta.sinks.publish import (
    Run, begin, can_publish, drop_step, publish, recover, stage_rows, steps_for, target_schema,
)
from sedimenta.sinks.tables import (
    by_partition, clear_partition, create_or_append, create_table, sync_schema, watch_losses,
    with_partition_values, write_all,
)
from sedimenta.sources.tables import read_date_slice

TRUSTED_AT = "_trusted_ingested_at"
EXECUTION_DATE = "execution_date"


def with_audit(df: DataFrame, date: str, moment: Column) -> DataFrame:
    """C16 for a child: the run's date and moment; same-named fields of the data move aside."""
    names = resolve_case_conflicts([EXECUTION_DATE, TRUSTED_AT, *df.columns])[2:]
    return with_names(df, names).withColumn(
        EXECUTION_DATE, F.lit(date).cast("date")).withColumn(TRUSTED_AT, moment)


def child_frames(df: DataFrame, plan: NormalisationPlan) -> dict[str, DataFrame]:
    """Every child by table name. Map elements are laid out once for all."""
    children: dict[str, DataFrame] = {}
    for nested in plan.arrays:
        children[nested.table] = explode_array(df, nested, plan.root_id)
    for nested in plan.maps:
        if nested.kind == "map_array":
            children[nested.table] = map_array_child(df, nested, plan.root_id)
            continue
        elements = stage_map_elements(df, nested, plan.root_id)
        for child in map_children(elements, nested):
            children[child.table] = map_child(elements, nested, child, plan.root_id)
    return children


_CHILDREN = "sedimenta.children"


def known_children(spark: SparkSession, main_table: str) -> set[str]:
    """The child tables that any run has written for a main table."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {quote_table(main_table)}").where(F.col("key") == _CHILDREN).collect()
    return {name for row in rows for name in row["value"].split(",") if name}


def remember_children(spark: SparkSession, main_table: str, written: set[str]) -> None:
    known = known_children(spark, main_table)
    if written - known:
        names = ",".join(sorted(known | written))
        spark.sql(f"ALTER TABLE {quote_table(main_table)} SET TBLPROPERTIES ('{_CHILDREN}' = '{names}')")


@dataclass
class _Load:
    """A run's rows written so far: per table what it is created from, and the steps that publish it."""

    spark: SparkSession
    run: Run
    destination: dict[str, Any]
    schemas: dict[str, T.StructType] = field(default_factory=dict)
    folders: dict[str, str] = field(default_factory=dict)

    @property
    def partition_by(self) -> list[str] | None:
        return self.destination.get("partition_by")

    def full(self, name: str) -> str:
        return table_name(self.destination, self.destination["database_name"], name)

    def partitions(self) -> list[str]:
        return [parse_partition(p).materialised_name for p in self.partition_by or []]

    def write(self, name: str, frame: DataFrame) -> None:
        """One table's rows; a table without rows stays as it is."""
        shaped = with_partition_values(frame, self.partition_by)
        stored = target_schema(self.spark, self.full(name), shaped.schema)
        watched, lost = watch_losses(shaped, name, stored)
        rows = Observation()
        aligned = align_to(watched, stored).observe(rows, F.count(F.lit(1)).alias("rows"))
        if self.destination.get("gather"):
            aligned = by_partition(aligned, self.partitions())
        folder = stage_rows(self.run, aligned, name, self.partitions())
        lost()
        if rows.get["rows"]:
            self.schemas[name], self.folders[name] = frame.schema, folder

    def write_map(self, elements: DataFrame, nested: NestedField, children: list[MapChild], root_id: str,
                  date: str, moment: Column) -> None:
        """All children of a text map by one write, or by a few where they disagree about a column's type."""
        rows = []
        for child in children:
            fields = map_child_fields(elements, nested, child, root_id)
            names = resolve_case_conflicts([EXECUTION_DATE, TRUSTED_AT, *(f.name for f, _ in fields)])[2:]
            columns = [(T.StructField(name, f.dataType, True, f.metadata), c) for name, (f, c) in zip(names, fields)]
            columns += [(T.StructField(EXECUTION_DATE, T.DateType()), F.lit(date).cast("date")),
                        (T.StructField(TRUSTED_AT, T.TimestampType()), moment)]
            schema = T.StructType([T.StructField(f.name, f.dataType) for f, _ in columns])
            rows.append(ChildRows(child.key, child.table, columns, target_schema(self.spark, self.full(child.table), schema)))
            self.schemas[child.table] = schema
        for i, group in enumerate(layers(rows)):
            wide, lost = wide_rows(elements, "_key", group)
            folder = stage_rows(self.run, wide, f"{nested.table}-{i}", [CHILD, *self.partitions()])
            lost()
            self.folders |= {c.table: f"{folder}/{CHILD}={c.table}" for c in group}

    def publish(self, mode: str, order: list[str], date: str) -> list[str]:
        """Create and extend the tables, then show all rows at once. The tables that got rows, main first, in ``order``."""
        main_table = order[0]
        for name, schema in self.schemas.items():
            create_table(self.spark, self.full(name), schema, self.partition_by)
            sync_schema(self.spark, schema, self.full(name))
        children = {name for name in self.folders if name != main_table}
        remember_children(self.spark, self.full(main_table), children)
        names = sorted(self.folders, key=order.index)
        steps = [s for name in names for s in steps_for(self.spark, self.full(name), self.folders[name], mode)]
        if mode == "overwrite":
            for name in sorted(known_children(self.spark, self.full(main_table)) - children):
                if self.spark.catalog.tableExists(quote_table(self.full(name))):
                    steps += drop_step(self.spark, self.full(name), EXECUTION_DATE, date)
        publish(self.spark, self.run, steps)
        return [main_table, *(name for name in names if name != main_table)]


def _load_at_once(load: _Load, prepared: DataFrame, plan: NormalisationPlan, date: str, moment: Column) -> list[str]:
    """Write the main table and all children to a folder of the run, then publish them together.

    A map's elements are laid out, typed and written while the main table and the arrays are.
    """
    destination = load.destination
    together = {p.lower() for p in load.partitions()} <= {EXECUTION_DATE, TRUSTED_AT}

    def write(name: str, frame: DataFrame) -> list[str]:
        load.write(name, frame)
        return [name]

    def write_map(nested: NestedField) -> list[str]:
        elements = stage_map_elements(prepared, nested, plan.root_id)
        children = map_children(elements, nested)
        if not together:  # partitioned by columns of their own
            write_all([lambda c=c: load.write(c.table, with_audit(map_child(elements, nested, c, plan.root_id), date, moment))
                       for c in children], destination.get("parallelism", 8))
        elif children:
            load.write_map(elements, nested, children, plan.root_id, date, moment)
        return [c.table for c in children]

    writes = [lambda: write(plan.main_table, main_projection(prepared, plan).withColumn(TRUSTED_AT, moment))]
    for nested in plan.arrays:
        frame = with_audit(explode_array(prepared, nested, plan.root_id), date, moment)
        writes.append(lambda n=nested.table, f=frame: write(n, f))
    for nested in plan.maps:
        if nested.kind == "map_array":
            frame = with_audit(map_array_child(prepared, nested, plan.root_id), date, moment)
            writes.append(lambda n=nested.table, f=frame: write(n, f))
        else:
            writes.append(lambda n=nested: write_map(n))
    order = [name for names in write_all(writes, destination.get("parallelism", 8)) for name in names]
    return load.publish(destination.get("write_mode", "append"), order, date)


def trusted_normalise(spark: SparkSession, date: str, config: dict[str, Any]) -> list[str]:
    """The names of the tables written; none for a missing or empty source.

    Every table scans only the columns it needs, and maps are exploded once. Where the tables can be switched (see
    ``sinks.publish``), main and children are written to new folders, the children of a map by one job, and then appear
    together; a run that died is finished or undone by the next one. A repeated run of the same day in append mode that
    finds its committed predecessor unfinished only finishes that. Elsewhere each table is a commit of its own. With
    ``write_mode: overwrite`` and a partition on ``execution_date`` a second run replaces the first.
    """
    source, destination = config["source"], config["destination"]
    mode, partition_by = destination.get("write_mode", "append"), destination.get("partition_by")
    main_table = table_name(destination, destination["database_name"], destination["main_table_name"])
    at_once = can_publish(spark, main_table, partition_by) and (bool(partition_by) or mode == "append")
    finished = recover(spark, main_table) if at_once else {}
    if mode == "append" and date in finished:
        return [name.replace("`", "").split(".")[-1] for name in finished[date]]
    raw = read_date_slice(
        spark, table_name(destination, source["database_name"], source["table_name"]),
        source.get("partition_date_by", "_raw_ingested_at"), date)
    if raw is None or raw.isEmpty():
        return []
    moment = F.lit(datetime.now(timezone.utc)).cast("timestamp")
    prepared = fix_case_conflicts(raw)
    plan = plan_normalisation(prepared, destination["main_table_name"],
                              destination.get("root_id"), destination.get("max_depth", 1))
    if at_once:
        return _load_at_once(_Load(spark, begin(spark, main_table, date), destination), prepared, plan, date, moment)
    return _load_one_by_one(spark, prepared, plan, destination, date, moment)


def _load_one_by_one(spark: SparkSession, prepared: DataFrame, plan: NormalisationPlan, destination: dict[str, Any],
                     date: str, moment: Column) -> list[str]:
    """Every table a commit of its own, children side by side."""
    main = main_projection(prepared, plan).withColumn(TRUSTED_AT, moment)
    children = {name: with_audit(frame, date, moment)
                for name, frame in child_frames(prepared, plan).items()}
    array_tables = {n.table for n in plan.nested}
    database = destination["database_name"]

    def clear_stale(written: set[str]) -> None:
        """Children of earlier runs that have no rows today lose the rows of this run's date."""
        for name in known_children(spark, table_name(destination, database, plan.main_table)) - written:
            if spark.catalog.tableExists(quote_table(table_name(destination, database, name))):
                clear_partition(spark, table_name(destination, database, name), EXECUTION_DATE, date)

    def write(name: str, frame: DataFrame) -> str | None:
        # A map child exists because its key had elements; an array may have none.
        if name in array_tables and frame.isEmpty():
            return None
        create_or_append(
            spark, frame, table_name(destination, destination["database_name"], name),
            destination.get("partition_by"), destination.get("write_mode", "append"),
            destination.get("options"), destination.get("gather", False))
        return name

    write(plan.main_table, main)
    written = write_all([lambda n=n, f=f: write(n, f) for n, f in children.items()],
                        destination.get("parallelism", 8))
    main_table = table_name(destination, database, plan.main_table)
    if destination.get("write_mode", "append") == "overwrite":
        clear_stale({name for name in written if name})
    remember_children(spark, main_table, {name for name in written if name})
    return [plan.main_table, *[name for name in written if name]]
