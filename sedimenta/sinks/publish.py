"""Loads of several tables that show as one: rows go to new folders, a manifest names them, then all tables switch.

A run writes every table's rows below one folder of its own. Once all are there, one file of the manifest lists the steps
that publish them: that file is the commit. Each step may be repeated: a partition is set to its new folder, files of an
append join the partition they belong to, or a partition goes. A run that died before its commit leaves no trace in any
table, and :func:`recover` deletes its folder; one that died later is finished by doing its steps again.

The manifest is a table (``<main table>__runs``), so what was loaded when can be queried. One load at a time may run for
a main table. For tables of the built-in catalog, without buckets; catalogs with commits of their own have theirs.
"""

from __future__ import annotations

import json
import uuid
from base64 import b64decode, b64encode
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions.naming import quote, quote_table
from sedimenta.functions.schema import merge_nested, nullable
from sedimenta.scratch import unsorted_folders
from sedimenta.sinks.files import _hadoop
from sedimenta.sinks.tables import _fields, append, create_table, database_folder, is_v2
from sedimenta.sources.tables import table_schema

BEGUN, COMMITTED, DONE, UNDONE = "begun", "committed", "done", "undone"
SWITCH, MOVE, DROP, RESHAPE = "switch", "move", "drop", "reshape"

#: Table properties: how many schemas an evolving table has had, and each of them, cut to what a catalog stores.
VERSION, SCHEMA_OF = "sedimenta.schema.version", "sedimenta.schema.v"
_PROPERTY_LIMIT = 3500

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
_MANIFEST = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("label", T.StringType()), T.StructField("state", T.StringType()),
    T.StructField("moment", T.TimestampType()), T.StructField("folder", T.StringType()), T.StructField("step", T.IntegerType()),
    T.StructField("kind", T.StringType()), T.StructField("table", T.StringType()), T.StructField("partition", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("target", T.StringType())])


@dataclass(frozen=True)
class Step:
    """``switch``: the partition (folder name or empty) reads ``source`` in place of ``target``. ``move``: the files of
    ``source`` join those of ``target``. ``drop``: the partition goes. ``reshape``: the table is defined anew with the
    schema ``source`` over the same files, as ``target`` says."""

    kind: str
    table: str
    partition: str
    source: str | None
    target: str | None


@dataclass(frozen=True)
class Run:
    """One load: its id, what it loads (the day), its folder and the main table whose manifest it is in."""

    run_id: str
    label: str
    folder: str
    main_table: str


def can_publish(spark: SparkSession, table: str, partition_by: Sequence[str | Column] | None) -> bool:
    """Whether a table with these partitions can be switched: in the built-in catalog and without buckets."""
    plain = all(isinstance(p, str) for p in partition_by or [])
    return plain and not is_v2(spark, table) and all(p.transform != "bucket" for p in _fields(partition_by))


def manifest_table(main_table: str) -> str:
    *path, name = main_table.replace("`", "").split(".")
    return ".".join([*path, f"{name}__runs"])


def _record(spark: SparkSession, run: Run, state: str, steps: Iterable[Step | None] = (None,)) -> None:
    """One file of rows, which the committer renames into place as a whole."""
    rows = [(run.run_id, run.label, state, run.folder, i, *((s.kind, s.table, s.partition, s.source, s.target) if s else (None,) * 5))
            for i, s in enumerate(steps)]
    names = [f.name for f in _MANIFEST.fields if f.name != "moment"]
    schema = T.StructType([_MANIFEST[n] for n in names])
    frame = spark.createDataFrame(rows, schema).coalesce(1).withColumn("moment", F.current_timestamp())
    append(frame.select(*_MANIFEST.fieldNames()), manifest_table(run.main_table))
    spark.catalog.refreshTable(quote_table(manifest_table(run.main_table)))


def begin(spark: SparkSession, main_table: str, label: str) -> Run:
    """A new run with a folder beside the database's tables."""
    name = main_table.replace("`", "").split(".")[-1]
    run_id = uuid.uuid4().hex
    run = Run(run_id, label, f"{database_folder(spark, main_table)}/{name}__loads/{run_id}", main_table)
    create_table(spark, manifest_table(main_table), _MANIFEST)
    _record(spark, run, BEGUN)
    return run


def partition_names(spark: SparkSession, table: str) -> list[str]:
    """A table's partition columns, from its description, which takes no job."""
    described = [r["col_name"] for r in spark.sql(f"DESCRIBE TABLE {quote_table(table)}").collect()]
    if "# Partition Information" not in described:
        return []
    return described[described.index("# Partition Information") + 2:]


def target_schema(spark: SparkSession, table: str, schema: T.StructType, nested: bool = False) -> T.StructType:
    """The table's columns and after them the new ones of ``schema``, as the table will be when the run is published.

    With ``nested`` an evolving table's types also gain the nested fields they lack.
    """
    stored = table_schema(spark, table)
    if stored is None:
        return schema
    known = {f.name.lower() for f in stored.fields}
    fields = stored.fields
    if nested and schema_versions(spark, table):
        fresh = {f.name.lower(): f.dataType for f in schema.fields}
        fields = [T.StructField(f.name, merge_nested(f.dataType, fresh.get(f.name.lower(), f.dataType)), True) for f in fields]
    return T.StructType([*fields, *(f for f in schema.fields if f.name.lower() not in known)])


def stage_rows(run: Run, df: DataFrame, name: str, partitions: Sequence[str]) -> str:
    """Write rows, aligned with their tables, below the run's folder."""
    folder = f"{run.folder}/{name}"
    writer = df.write.mode("error").option("compression", "snappy")
    with unsorted_folders(df.sparkSession):
        (writer.partitionBy(*partitions) if partitions else writer).parquet(folder)
    return folder


def _folders(spark: SparkSession, folder: str, levels: int) -> list[str]:
    """The partition folders below ``folder``, by name (``a=1/b=2``)."""
    fs, root = _hadoop(spark, folder)
    prefix = str(fs.makeQualified(root).toString()).rstrip("/") + "/"
    _, pattern = _hadoop(spark, folder + "/*=*" * levels)
    return sorted(str(s.getPath().toString())[len(prefix):] for s in fs.globStatus(pattern) or [])


def _specification(partition: str) -> str:
    """The partition of a folder name, for ALTER TABLE."""
    parts = []
    for step in partition.split("/"):
        name, value = (unquote(x) for x in step.split("=", 1))
        literal = "null" if value == NULL_PARTITION else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        parts.append(f"{quote(name)} = {literal}")
    return ", ".join(parts)


def location_of(spark: SparkSession, table: str, partition: str = "") -> str | None:
    """Where a table or one of its partitions is; None for a partition it does not have."""
    of = f" PARTITION ({_specification(partition)})" if partition else ""
    try:
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quote_table(table)}{of}").collect()
    except Exception as error:  # the class differs between classic and Connect sessions
        if getattr(error, "getCondition", lambda: None)() in ("PARTITIONS_NOT_FOUND", "NO_SUCH_PARTITION"):
            return None
        raise
    detailed = next(i for i, r in enumerate(rows) if r["col_name"].startswith("# Detailed"))
    return next(r["data_type"] for r in rows[detailed:] if r["col_name"] == "Location")


def steps_for(spark: SparkSession, table: str, folder: str, mode: str) -> list[Step]:
    """The steps that publish staged rows. Overwriting replaces the partitions there are rows for, and only these."""
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unsupported write mode: {mode!r}")
    levels = len(partition_names(spark, table))
    steps = []
    for partition in _folders(spark, folder, levels) if levels else [""]:
        source = f"{folder}/{partition}".rstrip("/")
        there = location_of(spark, table, partition)
        if mode == "append" and there is not None:
            steps.append(Step(MOVE, table, partition, source, there))
        else:
            steps.append(Step(SWITCH, table, partition, source, there))
    return steps


def drop_step(spark: SparkSession, table: str, column: str, value: str) -> list[Step]:
    """The step that removes one value of the only partition column; none where the table has no such partition."""
    if [c.lower() for c in partition_names(spark, table)] != [column.lower()]:
        return []
    there = location_of(spark, table, f"{column}={value}")
    return [] if there is None else [Step(DROP, table, f"{column}={value}", None, there)]


def schema_versions(spark: SparkSession, table: str) -> list[T.StructType]:
    """The schemas that an evolving table has had, oldest first; the last is its own."""
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {quote_table(table)}").collect()}
    versions = []
    for n in range(1, int(found.get(VERSION, 0)) + 1):
        parts = [found[k] for k in sorted((k for k in found if k.startswith(f"{SCHEMA_OF}{n}.")), key=lambda k: int(k.rsplit(".", 1)[1]))]
        versions.append(T.StructType.fromJson(json.loads(b64decode("".join(parts)))))
    return versions


def _version_properties(schemas: Sequence[T.StructType]) -> dict[str, str]:
    properties = {VERSION: str(len(schemas))}
    for n, schema in enumerate(schemas, 1):
        text = b64encode(schema.json().encode()).decode()  # no character that SQL text would have to escape
        properties |= {f"{SCHEMA_OF}{n}.{i // _PROPERTY_LIMIT}": text[i : i + _PROPERTY_LIMIT] for i in range(0, len(text), _PROPERTY_LIMIT)}
    return properties


def create_evolving(spark: SparkSession, table: str, schema: T.StructType, partition_by: Sequence[str]) -> None:
    """A table whose nested types can grow: its definition is apart from its files (external), with its schemas kept."""
    location = f"{database_folder(spark, table)}/{table.replace('`', '').split('.')[-1]}"
    create_table(spark, table, schema, partition_by, location=location, properties=_version_properties([schema]))


def reshape_steps(spark: SparkSession, table: str, schema: T.StructType) -> list[Step]:
    """The step that gives an evolving table the types of ``schema``; none where it has them.

    Old files keep their types: Parquet fields are read by name, so what they lack is null.
    """
    before = table_schema(spark, table)
    versions = schema_versions(spark, table)
    same = {f.name: nullable(f.dataType) for f in before.fields} == {f.name: nullable(f.dataType) for f in schema.fields}
    if same or not versions:
        return []
    partitions = partition_names(spark, table)
    names = [r["partition"] for r in spark.sql(f"SHOW PARTITIONS {quote_table(table)}").collect()] if partitions else []
    columns = [f for f in schema.fields if f.name not in partitions] + [before[p] for p in partitions]
    wider = T.StructType(columns)
    target = {"location": location_of(spark, table), "partition_by": partitions, "properties": _version_properties([*versions, wider]),
              "partitions": {n: location_of(spark, table, n) for n in names}}
    return [Step(RESHAPE, table, "", wider.json(), json.dumps(target))]


def _reshape(spark: SparkSession, step: Step) -> None:
    """Drop the definition and make it anew. Doing it twice gives the same; the files are not touched."""
    target = json.loads(step.target)
    name = quote_table(step.table)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    create_table(spark, step.table, T.StructType.fromJson(json.loads(step.source)), target["partition_by"],
                 location=target["location"], properties=target["properties"])
    clauses = [f"PARTITION ({_specification(n)}) LOCATION '{at}'" for n, at in target["partitions"].items()]
    for i in range(0, len(clauses), 200):
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(clauses[i:i + 200])}")


def _move_files(spark: SparkSession, source: str, target: str) -> None:
    fs, folder = _hadoop(spark, source)
    if not fs.exists(folder):
        return
    _, into = _hadoop(spark, target)
    fs.mkdirs(into)
    for status in fs.listStatus(folder):
        path = status.getPath()
        name = path.getName()
        if name.startswith(("_", ".")):
            continue
        _, new = _hadoop(spark, f"{target.rstrip('/')}/{name}")  # names carry the write's id, so no other file has it
        if not fs.exists(new) and not fs.rename(path, new):
            raise OSError(f"could not move {path} to {target}")


def apply(spark: SparkSession, steps: Sequence[Step]) -> None:
    """Do the steps, of which some or all may have been done before."""
    for s in steps:
        name = quote_table(s.table)
        of = f"PARTITION ({_specification(s.partition)})" if s.partition else ""
        if s.kind == SWITCH:
            if of:
                spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {of} LOCATION '{s.source}'")
            spark.sql(f"ALTER TABLE {name} {of} SET LOCATION '{s.source}'")
        elif s.kind == RESHAPE:
            _reshape(spark, s)
        elif s.kind == MOVE:
            _move_files(spark, s.source, s.target)
        else:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {of}")
    for table in {s.table for s in steps}:
        spark.catalog.refreshTable(quote_table(table))


def _delete(spark: SparkSession, folder: str) -> None:
    fs, path = _hadoop(spark, folder)
    fs.delete(path, True)


def _same_place(spark: SparkSession, one: str, other: str) -> bool:
    (fs, a), (_, b) = _hadoop(spark, one), _hadoop(spark, other)
    return fs.makeQualified(a).equals(fs.makeQualified(b))


def _finish(spark: SparkSession, run: Run, steps: Sequence[Step]) -> None:
    apply(spark, steps)
    for s in steps:  # nothing reads what was replaced any more; a whole table's folder may hold other tables' rows
        if s.kind == SWITCH and s.partition and s.target and not _same_place(spark, s.target, s.source):
            _delete(spark, s.target)
    _record(spark, run, DONE)


def publish(spark: SparkSession, run: Run, steps: Sequence[Step]) -> None:
    """Commit the run and do its steps."""
    _record(spark, run, COMMITTED, steps or (None,))
    _finish(spark, run, steps)


def recover(spark: SparkSession, main_table: str) -> dict[str, list[str]]:
    """Finish or undo what earlier runs left open; of those finished the label and the tables that got rows."""
    name = quote_table(manifest_table(main_table))
    if not spark.catalog.tableExists(name):
        return {}
    spark.catalog.refreshTable(name)
    rows = spark.table(name)
    closed = rows.where(F.col("state").isin(DONE, UNDONE)).select("run_id")
    # The manifest has some rows for each run; those of open runs are few.
    still_open = rows.join(closed, "run_id", "left_anti").orderBy("moment", "run_id", "step").collect()
    finished = {}
    for run_id in dict.fromkeys(r["run_id"] for r in still_open):
        mine = [r for r in still_open if r["run_id"] == run_id]
        run = Run(run_id, mine[0]["label"], mine[0]["folder"], main_table)
        committed = [r for r in mine if r["state"] == COMMITTED]
        if committed:
            steps = [Step(r["kind"], r["table"], r["partition"], r["source"], r["target"]) for r in committed if r["kind"]]
            _finish(spark, run, steps)
            finished[run.label] = list(dict.fromkeys(s.table for s in steps if s.kind in (SWITCH, MOVE)))
        else:
            _delete(spark, run.folder)
            _record(spark, run, UNDONE)
    return finished
