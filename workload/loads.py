"""Sources and whole loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.plans.csv_load import csv_full_load
from sedimenta.plans.raw import raw_ingest
from sedimenta.plans.sql_load import sql_to_table
from sedimenta.plans.trusted import trusted_normalise
from sedimenta.scratch import new_database, new_path
from sedimenta.sinks.tables import create_or_append, create_table
from sedimenta.sources.csv_scan import read_csv_like
from sedimenta.sources.files import files_for_date, has_files
from sedimenta.sources.json_scan import read_json
from sedimenta.sources.sql_text import date_window, read_sql
from sedimenta.sources.tables import read_date_slice
from sedimenta.streaming.csv_stream import run_csv_stream
from workload import query
from workload.shapes import as_dated_json_files, nested_orders, table

_DAY = "2024-01-15"


def _event_table(spark: SparkSession, sf_dir: str) -> str:
    """The given events as a catalog table, in place."""
    name = f"{new_database(spark, 'slices')}.events"
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{sf_dir}/events.parquet'")
    return name


@query(f"""
    SELECT event_id, user_id, event_type, value FROM events WHERE CAST(ts AS DATE) = DATE '{_DAY}'""")
def date_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day of a table; the scan skips row groups of other days."""
    day = read_date_slice(spark, _event_table(spark, sf_dir), "ts", _DAY)
    return day.select("event_id", "user_id", "event_type", "value")


def _sql_file(spark: SparkSession, text: str) -> str:
    path = new_path(spark, "sql")
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    return path


@query(f"""
    SELECT event_type, count(*) AS events, max(value) AS largest FROM events
    WHERE ts >= TIMESTAMP '{_DAY}' AND ts < TIMESTAMP '2024-01-16' GROUP BY event_type""")
def sql_file_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A SQL file with its window in both notations."""
    name = _event_table(spark, sf_dir)
    path = _sql_file(spark, f"""
        SELECT event_type, count(*) AS events, max(value) AS largest FROM {name}
        WHERE ts >= '{{start_date}}' AND ts < CAST(:end_date AS TIMESTAMP_NTZ) GROUP BY event_type""")
    return read_sql(spark, path, *date_window(_DAY))


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def csv_headerless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Semicolon CSV read with the schema of a table."""
    suppliers = table(spark, sf_dir, "supplier")
    name, path = f"{new_database(spark, 'csv')}.supplier", new_path(spark, "csv")
    create_table(spark, name, suppliers.schema)
    suppliers.write.csv(path, sep=";", escape='"', header=False)
    return read_csv_like(spark, path, name)


@query(f"""
    SELECT event_id, event_type, value FROM events WHERE CAST(ts AS DATE) = DATE '{_DAY}'""")
def file_date_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files chosen by the date in their base names."""
    events = table(spark, sf_dir, "events").select(
        "event_id", "event_type", "value", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    path = as_dated_json_files(events, "day", "dated")
    files = files_for_date(spark, path, _DAY, r"^export-{date}-\d+\.json$")
    return read_json(spark, files, multi_line=False).records.select("event_id", "event_type", "value")


@query(f"""
    SELECT event_id, event_type, value, DATE '{_DAY}' AS execution_date FROM events
    WHERE CAST(ts AS DATE) = DATE '{_DAY}'
    UNION ALL SELECT event_id, event_type, value, DATE '2024-01-16' FROM events
    WHERE CAST(ts AS DATE) = DATE '2024-01-16'""")
def raw_ingest_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days ingested; one of them twice, which replaces it."""
    database = new_database(spark, "raw")
    events = table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.col("value").alias("raw value"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"))
    config = {
        "source": {"input_path": as_dated_json_files(events, "day", "landing"), "multi_line": False},
        "destination": {"database": database, "table": "events", "write_mode": "overwrite",
                        "partition_by": ["execution_date"]}}
    for day in (_DAY, "2024-01-16", _DAY):
        raw_ingest(spark, day, config)
    return spark.table(f"{database}.events").select(
        "event_id", "event_type", F.col("raw_value").alias("value"), "execution_date")


@query(f"""
    SELECT CASE WHEN role = 'system' THEN 'quarantine' ELSE 'table' END AS part, DATE '{_DAY}' AS execution_date,
           count(*) AS records, max(CASE WHEN role <> 'system' THEN turn END) AS last_turn
    FROM conversations GROUP BY 1""")
def raw_quarantine_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day with cut records ingested twice: the second run replaces the first in both tables."""
    database, path = new_database(spark, "raw"), new_path(spark, "cut")
    text = F.to_json(F.struct("conv_id", "turn", "role", "text"))
    table(spark, sf_dir, "conversations").select(
        F.when(F.col("role") == "system", F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text)
        .alias("value")).write.text(path)
    config = {
        "source": {"input_path": path, "multi_line": False, "file_pattern": r"^part-.*\.txt$"},
        "destination": {"database": database, "table": "turns", "write_mode": "overwrite",
                        "partition_by": ["execution_date"], "quarantine_table": "cut"}}
    for _ in range(2):
        raw_ingest(spark, _DAY, config)
    parts = [spark.table(f"{database}.{name}").groupBy(F.lit(part).alias("part"), "execution_date").agg(
        F.count(F.lit(1)).alias("records"), turn.alias("last_turn"))
        for name, part, turn in (("turns", "table", F.max("turn")), ("cut", "quarantine", F.max(F.lit(None).cast("bigint"))))]
    return parts[0].unionByName(parts[1])


@query("""
    SELECT 'orders' AS "table", count(*) AS records, count(DISTINCT o_orderkey) AS ids FROM orders
    UNION ALL SELECT 'orders_holdings_value', 2 * count(*), count(*) FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL SELECT 'orders_findings_amounts', 2 * count(*), count(*) FROM orders
    UNION ALL SELECT 'orders_findings_history', count(*), count(*) FROM orders WHERE o_orderstatus <> 'F'""")
def trusted_normalise_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw table normalised into main and child tables; the second run replaces the first."""
    raw, trusted = new_database(spark, "raw"), new_database(spark, "trusted")
    day = F.lit(_DAY).cast("date")
    create_or_append(spark, nested_orders(spark, sf_dir).withColumn("execution_date", day),
                     f"{raw}.orders", ["execution_date"])
    config = {
        "source": {"database_name": raw, "table_name": "orders", "partition_date_by": "execution_date"},
        "destination": {"database_name": trusted, "main_table_name": "orders",
                        "partition_by": ["execution_date"], "write_mode": "overwrite"}}
    trusted_normalise(spark, _DAY, config)
    names = trusted_normalise(spark, _DAY, config)
    parts = [spark.table(f"{trusted}.{n}").agg(
        F.count(F.lit(1)).alias("records"), F.count_distinct("orderid").alias("ids"),
    ).select(F.lit(n).alias("table"), "records", "ids") for n in names]
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first


@query("""
    SELECT k, max(ts) AS ts, count(*) AS versions FROM (
        SELECT l_orderkey AS k, max(l_shipdate) AS ts FROM lineitem GROUP BY 1
        UNION ALL SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
    ) GROUP BY k""")
def sql_to_table_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query loaded twice by merge, after another one filled the table."""
    source, target = new_database(spark, "source"), new_database(spark, "target")
    for name in ("orders", "lineitem"):
        spark.sql(f"CREATE TABLE {source}.{name} USING parquet LOCATION '{sf_dir}/{name}.parquet'")
    config = lambda text: {
        "source": {"query_path": _sql_file(spark, text)},
        "destination": {
            "database_name": target, "table_name": "state", "write_mode": "merge",
            "options": {"merge_config": {"primary_key": ["k"], "timestamp_column": "ts"}}}}
    lines = f"SELECT l_orderkey AS k, l_shipdate AS ts FROM {source}.lineitem"
    older = f"""SELECT o_orderkey AS k, CASE WHEN o_orderkey IN (SELECT l_orderkey FROM {source}.lineitem)
                THEN TIMESTAMP_NTZ '1990-01-01' ELSE o_orderdate END AS ts FROM {source}.orders"""
    for text in (lines, older, older):
        sql_to_table(spark, config(text), *date_window(_DAY))
    return spark.table(f"{target}.state").groupBy("k").agg(
        F.max("ts").alias("ts"), F.count(F.lit(1)).alias("versions"))


def _event_load(spark: SparkSession, sf_dir: str, database: str, mode: str) -> dict:
    """A day's events by SQL into a table partitioned by their type."""
    events = _event_table(spark, sf_dir)
    text = f"""SELECT event_id, value, event_type FROM {events} WHERE ts >= '{{start_date}}' AND ts < CAST(:end_date AS TIMESTAMP_NTZ)"""
    return {"source": {"query_path": _sql_file(spark, text)},
            "destination": {"database_name": database, "table_name": "events", "write_mode": mode, "partition_by": ["event_type"]}}


@query("""
    SELECT event_id, event_type, value, count(*) AS copies FROM events
    CROSS JOIN (VALUES (DATE '2024-01-15'), (DATE '2024-01-16'), (DATE '2024-01-16')) d(day)
    WHERE CAST(ts AS DATE) = d.day GROUP BY ALL""")
def sql_to_table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days appended by a windowed query, the second one twice."""
    database = new_database(spark, "target")
    for day in (_DAY, "2024-01-16", "2024-01-16"):
        sql_to_table(spark, _event_load(spark, sf_dir, database, "append"), *date_window(day))
    return spark.table(f"{database}.events").groupBy("event_id", "event_type", "value").agg(F.count(F.lit(1)).alias("copies"))


@query("""
    WITH late AS (SELECT * FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-16')
    SELECT event_id, event_type, value FROM late
    UNION ALL SELECT event_id, event_type, value FROM events
    WHERE CAST(ts AS DATE) = DATE '2024-01-15' AND event_type NOT IN (SELECT event_type FROM late)""")
def sql_to_table_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second day replaces the partitions it has rows for, and keeps the others."""
    database = new_database(spark, "target")
    for day in (_DAY, "2024-01-16"):
        sql_to_table(spark, _event_load(spark, sf_dir, database, "overwrite"), *date_window(day))
    return spark.table(f"{database}.events").select("event_id", "event_type", "value")


@query("""
    SELECT l.load, l.loaded, (SELECT count(*) FROM orders) AS records
    FROM (VALUES ('trusted', 0), ('sql', 0), ('csv', 0), ('raw', 0)) l(load, loaded)""")
def empty_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads of a day without rows: none of the four writes anything, and what was there stays."""
    database = new_database(spark, "empty")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderdate").alias("at"))
    dated = orders.withColumn("execution_date", F.lit(_DAY).cast("date"))
    for name in ("raw", "trusted", "sql", "csv"):
        create_or_append(spark, dated if name in ("raw", "trusted") else orders, f"{database}.{name}",
                         ["execution_date"] if name in ("raw", "trusted") else None)
    never = "1999-01-01"
    path, landing = new_path(spark, "toload"), new_path(spark, "landing")
    orders.where("false").write.csv(f"{path}/csv", sep=";")
    orders.limit(1).write.json(landing)
    loaded = {
        "trusted": len(trusted_normalise(spark, never, {
            "source": {"database_name": database, "table_name": "raw", "partition_date_by": "execution_date"},
            "destination": {"database_name": database, "main_table_name": "trusted", "partition_by": ["execution_date"], "write_mode": "overwrite"}})),
        "sql": sql_to_table(spark, {
            "source": {"query_path": _sql_file(spark, f"SELECT k, at FROM {database}.raw WHERE at >= '{{start_date}}' AND at < '{{end_date}}'")},
            "destination": {"database_name": database, "table_name": "sql", "write_mode": "append"}}, never, never),
        "csv": csv_full_load(spark, {"tablename": "csv", "source_path": path, "archive_path": new_path(spark, "done"),
                                     "orc_location": new_path(spark, "orc"), "database": database}),
        "raw": raw_ingest(spark, never, {"source": {"input_path": landing}, "destination": {"database": database, "table": "raw"}}).files}
    parts = [spark.table(f"{database}.{name}").agg(F.count(F.lit(1)).alias("records")).select(
        F.lit(name).alias("load"), F.lit(n).alias("loaded"), "records") for name, n in loaded.items()]
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first


def _csv_inputs(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Customers as CSV below a source folder, and the table that gives the schema."""
    customers = table(spark, sf_dir, "customer")
    database, folder = new_database(spark, "csv"), new_path(spark, "toload")
    create_table(spark, f"{database}.customer", customers.schema)
    customers.write.csv(f"{folder}/customer", sep=";", escape='"', header=False)
    return database, folder


@query("""
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, s.sink AS sink, false AS inputs_left
    FROM customer, LATERAL (VALUES ('table'), ('orc')) s(sink)""")
def csv_full_load_archived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV to table and ORC; afterwards the inputs are in the archive."""
    database, folder = _csv_inputs(spark, sf_dir)
    orc, archive = new_path(spark, "orc"), new_path(spark, "loaded")
    csv_full_load(spark, {
        "tablename": "customer", "source_path": folder, "archive_path": archive,
        "orc_location": orc, "database": database})
    left = has_files(spark, f"{folder}/customer") or not has_files(spark, f"{archive}/customer")
    both = spark.table(f"{database}.customer").withColumn("sink", F.lit("table")).unionByName(
        spark.read.orc(orc).withColumn("sink", F.lit("orc")))
    return both.withColumn("inputs_left", F.lit(left))


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_stream_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same load as a file stream that runs until its input is used up."""
    database, folder = _csv_inputs(spark, sf_dir)
    run_csv_stream(spark, f"{folder}/customer", f"{database}.customer", new_path(spark, "orc"),
                   new_path(spark, "archive"), new_path(spark, "progress")).awaitTermination()
    return spark.table(f"{database}.customer")
