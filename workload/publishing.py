"""Loads that die and are run again, and loads that part their rows by one write."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from unittest import mock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.plans import csv_load
from sedimenta.plans.raw import raw_ingest
from sedimenta.plans.trusted import trusted_normalise
from sedimenta.scratch import new_database, new_path
from sedimenta.sinks import publish
from sedimenta.sinks.tables import create_or_append, create_table
from sedimenta.sinks.upsert import upsert
from sedimenta.sources.ledger import Ledger
from workload import query
from workload.shapes import nested_orders, table

_DAY = "2024-01-15"


class Died(Exception):
    """Stands for a driver that is gone."""


@contextmanager
def dies_after(steps: int) -> Iterator[None]:
    """A load inside dies once it has done so many steps of its publication."""
    real = publish.apply

    def apply(spark: SparkSession, all_steps: list) -> None:
        real(spark, all_steps[:steps])
        raise Died

    with mock.patch.object(publish, "apply", apply):
        try:
            yield
        except Died:
            return
        raise AssertionError("the load did not publish")


def _raw_orders(spark: SparkSession, records: DataFrame) -> str:
    database = new_database(spark, "raw")
    create_or_append(spark, records.withColumn("execution_date", F.lit(_DAY).cast("date")), f"{database}.orders", ["execution_date"])
    return database


def _trusted(raw: str, trusted: str, mode: str) -> dict:
    return {"source": {"database_name": raw, "table_name": "orders", "partition_date_by": "execution_date"},
            "destination": {"database_name": trusted, "main_table_name": "orders", "partition_by": ["execution_date"],
                            "write_mode": mode}}


def _contents(spark: SparkSession, trusted: str) -> DataFrame:
    """All rows of the order tables, one below the other."""
    none = F.lit(None)
    parts = {
        "orders": ["orderid", none, F.col("Status"), none, F.col("Holding.Priority")],
        "orders_holdings_value": ["orderid", none, F.col("Priority"), F.col("Price"), F.col("holdings_id_ref")],
        "orders_findings_amounts": ["orderid", F.col("_source_key"), F.col("kind"), F.col("amount"), F.col("ref")],
        "orders_findings_history": ["orderid", F.col("_source_key"), F.col("state"), none, F.col("findings_id")],
    }
    names = {"key": "string", "label": "string", "amount": "double", "ref": "string"}
    frames = [
        spark.table(f"{trusted}.{name}").select(
            F.lit(name).alias("table"), columns[0],
            *[c.cast(kind).alias(n) for c, (n, kind) in zip(columns[1:], names.items())],
            F.col("execution_date").cast("string").alias("day"))
        for name, columns in parts.items()]
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


_CONTENTS = f"""
    SELECT 'orders' AS "table", o_orderkey AS orderid, NULL AS key, o_orderstatus AS label, CAST(NULL AS DOUBLE) AS amount,
           o_orderpriority AS ref, '{_DAY}' AS day FROM orders
    UNION ALL SELECT 'orders_holdings_value', o_orderkey, NULL, v.label, o_totalprice * v.times, CAST(o_custkey AS VARCHAR), '{_DAY}'
    FROM orders, LATERAL (VALUES (o_orderpriority, 1), ('double', 2)) v(label, times) WHERE o_orderstatus <> 'P'
    UNION ALL SELECT 'orders_findings_amounts', o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'AMOUNTS' ELSE 'Amounts' END,
           v.kind, v.amount, v.ref, '{_DAY}'
    FROM orders, LATERAL (VALUES ('total', o_totalprice, NULL), ('customer', NULL, CAST(o_custkey AS VARCHAR))) v(kind, amount, ref)
    UNION ALL SELECT 'orders_findings_history', o_orderkey, 'history', CASE o_orderstatus WHEN 'O' THEN 'open' ELSE 'part' END,
           NULL, CAST(o_orderkey AS VARCHAR), '{_DAY}' FROM orders WHERE o_orderstatus <> 'F'"""


@query(_CONTENTS)
def trusted_rerun_after_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day's load dies between two child tables; the next run finds it committed and finishes it: no row twice or missing."""
    raw, trusted = _raw_orders(spark, nested_orders(spark, sf_dir)), new_database(spark, "trusted")
    with dies_after(2):
        trusted_normalise(spark, _DAY, _trusted(raw, trusted, "append"))
    trusted_normalise(spark, _DAY, _trusted(raw, trusted, "append"))
    return _contents(spark, trusted)


@query(_CONTENTS)
def trusted_replaced_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day loaded from other records first: dead half way, replaced by a run over all of them. Every column of every table."""
    trusted = new_database(spark, "trusted")
    orders = nested_orders(spark, sf_dir)
    other = _raw_orders(spark, orders.withColumn("Status", F.lit("X")).where("OrderId % 2 = 0"))
    with dies_after(1):
        trusted_normalise(spark, _DAY, _trusted(other, trusted, "overwrite"))
    trusted_normalise(spark, _DAY, _trusted(_raw_orders(spark, orders), trusted, "overwrite"))
    return _contents(spark, trusted)


@query("""
    SELECT 'orders_lines_line_' || l_linenumber AS "table", l_orderkey AS orderid, l_partkey AS part,
           CASE WHEN l_linenumber % 2 = 0 THEN l_quantity END AS quantity, CASE WHEN l_linenumber % 2 = 1 THEN l_returnflag END AS flag
    FROM lineitem""")
def map_fanout_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A map with a key for each line number, whose elements have different fields: all children by one write."""
    line = F.when(F.col("l_linenumber") % 2 == 0, F.to_json(F.struct(F.col("l_partkey").alias("part"), F.col("l_quantity").alias("quantity")))) \
        .otherwise(F.to_json(F.struct(F.col("l_partkey").alias("part"), F.col("l_returnflag").alias("flag"))))
    keyed = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.collect_list(line).alias("lines"))
    entry = F.struct(F.concat(F.lit("Line_"), F.col("l_linenumber").cast("string")), F.concat(F.lit("["), F.array_join("lines", ","), F.lit("]")))
    orders = keyed.groupBy(F.col("l_orderkey").alias("OrderId")).agg(F.map_from_entries(F.collect_list(entry)).alias("Lines"))
    raw, trusted = _raw_orders(spark, orders), new_database(spark, "trusted")
    names = trusted_normalise(spark, _DAY, _trusted(raw, trusted, "overwrite"))
    parts = []
    for name in names[1:]:
        child = spark.table(f"{trusted}.{name}")
        optional = [F.col(c) if c in child.columns else F.lit(None).cast(kind).alias(c) for c, kind in (("quantity", "double"), ("flag", "string"))]
        parts.append(child.select(F.lit(name).alias("table"), "orderid", "part", *optional))
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first


@query(f"""
    SELECT CASE WHEN role = 'system' THEN 'quarantine' ELSE 'table' END AS part, '{_DAY}' AS day,
           CASE WHEN role <> 'system' THEN conv_id END AS conv_id, CASE WHEN role <> 'system' THEN turn END AS turn,
           CASE WHEN role <> 'system' THEN text ELSE NULL END AS text,
           CASE WHEN role = 'system' THEN true ELSE false END AS cut FROM conversations""")
def raw_reject_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cut records parted from good ones by one parse and one write; the first run dies between the two tables."""
    database, path = new_database(spark, "raw"), new_path(spark, "cut")
    text = F.to_json(F.struct("conv_id", "turn", "role", "text"))
    table(spark, sf_dir, "conversations").select(
        F.when(F.col("role") == "system", F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text)
        .alias("value")).write.text(path)
    config = {
        "source": {"input_path": path, "multi_line": False, "file_pattern": r"^part-.*\.txt$"},
        "destination": {"database": database, "table": "turns", "write_mode": "overwrite",
                        "partition_by": ["execution_date"], "quarantine_table": "cut"}}
    with dies_after(1):
        raw_ingest(spark, _DAY, config)
    raw_ingest(spark, _DAY, config)
    day = F.col("execution_date").cast("string").alias("day")
    good = spark.table(f"{database}.turns").select(F.lit("table").alias("part"), day, "conv_id", "turn", "text", F.lit(False).alias("cut"))
    bad = spark.table(f"{database}.cut").select(
        F.lit("quarantine").alias("part"), day, *(F.lit(None).cast(k).alias(c) for c, k in (("conv_id", "bigint"), ("turn", "bigint"), ("text", "string"))),
        F.col("_corrupt_record").startswith('{"conv_id":').alias("cut"))
    return good.unionByName(bad)


@query(f"""
    SELECT event_id, event_type AS kind, CASE WHEN late THEN user_id END AS user_id, CASE WHEN late THEN value END AS value,
           CASE WHEN late THEN day ELSE '{_DAY}' END AS day, 0 AS lost FROM (
        SELECT *, ts >= TIMESTAMP '2024-01-15' AS late, '2024-01-16' AS day FROM events)""")
def nested_evolution_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second day brings fields inside a struct and inside the structs of an array: stored and readable, null before, none lost."""
    database, folder = new_database(spark, "raw"), new_path(spark, "evolving")
    events = table(spark, sf_dir, "events")
    late = F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz")
    kind = F.struct(F.col("event_type").alias("kind"))
    more = F.struct(F.col("event_type").alias("kind"), F.struct(F.col("user_id").alias("user id")).alias("who"))
    part = F.struct(F.lit(1).alias("n"), F.col("value").alias("value"))
    days = {_DAY: events.where(~late).select("event_id", kind.alias("what"), F.array(F.struct(F.lit(1).alias("n"))).alias("parts")),
            "2024-01-16": events.where(late).select("event_id", more.alias("what"), F.array(part).alias("parts"))}
    lost = 0
    for day, records in days.items():
        records.write.json(f"{folder}/{day}")
        report = raw_ingest(spark, day, {
            "source": {"input_path": f"{folder}/{day}", "multi_line": False, "file_pattern": r"^part-.*\.json$"},
            "destination": {"database": database, "table": "events", "write_mode": "overwrite",
                            "partition_by": ["execution_date"], "evolve_nested": True}})
        lost += sum(report.lost_values.values())
    return spark.table(f"{database}.events").select(
        "event_id", F.col("what.kind").alias("kind"), F.col("what.who.user_id").alias("user_id"),
        F.col("parts")[0]["value"].alias("value"), F.col("execution_date").cast("string").alias("day"), F.lit(lost).alias("lost"))


@query("""
    SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS ts,
           CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice * 2 ELSE o_totalprice END AS amount,
           CASE WHEN o_orderkey % 3 = 0 THEN 'moved' WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS status FROM orders
    WHERE o_orderstatus <> 'F' OR o_orderkey % 3 = 0""")
def upsert_after_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An upsert that moves rows between partitions, empties one and adds rows, dead after one partition and run again."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_orderdate").alias("ts"), F.col("o_totalprice").alias("amount"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"))
    kept = F.coalesce(F.col("status") != "F", F.lit(True))
    moves = F.col("k") % 3 == 0
    name = f"{new_database(spark, 'merge')}.orders"
    # At first: the rows that stay, and those in the emptied partition; other rows that move come new.
    create_or_append(spark, orders.where((kept & ~moves) | (~kept & moves)), name, ["status"])
    batch = orders.where(moves).select(
        "k", (F.col("ts") + F.make_dt_interval(F.lit(1))).alias("ts"), (F.col("amount") * 2).alias("amount"), F.lit("moved").alias("status"))
    with dies_after(1):
        upsert(spark, name, batch, ["k"], "ts")
    upsert(spark, name, batch, ["k"], "ts")
    return spark.table(name)


@query("""
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, s.sink AS sink, 'archived' AS files
    FROM customer, LATERAL (VALUES ('table'), ('orc')) s(sink)""")
def csv_load_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV load dies between its two sinks, more files come, and the next run loads every file once into both."""
    customers = table(spark, sf_dir, "customer")
    database, folder, orc = new_database(spark, "csv"), new_path(spark, "toload"), new_path(spark, "orc")
    create_table(spark, f"{database}.customer", customers.schema)
    config = {"tablename": "customer", "source_path": folder, "archive_path": new_path(spark, "loaded"),
              "orc_location": orc, "database": database}

    def land(rows: DataFrame) -> None:
        rows.write.mode("append").csv(f"{folder}/customer", sep=";", escape='"', header=False)

    land(customers.where("c_custkey % 2 = 0"))
    with mock.patch.object(csv_load, "write_orc", side_effect=Died):
        try:
            csv_load.csv_full_load(spark, config)
        except Died:
            pass
    land(customers.where("c_custkey % 2 = 1"))
    csv_load.csv_full_load(spark, config)
    state = Ledger.open(spark, f"spark_catalog.{database}.customer").rows().agg(F.max_by("state", "moment")).scalar()
    both = spark.table(f"{database}.customer").withColumn("sink", F.lit("table")).unionByName(
        spark.read.orc(orc).withColumn("sink", F.lit("orc")))
    return both.withColumn("files", state)


@query("""
    SELECT event_id, event_type, CAST(ts AS DATE) AS ts_day, false AS left_behind FROM events""")
def create_with_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table made with its rows by one commit: the first try fails while it writes and leaves no table."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    name = f"{new_database(spark, 'created')}.events"
    broken = events.withColumn("event_type", F.when(F.col("event_id") % 1000 == 7, F.raise_error(F.lit("unreadable"))).otherwise(F.col("event_type")))
    try:
        create_or_append(spark, broken, name, ["days(ts)"])
        failed = False
    except Exception as error:
        failed = "unreadable" in str(error)
    left_behind = spark.catalog.tableExists(name) or not failed
    create_or_append(spark, events, name, ["days(ts)"])
    return spark.table(name).select("event_id", "event_type", "ts_day", F.lit(left_behind).alias("left_behind"))
