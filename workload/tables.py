"""Alignment, table writes, evolution and upserts (B*, C7-C13, C21, E*, F3, I*)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.operators.align import align_by_union, align_to, lost_in_alignment, serialise_changed
from sedimenta.operators.merge import latest_per_key, low_watermark, merge_frames, merge_pruned
from sedimenta.scratch import new_database, new_path
from sedimenta.sinks import tables as S
from sedimenta.sinks.files import has_success_marker, write_many, write_orc
from sedimenta.sinks.upsert import upsert
from workload import query
from workload.shapes import table


@query("""
    SELECT c_mktsegment, CAST(c_nationkey AS BIGINT) AS c_nationkey, CAST(NULL AS INTEGER) AS c_name,
           CAST(NULL AS VARCHAR) AS c_phone, CAST(c_custkey AS VARCHAR) AS c_custkey FROM customer""")
def align_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reordered, widened, missing, extra and unfitting columns."""
    stored = T.StructType.fromDDL(
        "c_mktsegment string, C_NATIONKEY bigint, c_name int, c_phone string, c_custkey string")
    aligned = align_to(table(spark, sf_dir, "customer"), stored)
    return aligned.withColumnRenamed("C_NATIONKEY", "c_nationkey")


@query("""
    SELECT CAST(0 AS BIGINT) AS c_mktsegment, CAST(0 AS BIGINT) AS c_nationkey, count(*) AS c_name,
           CAST(0 AS BIGINT) AS c_phone FROM customer""")
def align_loss_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that would not fit the table, per column."""
    stored = T.StructType.fromDDL("c_mktsegment string, c_nationkey bigint, c_name int, c_phone string")
    return lost_in_alignment(table(spark, sf_dir, "customer"), stored)


@query("""
    SELECT p_partkey, p_brand AS brand, p_size AS size, CAST(NULL AS VARCHAR) AS origin,
           p_type AS first_label, p_retailprice AS price_of, p_name AS name_in_map,
           '{"brand":"' || p_brand || '"}' AS as_text,
           p_size IS NULL AS parent_null FROM part""")
def align_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structs, arrays of structs and maps meet the table's types by field name."""
    source = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.struct(F.col("p_size").alias("size"), F.col("p_brand").alias("brand")).alias("spec"),
        F.array(F.struct(F.col("p_name").alias("name"), F.col("p_type").alias("label"))).alias("labels"),
        F.create_map(F.lit("price"), F.col("p_retailprice").cast("string")).alias("facts"),
        F.struct(F.col("p_name").alias("name"), F.col("p_size").alias("size")).alias("words"),
        F.struct(F.col("p_brand").alias("brand")).alias("blob"))
    stored = T.StructType.fromDDL("""
        labels array<struct<label:string, name:string>>, p_partkey bigint,
        spec struct<brand:string, origin:string, size:int>, facts struct<price:double>,
        words map<string,string>, blob string""")
    return align_to(source, stored).select(
        "p_partkey", "spec.brand", "spec.size", "spec.origin",
        F.col("labels")[0]["label"].alias("first_label"), F.col("facts.price").alias("price_of"),
        F.col("words")["name"].alias("name_in_map"), F.col("blob").alias("as_text"),
        F.col("spec").isNull().alias("parent_null"))


@query("""
    SELECT o_orderkey, k.key AS key, k.value AS value, 2 * (SELECT count(*) FROM orders) AS lost FROM orders,
    LATERAL (VALUES (o_orderkey, o_totalprice), (o_custkey + 1000000000, CAST(o_custkey AS DOUBLE))) k(key, value)""")
def align_map_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maps and structs become maps with numbers as keys: names that are no number, and second spellings of one, are counted."""
    customer = (F.col("o_custkey") + 1000000000).cast("string")
    source = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.create_map(F.col("o_orderkey").cast("string"), F.col("o_totalprice"), F.col("o_orderstatus"), F.lit(1.0),
                                   F.concat(F.lit("0"), F.col("o_orderkey").cast("string")), F.lit(2.0),
                                   customer, F.col("o_custkey").cast("double")).alias("m"))
    stored = T.StructType.fromDDL("o_orderkey bigint, m map<bigint,double>")
    lost = lost_in_alignment(source, stored).select("m").scalar()
    return align_to(source, stored).select("o_orderkey", F.explode("m").alias("key", "value")).withColumn("lost", lost)


@query("""
    SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey,
           CAST(NULL AS VARCHAR) AS c_mktsegment FROM supplier""")
def align_union_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union with a table's empty shape: wider types win, missing columns are null."""
    shape = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("s_name"), F.col("c_nationkey").cast("bigint").alias("s_nationkey"),
        "c_mktsegment")
    return align_by_union(table(spark, sf_dir, "supplier").drop("s_acctbal"), shape)


@query("""
    SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey, s_acctbal,
           CAST(NULL AS VARCHAR) AS c_mktsegment FROM supplier""")
def align_union_zero_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with all columns of the supplier."""
    shape = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("s_name"), F.col("c_nationkey").cast("bigint").alias("s_nationkey"),
        "c_mktsegment")
    return align_by_union(table(spark, sf_dir, "supplier"), shape)


@query("""
    SELECT n_nationkey AS id, '{"name":"' || n_name || '","region":' || n_regionkey || '}' AS place_info
    FROM nation""")
def serialise_changed_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A struct whose new type is string is serialised, and takes its new name."""
    df = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("id"),
        F.struct(F.col("n_name").alias("name"), F.col("n_regionkey").alias("region")).alias("place info"))
    after = T.StructType.fromDDL("id int, place_info string")
    return serialise_changed(df, df.schema, after)


def _line_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order with lines: the newest shipment and the largest price."""
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(
        F.max("l_shipdate").alias("ts"), F.max("l_extendedprice").alias("amount"),
        F.max("l_linestatus").alias("status"))


def _order_batch(spark: SparkSession, sf_dir: str, days: int = 0) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"),
        (F.col("o_orderdate") + F.make_dt_interval(F.lit(days))).alias("ts"),
        F.col("o_totalprice").alias("amount"), F.col("o_orderstatus").alias("status"))


_TARGET = """t AS (SELECT l_orderkey AS k, max(l_shipdate) AS ts, max(l_extendedprice) AS amount,
        max(l_linestatus) AS status FROM lineitem GROUP BY 1)"""
_SOURCE = """s AS (SELECT o_orderkey AS k, o_orderdate + INTERVAL {days} DAY AS ts,
        o_totalprice AS amount, o_orderstatus AS status FROM orders)"""
_MERGED = f"""
    WITH {_TARGET}, {_SOURCE.format(days=0)}
    SELECT coalesce(t.k, s.k) AS k,
           CASE WHEN t.k IS NULL OR s.ts >= t.ts THEN s.ts ELSE t.ts END AS ts,
           CASE WHEN t.k IS NULL OR s.ts >= t.ts THEN s.amount ELSE t.amount END AS amount,
           CASE WHEN t.k IS NULL OR s.ts >= t.ts THEN s.status ELSE t.status END AS status
    FROM t FULL OUTER JOIN s ON t.k = s.k"""


@query(_MERGED)
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders merged into the state of their lines: newer rows win, unknown ones are added."""
    return merge_frames(_line_state(spark, sf_dir), _order_batch(spark, sf_dir), ["k"], "ts")


@query(f"""
    WITH {_TARGET}, {_SOURCE.format(days=0)}
    SELECT s.k, s.ts, s.amount, s.status FROM s
    UNION ALL SELECT t.k, t.ts, t.amount, t.status FROM t WHERE t.k NOT IN (SELECT k FROM s)""")
def merge_without_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a timestamp every match takes the source."""
    return merge_frames(_line_state(spark, sf_dir), _order_batch(spark, sf_dir), ["k"])


@query(f"""
    WITH {_TARGET}, {_SOURCE.format(days=400)}, m AS (SELECT min(ts) AS low FROM s)
    SELECT coalesce(t.k, s.k) AS k,
           CASE WHEN t.k IS NULL OR s.ts >= t.ts THEN s.ts ELSE t.ts END AS ts,
           CASE WHEN t.k IS NULL OR s.ts >= t.ts THEN s.amount ELSE t.amount END AS amount,
           CASE WHEN t.k IS NULL OR s.ts >= t.ts THEN s.status ELSE t.status END AS status
    FROM t FULL OUTER JOIN s ON t.k = s.k AND t.ts >= (SELECT low FROM m)""")
def merge_upsert_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only target rows at or above the batch's smallest timestamp may match."""
    return merge_pruned(_line_state(spark, sf_dir), _order_batch(spark, sf_dir, 400), ["k"], "ts", "ts")


@query(_MERGED)
def merge_into_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upsert on a partitioned table; rows move between partitions."""
    name = f"{new_database(spark, 'merge')}.state"
    S.create_or_append(spark, _line_state(spark, sf_dir), name, ["status"])
    batch = S.align_for(spark, _order_batch(spark, sf_dir), name)
    upsert(spark, name, batch, ["k"], "ts")
    return spark.table(name).select("k", "ts", "amount", "status")


@query("""
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
           l_tax, l_returnflag, l_linestatus, l_shipdate FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
            l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST,
            l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST, l_discount DESC NULLS LAST,
            l_tax DESC NULLS LAST, l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) AS rn
        FROM lineitem) WHERE rn = 1""")
def dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per order and line number: the latest shipment."""
    return latest_per_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate")


@query("SELECT min(o_orderdate) AS o_orderdate FROM orders")
def watermark_of_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The smallest timestamp of a batch."""
    return low_watermark(table(spark, sf_dir, "orders"), "o_orderdate")


def _status_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("amount"),
        F.col("o_orderstatus").alias("status"))
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("k"), F.col("l_extendedprice").alias("amount"),
        F.col("l_linestatus").alias("status"))
    return orders, lines


_ORDER_ROWS = "SELECT o_orderkey AS k, o_totalprice AS amount, o_orderstatus AS status FROM orders"
_LINE_ROWS = "SELECT l_orderkey AS k, l_extendedprice AS amount, l_linestatus AS status FROM lineitem"


@query(f"{_ORDER_ROWS} UNION ALL {_LINE_ROWS}")
def append_then_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches appended to a partitioned table."""
    name = f"{new_database(spark, 'appended')}.amounts"
    for batch in _status_rows(spark, sf_dir):
        S.create_or_append(spark, batch, name, ["status"])
    return spark.table(name)


@query(f"{_ORDER_ROWS} WHERE o_orderstatus NOT IN (SELECT l_linestatus FROM lineitem) UNION ALL {_LINE_ROWS}")
def partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second batch replaces the partitions it has, the others stay."""
    name = f"{new_database(spark, 'partitions')}.amounts"
    orders, lines = _status_rows(spark, sf_dir)
    S.create_or_append(spark, orders, name, ["status"], "overwrite")
    S.create_or_append(spark, lines, name, ["status"], "overwrite")
    return spark.table(name)


@query(_LINE_ROWS)
def full_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second batch replaces everything, partitions it lacks included."""
    name = f"{new_database(spark, 'replaced')}.amounts"
    orders, lines = _status_rows(spark, sf_dir)
    S.create_or_append(spark, orders, name, ["status"])
    S.replace_all(lines, name)
    return spark.table(name)


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal, true AS complete FROM supplier")
def orc_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An ORC copy with its success marker."""
    path = new_path(spark, "orc")
    write_orc(table(spark, sf_dir, "supplier"), path)
    return spark.read.orc(path).withColumn("complete", F.lit(has_success_marker(spark, path)))


@query("""
    SELECT sink, count(*) AS records, CAST(sum(c_custkey) AS BIGINT) AS keys FROM customer,
    LATERAL (VALUES ('table'), ('orc')) v(sink) GROUP BY sink""")
def multi_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One batch, computed once, to a table and to ORC."""
    customers = table(spark, sf_dir, "customer")
    name, path = f"{new_database(spark, 'sinks')}.customer", new_path(spark, "orc")
    S.create_table(spark, name, customers.schema)
    write_many(customers, [lambda df: S.replace_all(df, name), lambda df: write_orc(df, path)])
    totals = lambda df, sink: df.agg(
        F.count(F.lit(1)).alias("records"), F.sum("c_custkey").alias("keys")).withColumn("sink", F.lit(sink))
    return totals(spark.table(name), "table").unionByName(totals(spark.read.orc(path), "orc"))


@query("""
    SELECT o_orderkey AS k, o_totalprice AS amount, CAST(NULL AS VARCHAR) AS priority_class FROM orders
    UNION ALL SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders""")
def schema_sync_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later batch brings a new column; earlier rows read null."""
    name = f"{new_database(spark, 'evolved')}.orders"
    orders = table(spark, sf_dir, "orders")
    first = orders.select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("amount"))
    second = orders.select(F.col("o_orderpriority").alias("priority_class"),
                           F.col("o_totalprice").alias("AMOUNT"), F.col("o_orderkey").alias("k"))
    S.create_or_append(spark, first, name)
    S.create_or_append(spark, second, name)
    return spark.table(name).select("k", "amount", "priority_class")


@query("""
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier""")
def write_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validated, synced and aligned writes of two differently shaped batches."""
    name = f"{new_database(spark, 'checked')}.parties"
    customers = table(spark, sf_dir, "customer")
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("c_acctbal"), F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"), F.col("s_suppkey").alias("c_custkey"))
    S.create_table(spark, name, customers.schema)
    for batch in (customers, suppliers):
        S.write_safely(spark, batch, name)
    return spark.table(name)


@query("""
    SELECT event_id, user_id, CAST(ts AS DATE) AS ts_day FROM events""")
def partition_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A days transform on the built-in catalog: a date column of its own."""
    name = f"{new_database(spark, 'daily')}.events"
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    S.create_or_append(spark, events, name, ["days(ts)"])
    return spark.table(name).select("event_id", "user_id", "ts_day")


@query("SELECT event_id, user_id, event_type FROM events")
def partition_by_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bucketed and partitioned table."""
    name = f"{new_database(spark, 'buckets')}.events"
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    S.create_or_append(spark, events, name, ["identity(event_type)", "bucket(4, 'user_id')"])
    return spark.table(name).select("event_id", "user_id", "event_type")
