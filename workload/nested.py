"""Normalisation of nested records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.operators import nested as N
from sedimenta.plans.trusted import child_frames
from workload import query
from workload.shapes import document_lines, nested_orders, table

_AMOUNTS = """
    SELECT o_orderkey AS orderid, CAST(o_orderkey AS VARCHAR) AS findings_id,
           CASE WHEN o_orderstatus = 'P' THEN 'AMOUNTS' ELSE 'Amounts' END AS _source_key,
           'total' AS kind, o_totalprice AS amount, CAST(NULL AS BIGINT) AS ref FROM orders
    UNION ALL
    SELECT o_orderkey, CAST(o_orderkey AS VARCHAR),
           CASE WHEN o_orderstatus = 'P' THEN 'AMOUNTS' ELSE 'Amounts' END,
           'customer', NULL, o_custkey FROM orders"""

_HOLDING_VALUES = """
    SELECT o_orderkey AS orderid, o_custkey AS holdings_id_ref, o_totalprice AS Price,
           o_orderpriority AS Priority FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL
    SELECT o_orderkey, o_custkey, o_totalprice * 2, 'double' FROM orders WHERE o_orderstatus <> 'P'"""

_LINES = """
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
           CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INTEGER) AS position
    FROM documents"""


@query(_LINES)
def array_child_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line of every document, with the document's id."""
    docs = document_lines(spark, sf_dir)
    plan = N.plan_normalisation(docs, "documents")
    return N.explode_array(docs, plan.arrays[0], plan.root_id)


@query("""
    SELECT doc_id, unnest(string_split(line, ' ')) AS word FROM (
        SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)""")
def array_grandchild_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays inside the elements of a child: one explode per level."""
    docs = document_lines(spark, sf_dir, words=True)
    plan = N.plan_normalisation(docs, "documents", max_depth=2)
    words = next(a for a in plan.arrays if len(a.steps) == 2)
    return N.explode_array(docs, words, plan.root_id)


@query(_HOLDING_VALUES)
def array_in_struct_child(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An array inside a struct, with the struct's id as a second key."""
    orders = nested_orders(spark, sf_dir)
    plan = N.plan_normalisation(orders, "orders")
    return N.explode_array(orders, plan.arrays[0], plan.root_id)


@query("""
    SELECT o_orderkey AS orderid, k.key AS key, k.value AS value, CAST(o_orderkey AS VARCHAR) AS parent_id
    FROM orders, LATERAL (VALUES
        ('id', CAST(o_orderkey AS VARCHAR)), ('priority', o_orderpriority),
        ('tags', '["' || o_orderstatus || '","' || o_orderpriority || '"]'),
        ('history', CASE o_orderstatus WHEN 'O' THEN '[{"state":"open"},"late"]'
                         WHEN 'F' THEN '[{"state":"fin' ELSE '[{"state":"part"}]' END)) k(key, value)""")
def map_entries_with_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map entries with root id and map id, without the long amounts."""
    orders = nested_orders(spark, sf_dir)
    plan = N.plan_normalisation(orders, "orders")
    return (N.map_entries(orders, plan.maps[0], plan.root_id)
            .where(F.lower("_source_key") != "amounts")
            .select("orderid", F.col("_source_key").alias("key"), F.col("_value").alias("value"),
                    F.col("findings_id").alias("parent_id")))


@query("""
    SELECT o_orderkey AS orderid, k.key AS key, k.value AS value, k.arrays AS arrays, k.total AS total,
           k.customer AS customer, CAST(o_orderkey AS VARCHAR) AS parent_id
    FROM orders, LATERAL (VALUES
        (CASE WHEN o_orderstatus = 'P' THEN 'AMOUNTS' ELSE 'Amounts' END, NULL, 2, o_totalprice, o_custkey),
        ('id', CAST(o_orderkey AS VARCHAR), NULL, NULL, NULL), ('priority', o_orderpriority, NULL, NULL, NULL),
        ('tags', '["' || o_orderstatus || '","' || o_orderpriority || '"]', NULL, NULL, NULL),
        ('history', CASE o_orderstatus WHEN 'O' THEN '[{"state":"open"},"late"]'
                         WHEN 'F' THEN '[{"state":"fin' ELSE '[{"state":"part"}]' END, NULL, NULL, NULL))
        k(key, value, arrays, total, customer)""")
def map_entries_all_with_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All map entries with root id and map id, the texts of amounts read as numbers."""
    orders = nested_orders(spark, sf_dir)
    plan = N.plan_normalisation(orders, "orders")
    long = F.lower("_source_key") == "amounts"
    read = F.when(long, F.from_json("_value", "array<struct<kind:string,amount:double,ref:bigint>>"))
    return N.map_entries(orders, plan.maps[0], plan.root_id).select(
        "orderid", F.col("_source_key").alias("key"), F.when(~long, F.col("_value")).alias("value"),
        F.when(long, F.size(read)).alias("arrays"), read[0]["amount"].alias("total"), read[1]["ref"].alias("customer"),
        F.col("findings_id").alias("parent_id"))


@query("""
    SELECT DISTINCT CASE WHEN o_orderstatus = 'P' THEN 'AMOUNTS' ELSE 'Amounts' END AS key FROM orders
    UNION SELECT 'history' FROM orders""")
def map_object_array_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys that hold arrays of objects."""
    orders = nested_orders(spark, sf_dir)
    plan = N.plan_normalisation(orders, "orders")
    return N.object_array_keys(orders, plan.maps[0], plan.root_id)


@query("""
    SELECT 'orders_findings_amounts' AS child, 'amounts' AS key, 2 * count(*) AS elements,
           'struct<amount:double,kind:string,ref:bigint>' AS element FROM orders
    UNION ALL
    SELECT 'orders_findings_history', 'history', count(*) FILTER (o_orderstatus <> 'F'),
           'struct<state:string>' FROM orders""")
def map_child_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The children a map gives: table, key, element count and inferred element type."""
    orders = nested_orders(spark, sf_dir)
    plan = N.plan_normalisation(orders, "orders")
    elements = N.stage_map_elements(orders, plan.maps[0], plan.root_id)
    children = N.map_children(elements, plan.maps[0])
    return spark.createDataFrame(
        [(c.table, c.key, c.elements, c.element.simpleString()) for c in children],
        "child string, key string, elements bigint, element string")


@query(_AMOUNTS)
def map_child_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One key's JSON objects as a table, both spellings of the key together."""
    orders = nested_orders(spark, sf_dir)
    return child_frames(orders, N.plan_normalisation(orders, "orders"))["orders_findings_amounts"]


@query("""
    SELECT o_orderkey AS orderid, CAST(o_orderkey AS VARCHAR) AS findings_id,
           'history' AS _source_key,
           CASE o_orderstatus WHEN 'O' THEN 'open' ELSE 'part' END AS state
    FROM orders WHERE o_orderstatus <> 'F'""")
def map_child_mixed_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The objects of arrays that also hold other elements."""
    orders = nested_orders(spark, sf_dir)
    return child_frames(orders, N.plan_normalisation(orders, "orders"))["orders_findings_history"]


@query("""
    SELECT 'history' AS key, count(*) AS rejected_values FROM orders WHERE o_orderstatus <> 'P'""")
def map_child_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values no child takes in full: cut text, and arrays with other elements."""
    orders = nested_orders(spark, sf_dir)
    plan = N.plan_normalisation(orders, "orders")
    return N.map_rejects(orders, plan.maps[0], plan.root_id)


@query("""
    SELECT k.key AS key, count(*) AS records, min(k.value) AS least FROM orders, LATERAL (VALUES
        ('id', CAST(o_orderkey AS VARCHAR)), ('priority', o_orderpriority),
        ('tags', '["' || o_orderstatus || '","' || o_orderpriority || '"]'),
        ('history', CASE o_orderstatus WHEN 'O' THEN '[{"state":"open"},"late"]'
                         WHEN 'F' THEN '[{"state":"fin' END)) k(key, value)
    WHERE k.value IS NOT NULL GROUP BY k.key""")
def map_prune_by_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays in the map: everything no child holds in full."""
    kept = nested_orders(spark, sf_dir).select(
        F.explode(N.prune_map(F.col("Findings"))).alias("key", "value"))
    return kept.groupBy("key").agg(F.count(F.lit(1)).alias("records"), F.min("value").alias("least"))


@query("""
    SELECT o_orderkey AS OrderId, o_orderstatus AS Status,
           CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS holdings_id,
           o_orderstatus = 'P' AS holdings_missing, o_orderdate AS Date,
           o_orderpriority AS Priority,
           CASE WHEN o_orderstatus = 'P' THEN 3 ELSE 4 END AS findings_left FROM orders""")
def main_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The root rows without the extracted fields; a missing struct stays missing."""
    orders = nested_orders(spark, sf_dir)
    main = N.main_projection(orders, N.plan_normalisation(orders, "orders"))
    return main.select(
        "OrderId", "Status", F.col("Holdings.id").alias("holdings_id"),
        F.col("Holdings").isNull().alias("holdings_missing"), "Holding.Date",
        "Holding.Priority", F.size("Findings").alias("findings_left"))


@query("""
    SELECT o_orderkey AS orderid, m._source_key AS _source_key, m.amount AS amount FROM orders,
    LATERAL (VALUES (o_orderstatus, o_totalprice), (o_orderstatus, o_totalprice * 2),
                    ('all', o_totalprice)) m(_source_key, amount)""")
def map_of_arrays_child(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A map whose values are arrays of structs already: one child for all keys."""
    amount = "struct<amount:double>"
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("OrderId"),
        F.create_map(
            F.col("o_orderstatus"), F.array(F.struct("o_totalprice").cast(amount),
                                            F.struct(F.col("o_totalprice") * 2).cast(amount)),
            F.lit("all"), F.array(F.struct("o_totalprice").cast(amount))).alias("amounts"))
    plan = N.plan_normalisation(orders, "orders")
    return N.map_array_child(orders, plan.maps[0], plan.root_id)


@query("""
    SELECT n_nationkey AS id_, n_name AS id, n_regionkey AS id__ FROM nation""")
def case_conflict_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three names equal up to case become three names."""
    return N.fix_case_conflicts(table(spark, sf_dir, "nation").toDF("Id", "id", "ID"))


@query("""
    SELECT 'orders_holdings_value' AS child, 2 * count(*) AS records FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL SELECT 'orders_findings_amounts', 2 * count(*) FROM orders
    UNION ALL SELECT 'orders_findings_history', count(*) FROM orders WHERE o_orderstatus <> 'F'""")
def child_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every child of one plan."""
    orders = nested_orders(spark, sf_dir)
    children = child_frames(orders, N.plan_normalisation(orders, "orders"))
    counts = [frame.agg(F.count(F.lit(1)).alias("records")).select(F.lit(name).alias("child"), "records")
              for name, frame in children.items()]
    first, *rest = counts
    for other in rest:
        first = first.unionByName(other)
    return first


@query("""
    SELECT o_orderkey AS orderid, CAST(CASE o_orderkey % 3 WHEN 0 THEN CAST(9007199254740993 + o_orderkey AS DECIMAL(20,4))
               WHEN 1 THEN CAST(o_orderkey AS DECIMAL(20,4)) + CAST(0.125 AS DECIMAL(20,4))
               ELSE CAST(0.0025 AS DECIMAL(20,4)) END AS DECIMAL(20,4)) AS mixed,
           CASE o_orderkey % 3 WHEN 0 THEN CAST(o_orderkey AS DOUBLE) WHEN 1 THEN 1.5 ELSE 100.0 END AS small,
           CAST(o_orderkey AS BIGINT) AS whole, 'decimal(20,4)' AS kind FROM orders""")
def map_numbers_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Longs past a double's digits, decimals and doubles in one field of a map's elements: one exact type for all."""
    key = F.col("o_orderkey").cast("string")
    first = F.col("o_orderkey") % 3
    mixed = F.when(first == 0, (F.lit(9007199254740993) + F.col("o_orderkey")).cast("string")).when(
        first == 1, F.concat(key, F.lit(".1250"))).otherwise("2.5e-3")
    small = F.when(first == 0, key).when(first == 1, "1.50").otherwise("1e2")
    text = F.format_string('[{"mixed": %s, "small": %s, "whole": %s}]', mixed, small, key)
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("OrderId"), F.create_map(F.lit("n"), text).alias("M"))
    plan = N.plan_normalisation(orders, "orders")
    elements = N.stage_map_elements(orders, plan.maps[0], plan.root_id)
    child, = N.map_children(elements, plan.maps[0])
    rows = N.map_child(elements, plan.maps[0], child, plan.root_id)
    return rows.select("orderid", "mixed", "small", "whole", F.lit(rows.schema["mixed"].dataType.simpleString()).alias("kind"))
