"""Profiles, key scans and lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.functions.json_values import looks_like_array, looks_like_object_array
from sedimenta.operators import profile as P
from sedimenta.operators.lookup import find_record, inspect_key
from sedimenta.plans.suggest import suggest_tables
from workload import query
from workload.shapes import document_lines, order_findings, table


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    return table(spark, sf_dir, "documents").join(labels, "doc_id", "left")


def _documents_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(spark, sf_dir).select("doc_id", F.to_json(F.struct(
        "doc_id", "text", "lang", "quality",
        (F.col("n_chars") / 8).alias("eighths"), (F.col("n_chars") > 1000).alias("long"),
        F.split("text", "\n", -1).alias("lines"),
        F.struct("source").alias("origin"))).alias("json"))


_PROFILE = """
    WITH d AS (SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))
    SELECT f.field AS field, f.type AS type, sum(f.hit) AS filled,
           round(sum(f.hit) / count(*) * 100, 1) AS filled_pct
    FROM d, LATERAL (VALUES {values}) f(field, type, hit)
    GROUP BY f.field, f.type"""


@query(_PROFILE.format(values="""('doc_id', 'integer', 1), ('text', 'string', 1), ('lang', 'string', 1),
    ('quality', 'integer', CASE WHEN quality IS NULL THEN 0 ELSE 1 END), ('eighths', 'float', 1),
    ('long', 'boolean', 1), ('lines', 'array', 1), ('origin', 'object', 1)""").replace(
    "sum(f.hit) AS filled,", "CAST(sum(f.hit) AS BIGINT) AS filled,"))
def field_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dominant type and fill of every field of JSON documents."""
    return P.field_profile(_documents_json(spark, sf_dir), "json")


@query(_PROFILE.format(values="""('doc_id', 'integer', 1), ('text', 'string', 1), ('lang', 'string', 1),
    ('source', 'string', 1), ('n_chars', 'integer', 1),
    ('quality', 'integer', CASE WHEN quality IS NULL THEN 0 ELSE 1 END),
    ('toxic', 'integer', CASE WHEN toxic IS NULL THEN 0 ELSE 1 END)""").replace(
    "sum(f.hit) AS filled,", "CAST(sum(f.hit) AS BIGINT) AS filled,"))
def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for a typed frame, in one aggregation."""
    return P.column_profile(_labelled(spark, sf_dir))


@query("""
    SELECT event_type AS key, 'integer' AS type, count(*) AS records FROM events
    WHERE value < 10 GROUP BY 1
    UNION ALL SELECT event_type, 'string', count(*) FROM events WHERE value >= 10 GROUP BY 1
    UNION ALL SELECT 'note', 'null', count(*) FROM events""")
def field_type_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types per field where one field holds several."""
    events = table(spark, sf_dir, "events")
    value = F.when(F.col("value") < 10, F.col("user_id").cast("string")).otherwise(
        F.concat(F.lit('"'), F.col("event_type"), F.lit('"')))
    docs = events.select(F.concat(F.lit('{"'), F.col("event_type"), F.lit('":'), value,
                                  F.lit(',"note":null}')).alias("json"))
    return P.field_types(docs, "json")


@query("""
    SELECT avg(n) AS mean_items, CAST(max(n) AS INTEGER) AS max_items,
           count(*) FILTER (n > 0) AS records_with_items
    FROM (SELECT len(string_split(text, chr(10))) AS n FROM documents)""")
def array_length_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and largest number of lines per document."""
    return P.array_lengths(document_lines(spark, sf_dir), "snippet")


@query("""
    SELECT count(DISTINCT line) AS distinct_items FROM (
        SELECT unnest(string_split(text, chr(10))) AS line FROM documents)""")
def distinct_array_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct lines over all documents."""
    lines = table(spark, sf_dir, "documents").select(F.split("text", "\n", -1).alias("lines"))
    return P.distinct_items(lines, "lines")


@query("""
    SELECT count(DISTINCT event_type || '_' || strftime(ts, '%d')) AS distinct_keys,
           count(DISTINCT event_type || '_' || strftime(ts, '%d')) > 8 AS variable_schema FROM events""")
def distinct_map_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many keys a dynamic object has over all records."""
    maps = table(spark, sf_dir, "events").select(F.create_map(
        F.concat_ws("_", "event_type", F.date_format("ts", "dd")), "value").alias("m"))
    return P.distinct_keys(maps, "m")


@query("""
    SELECT count(DISTINCT key) AS distinct_keys, count(DISTINCT key) > 5 AS variable_schema FROM (
        SELECT event_type || '_' || strftime(ts, '%d') AS key FROM events UNION ALL SELECT 'all' FROM events)""")
def distinct_element_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many keys the objects of an array have over all records."""
    key = F.concat_ws("_", "event_type", F.date_format("ts", "dd"))
    arrays = table(spark, sf_dir, "events").select(F.array(
        F.create_map(key, "value"), F.create_map(F.lit("all"), "value")).alias("a"))
    return P.distinct_element_keys(arrays, "a")


def _findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", order_findings().alias("findings"))


_FINDING_KINDS = """
    WITH k AS (
        SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'AMOUNTS' ELSE 'Amounts' END AS key,
               'array_of_objects' AS kind,
               '{"amount":' || o_totalprice || ',"kind":"total"}' AS element FROM orders
        UNION ALL SELECT o_orderkey, 'tags', 'array_of_scalars', NULL FROM orders
        UNION ALL SELECT o_orderkey, 'priority', 'string', NULL FROM orders
        UNION ALL SELECT o_orderkey, 'owner', CASE WHEN o_orderstatus = 'O' THEN 'object'
                         ELSE 'array_empty' END, NULL FROM orders)"""


def _finding_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The findings as real JSON: texts of arrays become arrays."""
    orders = table(spark, sf_dir, "orders")
    raw = order_findings()
    key = F.when(F.col("o_orderstatus") == "P", "AMOUNTS").otherwise("Amounts")
    owner = F.when(F.col("o_orderstatus") == "O", F.lit('{"name":"x"}')).otherwise("[]")
    return orders.select("o_orderkey", F.concat(
        F.lit('{"'), key, F.lit('":'), raw[key],
        F.lit(',"tags":'), raw["tags"], F.lit(',"owner":'), owner,
        F.lit(',"priority":"'), F.col("o_orderpriority"), F.lit('"}')).alias("json"))


@query(_FINDING_KINDS + " SELECT key, kind, count(*) AS records FROM k GROUP BY key, kind")
def key_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of value per key of a dynamic object."""
    return P.key_kinds(_finding_json(spark, sf_dir), "json")


@query(_FINDING_KINDS + """
    SELECT k.key AS key, count(*) FILTER (kind = 'array_of_objects') AS object_arrays,
           CASE WHEN k.key = 'owner' THEN 'array_empty,object'
                WHEN k.key = 'tags' THEN 'array_of_scalars'
                WHEN k.key = 'priority' THEN 'string' ELSE 'array_of_objects' END AS kinds,
           min(CASE WHEN kind = 'array_of_objects' THEN o_orderkey END) AS sample_id,
           arg_min(element, o_orderkey) FILTER (kind = 'array_of_objects') AS sample_element
    FROM k GROUP BY k.key""")
def key_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per key: object-array count, kinds, and the example of the smallest id."""
    scan = P.key_scan(_finding_json(spark, sf_dir), "json", "o_orderkey")
    kinds = F.array_join(F.array_sort(F.map_keys("value_kinds")), ",")
    return scan.select("key", "object_arrays", kinds.alias("kinds"), "sample_id", "sample_element")


@query("""
    SELECT 'amounts' AS folded,
           CASE WHEN count(*) FILTER (o_orderstatus = 'P') >= count(*) FILTER (o_orderstatus <> 'P')
                THEN 'AMOUNTS' ELSE 'Amounts' END AS canonical, count(*) AS records FROM orders
    UNION ALL SELECT 'history', 'history', count(*) FILTER (o_orderstatus <> 'F') FROM orders""")
def canonical_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spellings of a key merged under the most frequent one."""
    return P.canonical_keys(_findings(spark, sf_dir), "findings")


@query("""
    WITH n AS (SELECT CASE WHEN value < 5 THEN upper(event_type) ELSE event_type END AS name FROM events),
    c AS (SELECT lower(name) AS folded, name, count(*) AS records FROM n GROUP BY ALL)
    SELECT folded, arg_min(name, struct_pack(a := -records, b := name)) AS canonical,
           CAST(sum(records) AS BIGINT) AS records FROM c GROUP BY folded""")
def elect_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent spelling of each name in a column."""
    name = F.when(F.col("value") < 5, F.upper("event_type")).otherwise(F.col("event_type"))
    return P.elect_spelling(table(spark, sf_dir, "events").select(name.alias("name")), "name")


@query("""
    SELECT k.key AS key, count(*) AS texts,
           count(*) FILTER (starts_with(trim(k.value), '[')) AS arrays,
           count(*) FILTER (regexp_matches(k.value, '^\\s*\\[\\s*\\{')) AS object_arrays
    FROM orders, LATERAL (VALUES
        ('id', CAST(o_orderkey AS VARCHAR)), ('priority', o_orderpriority),
        ('tags', '["' || o_orderstatus || '","' || o_orderpriority || '"]'),
        ('history', CASE o_orderstatus WHEN 'O' THEN '[{"state":"open"},"late"]'
                         WHEN 'F' THEN '[{"state":"fin' ELSE '[{"state":"part"}]' END)) k(key, value)
    GROUP BY k.key""")
def json_array_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which texts look like arrays, and which like arrays of objects."""
    entries = _findings(spark, sf_dir).select(F.explode("findings").alias("key", "value")).where(
        ~F.col("key").isin("Amounts", "AMOUNTS"))
    return entries.groupBy("key").agg(
        F.count("value").alias("texts"), F.count_if(looks_like_array(F.col("value"))).alias("arrays"),
        F.count_if(looks_like_object_array(F.col("value"))).alias("object_arrays"))


@query("""
    SELECT k.key AS key, count(*) AS texts,
           count(*) FILTER (starts_with(trim(k.value), '[')) AS arrays,
           count(*) FILTER (regexp_matches(k.value, '^\\s*\\[\\s*\\{')) AS object_arrays
    FROM orders, LATERAL (VALUES
        (CASE WHEN o_orderstatus = 'P' THEN 'AMOUNTS' ELSE 'Amounts' END, '[{"kind":"total"},{"kind":"customer"}]'),
        ('id', CAST(o_orderkey AS VARCHAR)), ('priority', o_orderpriority),
        ('tags', '["' || o_orderstatus || '","' || o_orderpriority || '"]'),
        ('history', CASE o_orderstatus WHEN 'O' THEN '[{"state":"open"},"late"]'
                         WHEN 'F' THEN '[{"state":"fin' ELSE '[{"state":"part"}]' END)) k(key, value)
    GROUP BY k.key""")
def json_array_tests_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which texts of all keys look like arrays, and which like arrays of objects."""
    return _findings(spark, sf_dir).select(F.explode("findings").alias("key", "value")).groupBy("key").agg(
        F.count("value").alias("texts"), F.count_if(looks_like_array(F.col("value"))).alias("arrays"),
        F.count_if(looks_like_object_array(F.col("value"))).alias("object_arrays"))


@query("""
    WITH d AS (SELECT d.*, l.quality FROM documents d LEFT JOIN labels l USING (doc_id))
    SELECT 'docs' AS "table", f.c AS "column", f.t AS type, round(sum(f.hit) / count(*) * 100, 1) AS filled_pct,
           false AS is_fk, sum(f.hit) / count(*) * 100 < 30 AS is_sparse
    FROM d, LATERAL (VALUES ('doc_id', 'integer', 1), ('text', 'string', 1), ('lang', 'string', 1),
        ('quality', 'integer', CASE WHEN quality IS NULL THEN 0 ELSE 1 END), ('eighths', 'float', 1),
        ('long', 'boolean', 1), ('lines', 'array<string>', 1), ('origin_source', 'string', 1)) f(c, t, hit)
    GROUP BY f.c, f.t""")
def suggest_flat_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A main table suggested for documents with a scalar array and an object."""
    return suggest_tables(_documents_json(spark, sf_dir), "json", "docs")


def _nested_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    lot = F.struct(F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("id"),
                   F.col("o_orderkey").alias("Id"))
    part = F.struct((F.col("o_totalprice").cast("bigint") + 0.5).cast("double").alias("price"))
    return table(spark, sf_dir, "orders").select(F.to_json(F.struct(
        F.col("o_orderkey").alias("key"), F.array(lot).alias("lots"),
        F.struct(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("priority"),
                 F.array(part, part).alias("parts")).alias("details"))).alias("json"))


@query("""
    SELECT v."table", v."column", v.type, v.pct AS filled_pct, v.fk AS is_fk, v.pct < 30 AS is_sparse
    FROM (SELECT round(count(*) FILTER (o_orderstatus <> 'P') / count(*) * 100, 1) AS share FROM orders) s,
    LATERAL (VALUES
        ('orders', 'key', 'integer', 100.0::DOUBLE, false),
        ('orders', 'details_id', 'integer', 100.0, false),
        ('orders', 'details_priority', 'string', 100.0, false),
        ('orders_lots', 'order_id', 'string', 100.0, true),
        ('orders_lots', 'id', 'integer', s.share, false),
        ('orders_lots', 'Id_', 'integer', 100.0, false),
        ('orders_details_parts', 'order_id', 'string', 100.0, true),
        ('orders_details_parts', 'details_id', 'string', 100.0, true),
        ('orders_details_parts', 'price', 'float', 100.0, false)) v("table", "column", type, pct, fk)""")
def suggest_child_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Child tables suggested for object arrays at the root and inside an object."""
    return suggest_tables(_nested_orders(spark, sf_dir), "json", "orders", "order_id")


@query("""
    SELECT 'origin' AS object, CAST(1 AS BIGINT) AS fields, 100.0::DOUBLE AS mean_filled_pct
    FROM documents HAVING count(*) > 0""")
def object_group_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns and mean fill per flattened object."""
    return P.group_summary(suggest_tables(_documents_json(spark, sf_dir), "json", "docs"), ["Origin"], "docs")


@query("""
    SELECT 'details' AS object, CAST(2 AS BIGINT) AS fields,
           100.0 * (count(o_custkey) + count(o_orderpriority)) / (2 * count(*)) AS mean_filled_pct
    FROM orders HAVING count(*) > 0""")
def object_group_of_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A flattened object that has a child table of its own: the child's columns and keys do not count."""
    return P.group_summary(suggest_tables(_nested_orders(spark, sf_dir), "json", "orders", "order_id"), ["details"], "orders")


@query("SELECT doc_id, text, lang, source, n_chars FROM documents WHERE doc_id = 7")
def lookup_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record by its id, whichever way the id is spelled."""
    return find_record(table(spark, sf_dir, "documents"), "DOC_ID", 7)


@query("""
    SELECT arg_min(o_orderkey, o_orderkey) AS id, 'array_of_scalars' AS kind,
           arg_min('["' || o_orderstatus || '","' || o_orderpriority || '"]', o_orderkey) AS sample
    FROM orders""")
def inspect_one_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first record that has a key: its kind and its first items."""
    return inspect_key(_finding_json(spark, sf_dir), "json", "o_orderkey", "tags")


@query("""
    SELECT f.field, f.type, c.good AS filled, round(c.good / c.records * 100, 1) AS filled_pct, c.records - c.good AS unreadable
    FROM (SELECT count(*) AS records, count(*) FILTER (role <> 'system') AS good FROM conversations) c,
    (VALUES ('conv_id', 'integer'), ('turn', 'integer'), ('role', 'string'), ('text', 'string')) f(field, type)""")
def field_profile_unreadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A profile of records of which some are cut: how many, beside every field."""
    text = F.to_json(F.struct("conv_id", "turn", "role", "text"))
    cut = F.when(F.col("role") == "system", F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text)
    return P.field_profile(table(spark, sf_dir, "conversations").select(cut.alias("json")), "json", with_unreadable=True)
