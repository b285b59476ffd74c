"""JSON scans: schema rewriting, table types, corrupt records, wrapped roots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions.schema import RewriteRules
from sedimenta.scratch import new_path
from sedimenta.sinks.files import write_json
from sedimenta.sources.json_scan import INGESTED_AT, SOURCE_FILE, read_json, split_corrupt, unwrap_root
from workload import query
from workload.shapes import as_json_files, event_documents, table


@query("""
    SELECT event_id, user_id, event_type, value, strftime(ts, '%Y-%m-%d') AS day FROM events""")
def json_rewrite_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd field names are sanitised and keep their values."""
    path = as_json_files(event_documents(spark, sf_dir), "odd-names")
    scan = read_json(spark, path, multi_line=False)
    return scan.records.select(
        F.col("event_id"), F.col("event_details.user").alias("user_id"),
        F.col("event_details.event_type").alias("event_type"),
        F.col("event_details.raw_value").alias("value"), "day")


@query("""
    SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, value FROM events""")
def dynamic_struct_to_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An object whose field names are dates is read as a map."""
    docs = table(spark, sf_dir, "events").select(
        "event_id", F.create_map(F.date_format("ts", "yyyy-MM-dd"), "value").alias("by_day"))
    scan = read_json(spark, as_json_files(docs, "dated-keys"), multi_line=False)
    return scan.records.select("event_id", F.explode("by_day").alias("day", "value"))


@query("""
    SELECT event_id, event_type AS kind, CAST(user_id AS VARCHAR) AS user_id FROM events""")
def oversize_to_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A struct over the type limit is kept as its JSON text."""
    path = as_json_files(event_documents(spark, sf_dir), "oversize")
    scan = read_json(spark, path, multi_line=False, rules=RewriteRules(type_limit=40))
    return scan.records.select(
        "event_id", F.get_json_object("event_details", "$['event.type']").alias("kind"),
        F.get_json_object("event_details", "$.user").alias("user_id"))


@query("""
    SELECT event_id AS Event_Id, CAST(user_id AS VARCHAR) AS user, event_type AS kind,
           CAST(NULL AS BIGINT) AS missing FROM events""")
def table_priority_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns the table knows take its spelling and types, nested ones by name."""
    stored = T.StructType.fromDDL(
        "Event_Id bigint, event_details struct<user:string, missing:bigint, event_type:string>")
    path = as_json_files(event_documents(spark, sf_dir), "table-types")
    scan = read_json(spark, path, stored, multi_line=False)
    return scan.records.select(
        "Event_Id", "event_details.user", F.col("event_details.event_type").alias("kind"),
        "event_details.missing")


@query("""
    SELECT event_id, event_type AS kind, value FROM events""")
def fixed_schema_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A known source schema spares the inference pass."""
    path = as_json_files(event_documents(spark, sf_dir), "known-schema")
    known = T.StructType.fromDDL(
        "`event id` bigint, `event-details` struct<`event.type`:string, `raw-value`:double>")
    scan = read_json(spark, path, multi_line=False, schema=known)
    return scan.records.select("event_id", F.col("event_details.event_type").alias("kind"),
                               F.col("event_details.raw_value").alias("value"))


@query("""
    SELECT CASE WHEN role = 'system' THEN 'corrupt' ELSE role END AS part, count(*) AS records,
           max(CASE WHEN role <> 'system' THEN turn END) AS last_turn
    FROM conversations GROUP BY 1""")
def corrupt_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cut records go to quarantine, all others are kept."""
    text = F.to_json(F.struct("conv_id", "turn", "role", "text"))
    lines = table(spark, sf_dir, "conversations").select(
        F.when(F.col("role") == "system", F.substring(text, F.lit(1), F.length(text) - 1))
        .otherwise(text).alias("value"))
    path = new_path(spark, "cut-lines")
    lines.write.text(path)
    good, bad = split_corrupt(read_json(spark, path, multi_line=False))
    kept = good.groupBy(F.col("role").alias("part")).agg(
        F.count(F.lit(1)).alias("records"), F.max("turn").alias("last_turn"))
    lost = bad.agg(F.count(F.lit(1)).alias("records")).select(
        F.lit("corrupt").alias("part"), "records", F.lit(None).cast("bigint").alias("last_turn"))
    return kept.unionByName(lost)


@query("""
    SELECT c_custkey AS custkey, r.label AS label FROM customer,
    LATERAL (VALUES (c_name), (c_mktsegment)) r(label)""")
def wrapped_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that wrap their records in a list."""
    record = "struct<custkey:bigint,label:string>"
    docs = table(spark, sf_dir, "customer").select(
        F.lit(1).alias("version"),
        F.array(F.struct("c_custkey", "c_name").cast(record),
                F.struct("c_custkey", "c_mktsegment").cast(record)).alias("data"))
    scan = read_json(spark, as_json_files(docs, "wrapped"), multi_line=False)
    return unwrap_root(scan.records)


@query("""
    SELECT event_type, count(*) AS records, count(*) AS with_time, count(*) AS with_file
    FROM events GROUP BY event_type""")
def audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record knows when it was read and from which file."""
    docs = table(spark, sf_dir, "events").select("event_id", "event_type")
    scan = read_json(spark, as_json_files(docs, "audited"), multi_line=False)
    return scan.records.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("records"), F.count(INGESTED_AT).alias("with_time"),
        F.count_if(F.col(SOURCE_FILE).endswith(".json")).alias("with_file"))


@query("SELECT doc_id, text, lang FROM documents")
def json_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written as JSON read back the same, whole texts included."""
    path = new_path(spark, "export")
    write_json(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), path)
    return read_json(spark, path, multi_line=False).records.select("doc_id", "text", "lang")
