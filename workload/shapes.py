"""Semi-structured shapes derived row by row from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.scratch import new_path
from sedimenta.sources.files import list_files


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def document_lines(spark: SparkSession, sf_dir: str, words: bool = False) -> DataFrame:
    """Each document with its lines, on request with their words, as arrays of structs."""

    def line(text: Column, i: Column) -> Column:
        fields = [text.alias("line"), i.alias("position")]
        if words:
            fields.append(F.transform(F.split(text, " ", -1), lambda w: F.struct(w.alias("word")))
                          .alias("words"))
        return F.struct(*fields)

    return table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", F.transform(F.split("text", "\n", -1), line).alias("snippet"))


def order_findings() -> Column:
    """A map of JSON texts: object arrays in two spellings, mixed and cut ones, scalars."""
    kind = "struct<kind:string,amount:double,ref:bigint>"
    amounts = F.to_json(F.array(
        F.struct(F.lit("total").alias("kind"), F.col("o_totalprice").alias("amount"),
                 F.lit(None).cast("bigint").alias("ref")).cast(kind),
        F.struct(F.lit("customer").alias("kind"), F.lit(None).cast("double").alias("amount"),
                 F.col("o_custkey").alias("ref")).cast(kind)))
    history = (F.when(F.col("o_orderstatus") == "O", F.lit('[{"state":"open"},"late"]'))
               .when(F.col("o_orderstatus") == "F", F.lit('[{"state":"fin'))
               .otherwise(F.lit('[{"state":"part"}]')))
    return F.create_map(
        F.when(F.col("o_orderstatus") == "P", "AMOUNTS").otherwise("Amounts"), amounts,
        F.lit("id"), F.col("o_orderkey").cast("string"),
        F.lit("priority"), F.col("o_orderpriority"),
        F.lit("tags"), F.to_json(F.array("o_orderstatus", "o_orderpriority")),
        F.lit("history"), history)


def nested_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as nested records: a struct with an array inside (null for status P), a plain
    struct, and the map of findings."""
    value = "struct<Price:double,Priority:string>"
    holdings = F.when(F.col("o_orderstatus") != "P", F.struct(
        F.col("o_custkey").alias("id"), F.lit(2).alias("count"),
        F.array(
            F.struct("o_totalprice", "o_orderpriority").cast(value),
            F.struct((F.col("o_totalprice") * 2).alias("p"), F.lit("double").alias("q")).cast(value),
        ).alias("value")))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("OrderId"), F.col("o_orderstatus").alias("Status"),
        holdings.alias("Holdings"),
        F.struct(F.col("o_orderdate").alias("Date"),
                 F.col("o_orderpriority").alias("Priority")).alias("Holding"),
        order_findings().alias("Findings"))


def event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with odd field names at the root and below."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("event id"),
        F.struct(F.col("event_type").alias("event.type"), F.col("value").alias("raw-value"),
                 F.col("user_id").alias("user")).alias("event-details"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"))


def as_json_files(df: DataFrame, label: str) -> str:
    """Write one JSON record per line and return the folder."""
    path = new_path(df.sparkSession, label)
    df.write.json(path)
    return path


def as_dated_json_files(df: DataFrame, day: str, label: str) -> str:
    """JSON files whose base names carry the day of their records."""
    spark = df.sparkSession
    path, flat = new_path(spark, label), new_path(spark, label)
    df.write.partitionBy(day).json(path)
    jvm = spark._jvm.org.apache.hadoop.fs
    fs = jvm.Path(flat).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(jvm.Path(flat))
    for i, row in enumerate(list_files(spark, path, "*.json").orderBy("path").collect()):
        date = row["path"].rsplit(f"{day}=", 1)[1].split("/")[0]
        fs.rename(jvm.Path(row["path"]), jvm.Path(f"{flat}/export-{date}-{i:05d}.json"))
    return flat
