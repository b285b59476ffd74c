"""Profiles of JSON and of frames, as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions.json_values import first_is_object, key_kind, value_label
from sedimenta.functions.naming import quote

SPARSE_BELOW = 30.0
VARIABLE_ABOVE_KEYS = 8
VARIABLE_ABOVE_ELEMENT_KEYS = 5
VARIABLE_ABOVE_SHARE = 0.8

_LABELS = {
    T.BooleanType: "boolean", T.StringType: "string", T.ArrayType: "array",
    T.StructType: "object", T.MapType: "object", T.FloatType: "float", T.DoubleType: "float",
    T.ByteType: "integer", T.ShortType: "integer", T.IntegerType: "integer", T.LongType: "integer",
    T.NullType: "null",
}


def json_fields(df: DataFrame, json: str, *keep: str) -> DataFrame:
    """One row per root field of a JSON text column: ``key`` and its variant ``value``."""
    view = df.select(*keep, F.try_parse_json(quote(json)).alias("_json"))
    return view.lateralJoin(
        view.sparkSession.tvf.variant_explode(F.col("_json").outer()).select("key", "value"),
    ).drop("_json").where(F.col("key").isNotNull())


def _with_schema(fields: DataFrame) -> DataFrame:
    """The schema text of each value as a column, so that a label looks at it once."""
    return fields.withColumn("_schema", F.schema_of_variant("value"))


def _with_kind(fields: DataFrame) -> DataFrame:
    return _with_schema(fields).withColumn("kind", key_kind(F.col("value"), F.col("_schema")))


def record_count(df: DataFrame) -> Column:
    """F1 as a scalar subquery: the number of records beside each row of another result."""
    return df.agg(F.count(F.lit(1))).scalar()


def percent(part: Column, whole: Column) -> Column:
    """Filled share in percent with one decimal."""
    return F.round(part / whole * 100, 1)


def field_types(df: DataFrame, json: str) -> DataFrame:
    """histogram of value types per field (``key``, ``type``, ``records``)."""
    label = value_label(F.col("value"), F.col("_schema"))
    return (_with_schema(json_fields(df, json)).groupBy("key", label.alias("type"))
            .agg(F.count(F.lit(1)).alias("records")))


def dominant_type() -> Column:
    """H4 as an aggregate over (type, records): the most frequent non-null type; equal counts fall to the one that sorts
    first. ``null`` where there is no other."""
    # The largest (count, type) with the type's order turned round by its rank.
    labels = F.array(*[F.lit(t) for t in sorted(
        ["boolean", "integer", "float", "string", "array", "object"], reverse=True)])
    ordinal = F.array_position(labels, F.col("type"))
    best = F.max(F.when(F.col("type") != "null", F.struct(F.col("records"), ordinal, F.col("type"))))
    return F.coalesce(best.getField("type"), F.lit("null"))


def filled_records() -> Column:
    """As an aggregate over (type, records): how many records have a value."""
    return F.sum(F.when(F.col("type") != "null", F.col("records")).otherwise(0))


def dominant_types(histogram: DataFrame) -> DataFrame:
    """H4: per field the most frequent non-null type, and how many records fill it.

    Works on the histogram, which has a handful of rows per field.
    """
    return histogram.groupBy("key").agg(dominant_type().alias("type"), filled_records().alias("filled"))


def unreadable(json: str) -> Column:
    """As an aggregate: how many texts are no JSON. Nulls are no texts."""
    text = F.col(quote(json))
    return F.count_if(text.isNotNull() & F.try_parse_json(text).isNull())


def field_profile(df: DataFrame, json: str, with_unreadable: bool = False) -> DataFrame:
    """per field the dominant type, filled count and filled percent of *all* records.

    Records that are no JSON have no fields. ``with_unreadable`` tells their number beside each field; where there may be
    no field at all, ask :func:`unreadable` alone.
    """
    counts = df.agg(F.struct(F.count(F.lit(1)).alias("records"), *([unreadable(json).alias("unreadable")] if with_unreadable else [])))
    whole = counts.scalar()
    return dominant_types(field_types(df, json)).select(
        F.col("key").alias("field"), "type", "filled", percent(F.col("filled"), whole["records"]).alias("filled_pct"),
        *([whole["unreadable"].alias("unreadable")] if with_unreadable else []))


def label_of(dtype: T.DataType) -> str:
    """The profiler's label for a Spark type; other types show their own name."""
    if isinstance(dtype, T.DecimalType):
        return "float" if dtype.scale else "integer"
    return _LABELS.get(type(dtype), dtype.simpleString())


def column_profile(df: DataFrame) -> DataFrame:
    """F5 for a typed frame: a single aggregation, then one row per column."""
    names = df.columns
    counts = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count(quote(n)).alias(f"_{i}") for i, n in enumerate(names)],
    )
    rows = F.array(*[
        F.struct(
            F.lit(f.name).alias("field"), F.lit(label_of(f.dataType)).alias("type"),
            F.col(f"_{i}").alias("filled"),
            F.when(F.col("_total") > 0, percent(F.col(f"_{i}"), F.col("_total")))
            .otherwise(0.0).alias("filled_pct"),
        ) for i, f in enumerate(df.schema.fields)
    ])
    return counts.select(F.inline(rows))


def distinct_items(df: DataFrame, array: str, approximate: bool = False) -> DataFrame:
    """distinct items of an array column, over all records."""
    items = df.select(F.explode(quote(array)).alias("item"))
    if approximate:
        return items.agg(F.approx_count_distinct("item").alias("distinct_items"))
    return items.agg(F.count_distinct("item").alias("distinct_items"))


def array_lengths(df: DataFrame, array: str) -> DataFrame:
    """mean and largest length, a missing array counting as empty; F10 alongside."""
    length = F.when(F.col(quote(array)).isNull(), 0).otherwise(F.size(quote(array)))
    return df.agg(
        F.avg(length).alias("mean_items"), F.max(length).alias("max_items"),
        F.count_if(length > 0).alias("records_with_items"),
    )


def distinct_keys(df: DataFrame, mapping: str, variable_above: int = VARIABLE_ABOVE_KEYS) -> DataFrame:
    """F8: distinct keys of a map column and whether that makes its schema variable."""
    return (
        df.select(F.explode(F.map_keys(quote(mapping))).alias("key"))
        .agg(F.count_distinct("key").alias("distinct_keys"))
        .withColumn("variable_schema", F.col("distinct_keys") > variable_above)
    )


def distinct_element_keys(df: DataFrame, array: str, profiled: int | None = None) -> DataFrame:
    """F8 for the elements of an array of maps: distinct keys over all of them, and whether their schema is variable.

    It is when there are more than 5 keys and more than 0.8 x the ``profiled`` ones, by default all keys.
    """
    many = F.col("distinct_keys") > VARIABLE_ABOVE_ELEMENT_KEYS
    of = F.col("distinct_keys") if profiled is None else F.lit(profiled)
    return (
        df.select(F.explode(quote(array)).alias("element"))
        .select(F.explode(F.map_keys("element")).alias("key"))
        .agg(F.count_distinct("key").alias("distinct_keys"))
        .withColumn("variable_schema", many & (F.col("distinct_keys") > of * VARIABLE_ABOVE_SHARE))
    )


def canonical_keys(df: DataFrame, mapping: str) -> DataFrame:
    """spellings of one key merge under the most frequent one.

    A spelling is counted where its JSON text opens with an object. Equal counts fall to the
    spelling that sorts first. Counts are combined before the shuffle; the ranking sees one
    row per spelling.
    """
    entries = df.select(F.explode(quote(mapping)).alias("key", "text"))
    spelled = (
        entries.where(first_is_object(F.col("text")))
        .groupBy(F.lower("key").alias("folded"), "key").agg(F.count(F.lit(1)).alias("records"))
    )
    return elect(spelled)


def elect(spelled: DataFrame) -> DataFrame:
    """The most frequent spelling of each folded name, with the count of all its spellings."""
    by_key = Window.partitionBy("folded")
    order = by_key.orderBy(F.desc("records"), F.asc("key"))
    return (
        spelled.withColumn("_rank", F.row_number().over(order))
        .withColumn("_all", F.sum("records").over(by_key))
        .where("_rank = 1")
        .select("folded", F.col("key").alias("canonical"), F.col("_all").alias("records"))
    )


def elect_spelling(df: DataFrame, column: str) -> DataFrame:
    """F9 for a plain column of names: the most frequent spelling per case-folded name."""
    name = F.col(quote(column))
    return elect(df.groupBy(F.lower(name).alias("folded"), name.alias("key"))
                  .agg(F.count(F.lit(1)).alias("records")))


def key_kinds(df: DataFrame, json: str) -> DataFrame:
    """histogram of value kinds per key of a JSON object column."""
    return (_with_kind(json_fields(df, json)).groupBy("key", "kind")
            .agg(F.count(F.lit(1)).alias("records")))


def key_scan(df: DataFrame, json: str, record_id: str) -> DataFrame:
    """one row per key with its kinds; object-array keys carry a count and an example.

    The example is the first element in the record with the smallest id. Object-array keys
    come first by descending count, the others by name.
    """
    # Only object arrays carry an element on, as text.
    example = F.when(F.col("kind") == "array_of_objects", F.struct(
        F.col(quote(record_id)).alias("id"),
        F.try_variant_get("value", "$[0]", "string").alias("element")))
    return key_summary(
        _with_kind(json_fields(df, json, record_id)).select("key", "kind", example.alias("example"))
        .groupBy("key", "kind")
        .agg(F.count(F.lit(1)).alias("records"), F.min("example").alias("example")))


def key_summary(kinds: DataFrame) -> DataFrame:
    """Roll a (key, kind, records, example) histogram up to one row per key."""
    arrays = F.when(F.col("kind") == "array_of_objects", F.col("records")).otherwise(0)
    entries = F.array_sort(F.collect_list(F.struct("kind", "records")))  # at most one per kind
    example = F.min("example")
    return kinds.groupBy("key").agg(
        F.sum(arrays).alias("object_arrays"),
        F.map_from_entries(entries).alias("value_kinds"),
        example.getField("id").alias("sample_id"),
        example.getField("element").alias("sample_element"),
    ).orderBy(F.desc("object_arrays"), F.asc("key"))


def group_summary(columns: DataFrame, prefixes: list[str], root: str) -> DataFrame:
    """per flattened object the number of its columns in the main table ``root`` and their mean fill.

    Columns of child tables count for none, nor do foreign keys.
    """
    group = F.lit(None).cast("string")
    for prefix in reversed(prefixes):
        start = prefix.lower() + "_"
        group = F.when(F.lower("column").startswith(start), prefix.lower()).otherwise(group)
    return (
        columns.where((F.col("table") == root) & ~F.coalesce(F.col("is_fk"), F.lit(False)))
        .withColumn("object", group).where(F.col("object").isNotNull())
        .groupBy("object").agg(F.count(F.lit(1)).alias("fields"),
                               F.avg("filled_pct").alias("mean_filled_pct"))
    )
