"""The resilient JSON scan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions.naming import clean_name, clean_names, quote
from sedimenta.functions.schema import (
    DEFAULT_RULES, RewriteRules, merge_with_table, nullable, rewrite_schema,
)
from sedimenta.operators.align import align_column, lost_values
from sedimenta.scratch import stage

CORRUPT = "_corrupt_record"
INGESTED_AT = "_raw_ingested_at"
SOURCE_FILE = "_source_file"


@dataclass(frozen=True)
class JsonScan:
    """``frame`` holds the stored columns, the corrupt text and the audit columns.

    ``dropped`` counts, once ``frame`` has been written, the values of nested fields that the table's types do not have,
    one count for each column of ``watched``.
    """

    frame: DataFrame
    schema: T.StructType
    dropped: Observation | None = None
    watched: list[str] = field(default_factory=list)

    def lost(self) -> dict[str, int]:
        """Per column the values dropped with new nested fields; waits for ``frame`` to be written."""
        if self.dropped is None:
            return {}
        counts = {name: self.dropped.get[f"_{i}"] for i, name in enumerate(self.watched)}
        return {name: n for name, n in counts.items() if n}

    @property
    def records(self) -> DataFrame:
        """All records, unreadable ones as rows of nulls, without the corrupt text."""
        return self.frame.drop(CORRUPT)


def _reader(spark: SparkSession, multi_line: bool):
    return (spark.read.option("multiLine", multi_line).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT))


def infer_json_schema(spark: SparkSession, paths: str | Sequence[str], multi_line: bool = True,
                      sampling_ratio: float | None = None) -> T.StructType:
    """A2: the schema of all records (or of a sample, when asked for)."""
    reader = _reader(spark, multi_line)
    if sampling_ratio is not None:
        reader = reader.option("samplingRatio", sampling_ratio)
    schema = reader.json(paths if isinstance(paths, str) else list(paths)).schema
    return T.StructType([f for f in schema.fields if f.name != CORRUPT])


def _reading_type(inferred: T.DataType, stored: T.DataType) -> T.DataType:
    """The type to parse with: shaped like ``stored``, named like the source."""
    if isinstance(inferred, T.StructType) and isinstance(stored, T.StructType):
        wanted = {clean_name(f.name).lower(): f for f in stored.fields}
        cleaned = clean_names(inferred.fieldNames())
        fields = []
        for f, cleaned_name in zip(inferred.fields, cleaned):
            target = wanted.get(cleaned_name.lower())
            if target is not None:
                fields.append(T.StructField(f.name, _reading_type(f.dataType, target.dataType)))
            elif clean_name(f.name).lower() not in wanted:  # not stored, read as text to be counted
                fields.append(T.StructField(f.name, T.StringType()))
        return T.StructType(fields)
    if isinstance(inferred, T.ArrayType) and isinstance(stored, T.ArrayType):
        return T.ArrayType(_reading_type(inferred.elementType, stored.elementType), True)
    return stored


def _aligned(name: str, reading: T.DataType, stored: T.DataType, same_shape: bool):
    column = F.col(quote(name))
    if nullable(reading) == nullable(stored):
        return column
    # Same fields in the same order: a cast renames nested fields by position.
    return column.cast(stored) if same_shape else align_column(column, reading, stored)


def _without_fields(spark: SparkSession, paths: str | list[str], multi_line: bool) -> DataFrame:
    """No record has a field: what is no JSON is corrupt. Spark refuses to parse for that alone."""
    text = spark.read.text(paths, wholetext=multi_line).where(F.trim("value") != "")
    return text.select(F.when(F.try_parse_json("value").isNull(), F.col("value")).alias(CORRUPT),
                       "_metadata")


def read_json(spark: SparkSession, paths: str | Sequence[str],
              table_schema: T.StructType | None = None, *, multi_line: bool = True,
              sampling_ratio: float | None = None, schema: T.StructType | None = None,
              rules: RewriteRules = DEFAULT_RULES, evolve_nested: bool = False) -> JsonScan:
    """A1: infer, rewrite, let the table's types win, and read with the fixed schema.

    Every field is parsed under its source spelling and renamed afterwards, so renamed
    fields keep their values. With ``schema`` (source spelling) the inference pass over the
    data is skipped. ``multi_line=False`` reads one record per line, which Spark can split
    within a file; a multi-line file is one task however large it is. With ``evolve_nested``
    the table's types gain nested fields that are new; otherwise their values are counted.
    """
    inferred = schema if schema is not None else infer_json_schema(
        spark, paths, multi_line, sampling_ratio)
    source_named = rewrite_schema(inferred, rules, rename=False)
    rewritten = rewrite_schema(inferred, rules)
    stored = merge_with_table(rewritten, table_schema, evolve_nested)

    reading, columns, lost = [], [], {}
    for source, own, final in zip(source_named.fields, rewritten.fields, stored.fields):
        same_shape = nullable(own.dataType) == nullable(final.dataType)
        dtype = source.dataType if same_shape else _reading_type(
            inferred[source.name].dataType, final.dataType)
        reading.append(T.StructField(source.name, dtype))
        columns.append(_aligned(source.name, dtype, final.dataType, same_shape).alias(final.name))
        count = None if same_shape else lost_values(F.col(quote(source.name)), dtype, final.dataType)
        if count is not None:
            lost[final.name] = F.coalesce(F.sum(count), F.lit(0).cast("bigint"))

    paths = paths if isinstance(paths, str) else list(paths)
    if reading:
        parsed = _reader(spark, multi_line).schema(
            T.StructType([*reading, T.StructField(CORRUPT, T.StringType())])).json(paths)
    else:
        parsed = _without_fields(spark, paths, multi_line)
    audit = F.col("_metadata.file_path").alias(SOURCE_FILE)
    dropped = None
    if lost:
        dropped = Observation()
        parsed, audit = parsed.select("*", audit).observe(
            dropped, *(c.alias(f"_{i}") for i, c in enumerate(lost.values()))), F.col(SOURCE_FILE)
    frame = parsed.select(
        *columns, F.col(CORRUPT),
        F.current_timestamp().alias(INGESTED_AT), audit,
    )
    return JsonScan(frame, stored, dropped, list(lost))


def split_corrupt(scan: JsonScan) -> tuple[DataFrame, DataFrame]:
    """(good records, quarantine of corrupt text and source file).

    The parsed records are written once and read twice: parsing with fewer columns could
    call other records corrupt, and Spark refuses to parse for the corrupt text alone.
    """
    parsed = stage(scan.frame, "parsed-json")
    good = parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = parsed.where(F.col(CORRUPT).isNotNull()).select(CORRUPT, SOURCE_FILE, INGESTED_AT)
    return good, bad


def list_fields(schema: T.StructType) -> list[str]:
    """Root fields that hold a list of objects."""
    return [f.name for f in schema.fields
            if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType)]


def unwrap_root(df: DataFrame, field: str | None = None) -> DataFrame:
    """A10: the records inside a wrapping object; a frame without a list passes through.

    Inferred fields are sorted, so with several lists the field must be named.
    """
    candidates = list_fields(df.schema)
    if field is None:
        if not candidates:
            return df
        if len(candidates) > 1:
            raise ValueError(f"name the field that holds the records; lists found: {candidates}")
        field = candidates[0]
    return df.select(F.inline(quote(field)))
