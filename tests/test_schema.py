from __future__ import annotations

import pytest
from pyspark.sql import types as T

from sedimenta.functions.json_values import variant_type
from sedimenta.functions.partitioning import parse_partition, partition_spec
from sedimenta.functions.schema import (
    RewriteRules, check_type_sizes, ddl_type, is_dynamic_struct, merge_with_table, rewrite_schema,
    rewrite_type, type_size,
)

S, L = T.StringType(), T.LongType()


def struct(*names, dtype=S):
    return T.StructType([T.StructField(n, dtype) for n in names])


@pytest.mark.parametrize("names, dynamic", [
    ((), False),
    (("name", "url"), False),
    (tuple(f"f{i}" for i in range(20)), False),
    (tuple(f"f{i}" for i in range(21)), True),
    (("CVE-2024-12345", "cve-2023-1"), True),
    (("deadbeef01", "name"), False),               # exactly half is not a majority
    (("deadbeef01", "cafebabe", "name"), True),
    (("2024-01-01", "2024-01-02T00:00"), True),
    (("ABC-1", "AB-22", "x"), True),
    (("1.2.3", "1.2.4-rc1"), True),
    (("abcdefg", "x"), False),                      # seven hex digits are too few
])
def test_dynamic_struct(names, dynamic):
    assert is_dynamic_struct(struct(*names)) is dynamic


def test_map_rewrite_takes_common_type_else_string():
    same = struct("2024-01-01", "2024-01-02", dtype=L)
    assert rewrite_type(same) == T.MapType(S, L, True)
    mixed = T.StructType([T.StructField("2024-01-01", L), T.StructField("2024-01-02", S)])
    assert rewrite_type(mixed) == T.MapType(S, S, True)


def test_map_values_are_rewritten_too():
    inner = struct("a-b", dtype=L)
    outer = T.StructType([T.StructField("CVE-2024-1", inner), T.StructField("CVE-2024-2", inner)])
    assert rewrite_type(outer) == T.MapType(S, struct("a_b", dtype=L), True)
    assert rewrite_type(outer, rename=False) == T.MapType(S, inner, True)


def test_rewrite_recurses_through_arrays_and_maps_and_keeps_primitives():
    schema = T.StructType([
        T.StructField("a b", T.ArrayType(struct("x.y"), False)),
        T.StructField("m", T.MapType(S, struct("p-q"), False)),
        T.StructField("d", T.DecimalType(10, 2)),
        T.StructField("nothing", T.NullType()),
    ])
    out = rewrite_schema(schema)
    assert out["a_b"].dataType == T.ArrayType(struct("x_y"), False)
    assert out["m"].dataType == T.MapType(S, struct("p_q"), False)
    assert out["d"].dataType == T.DecimalType(10, 2)
    assert out["nothing"].dataType == S
    assert all(f.nullable for f in out.fields)


def test_root_never_becomes_a_map():
    schema = struct(*[f"f{i}" for i in range(30)])
    assert rewrite_schema(schema) == schema


def test_oversize_struct_becomes_text_by_catalog_text():
    wide = struct("one", "two", "three")
    limit = type_size(wide)
    assert rewrite_type(wide, RewriteRules(type_limit=limit)) == wide
    assert rewrite_type(wide, RewriteRules(type_limit=limit - 1)) == S


def test_colliding_clean_names_stay_distinct():
    assert rewrite_schema(struct("a-b", "a.b", "a_b")).fieldNames() == ["a_b_", "a_b__", "a_b"]


def test_check_type_sizes_lists_offenders():
    schema = T.StructType([T.StructField("small", S), T.StructField("big", struct("aaaa", "bbbb"))])
    check_type_sizes(schema, "t", 1000)
    with pytest.raises(ValueError, match="big"):
        check_type_sizes(schema, "t", 10)


def test_ddl_type_quotes_nested_names(spark):
    dtype = T.StructType([T.StructField("a`b", T.ArrayType(struct("x:y", "p,q")))])
    assert T.DataType.fromDDL(ddl_type(dtype)) == dtype


def test_merge_with_table_is_case_blind_and_additive():
    merged = merge_with_table(struct("Alert", "fresh"), struct("alert", "gone", dtype=L))
    assert merged == T.StructType([T.StructField("alert", L), T.StructField("fresh", S)])
    assert merge_with_table(struct("a"), None) == struct("a")
    assert merge_with_table(struct("Id", "id", "ID"), struct("id", dtype=L)) == T.StructType(
        [T.StructField("Id", S), T.StructField("id", L), T.StructField("ID", S)])


@pytest.mark.parametrize("text, expected", [
    ("OBJECT<a: BIGINT, b: VOID, c: VARIANT>", "struct<a:bigint,b:string,c:string>"),
    ("OBJECT<a: DECIMAL(3,1), b: DECIMAL(1,0), c: DECIMAL(20,0), d: DOUBLE>",
     "struct<a:double,b:double,c:decimal(20,0),d:double>"),
    ("OBJECT<a: ARRAY<VOID>, b: ARRAY<VARIANT>, c: ARRAY<OBJECT<x: BOOLEAN>>, d: OBJECT<>>",
     "struct<a:array<string>,b:array<string>,c:array<struct<x:boolean>>,d:string>"),
    ("OBJECT<VOID: BIGINT, `x: VOID`: STRING, `a b`: OBJECT<`OBJECT<>`: VOID>>", None),
])
def test_variant_type(spark, text, expected):
    dtype = variant_type(text)
    if expected:
        assert dtype.simpleString() == expected
    else:
        assert dtype.fieldNames() == ["VOID", "x: VOID", "a b"]
        assert dtype["a b"].dataType.fieldNames() == ["OBJECT<>"]


@pytest.mark.parametrize("text, transform, column, buckets", [
    ("day", "identity", "day", None),
    (" 'day' ", "identity", "day", None),
    ("identity(x)", "identity", "x", None),
    ("DAYS( ts )", "days", "ts", None),
    ('bucket(16, "id")', "bucket", "id", 16),
])
def test_partition_entries(text, transform, column, buckets):
    parsed = parse_partition(text)
    assert (parsed.transform, parsed.column, parsed.buckets) == (transform, column, buckets)


@pytest.mark.parametrize("text", ["", "  ", None, "days(a, b)", "bucket(3)", "identity(a,b)", "weeks(ts)"])
def test_bad_partition_entries(text):
    with pytest.raises(ValueError):
        parse_partition(text)


def test_partition_spec_passes_columns_through(spark):
    from pyspark.sql import functions as F

    ready = F.col("x")
    assert partition_spec([ready])[0] is ready
    assert len(partition_spec(["a", "years(ts)", "months(ts)", "hours(ts)", "bucket(4, a)"])) == 5
