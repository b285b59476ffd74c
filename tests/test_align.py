from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.operators.align import align_by_union, align_to, cast_or_null, lost_in_alignment, serialise_changed


def aligned(spark, select, ddl):
    return align_to(spark.sql(f"SELECT {select}"), T.StructType.fromDDL(ddl))


def test_order_missing_extra_and_case(spark):
    out = aligned(spark, "1 AS B, 'x' AS extra", "a date, b bigint")
    assert out.columns == ["a", "b"] and tuple(out.first()) == (None, 1)
    assert out.schema["a"].dataType == T.DateType()


def test_complex_to_text_and_back(spark):
    out = aligned(spark, "named_struct('p', 1) AS s, array(1, 2) AS a, map('k', 1) AS m", "s string, a string, m string")
    assert tuple(out.first()) == ('{"p":1}', "[1,2]", '{"k":1}')
    assert aligned(spark, """'{"p":1}' AS s""", "s struct<p:int>").first()["s"]["p"] == 1


def test_struct_to_map_is_a_map(spark):
    out = aligned(spark, "named_struct('p', 1, 'q', CAST(NULL AS INT), 'r', array(1)) AS s", "s map<string,string>")
    assert out.first()["s"] == {"p": "1", "r": "[1]"}


def test_map_to_struct_keeps_values(spark):
    out = aligned(spark, "map('p', '7', 'z', 'x') AS m", "m struct<p:int, q:string>")
    assert out.first()["m"].asDict() == {"p": 7, "q": None}


def test_nested_fields_meet_by_name(spark):
    out = aligned(spark, "array(named_struct('b', 'B', 'a', 'A', 'n', named_struct('y', 1))) AS s, "
                         "map('k', named_struct('b', 1, 'A', 2)) AS m",
                  "s array<struct<a:string, n:struct<x:int,y:bigint>, b:string>>, m map<string,struct<a:int,b:int>>")
    row = out.first()
    assert row["s"][0]["a"] == "A" and row["s"][0]["b"] == "B" and tuple(row["s"][0]["n"]) == (None, 1)
    assert tuple(row["m"]["k"]) == (2, 1)


def test_null_parent_stays_null(spark):
    out = aligned(spark, "CAST(NULL AS struct<a:int>) AS s, CAST(NULL AS map<string,int>) AS m, "
                         "CAST(NULL AS struct<a:int>) AS t",
                  "s struct<a:int,b:int>, m struct<a:int>, t map<string,string>")
    assert tuple(out.first()) == (None, None, None)


def test_values_that_do_not_fit_are_counted(spark):
    df = spark.sql("SELECT * FROM VALUES ('1'), ('x'), (NULL) AS t(v)")
    table = T.StructType.fromDDL("v int, w int")
    assert sorted(r["v"] for r in align_to(df, table).collect() if r["v"]) == [1]
    assert tuple(lost_in_alignment(df, table).first()) == (1, 0)


def lost(spark, select, ddl):
    return tuple(lost_in_alignment(spark.sql(f"SELECT {select}"), T.StructType.fromDDL(ddl)).first())


def test_nested_losses_are_counted(spark):
    assert lost(spark, "named_struct('a', 'x', 'b', '2', 'c', 1) AS s", "s struct<a:int, b:int>") == (2,)
    assert lost(spark, "array(named_struct('a', 'x'), named_struct('a', '1'), NULL) AS s", "s array<struct<a:int>>") == (1,)
    assert lost(spark, "map('k', array('1', 'x', 'y', NULL)) AS m", "m map<string, array<int>>") == (2,)
    assert lost(spark, "map('p', 'x', 'q', '1', 'r', 'new') AS m", "m struct<p:int, q:int>") == (2,)
    assert lost(spark, "named_struct('p', 'x', 'q', '1') AS s", "s map<string, int>") == (1,)
    assert lost(spark, "named_struct('a', CAST(NULL AS STRING), 'n', named_struct('x', 1, 'y', 2)) AS s",
                "s struct<a:int, n:struct<x:bigint>>") == (1,)


def test_losses_of_json_texts_are_counted(spark):
    assert lost(spark, """'{"p":"x","q":2,"r":[1]}' AS s""", "s struct<p:int, q:int>") == (2,)
    assert lost(spark, "'no json' AS s, '[1,2]' AS a", "s struct<p:int>, a array<int>") == (1, 0)


def test_nothing_is_lost_in_an_empty_frame(spark):
    df = spark.sql("SELECT named_struct('a', 'x') AS s").limit(0)
    assert tuple(lost_in_alignment(df, T.StructType.fromDDL("s struct<a:int>")).first()) == (0,)


@pytest.mark.parametrize("sensitive", [False, True])
def test_fields_equal_up_to_case_keep_apart(spark, sensitive):
    spark.conf.set("spark.sql.caseSensitive", sensitive)
    try:
        df = spark.range(1).selectExpr("1 AS id")
        assert tuple(align_to(df, T.StructType.fromDDL("ID bigint")).first()) == (1,)
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_union_widens(spark):
    table = spark.sql("SELECT CAST(1 AS BIGINT) AS a, 'x' AS b")
    out = align_by_union(spark.sql("SELECT 5 AS a"), table)
    assert out.dtypes == [("a", "bigint"), ("b", "string")] and tuple(out.first()) == (5, None)


def test_serialise_changed(spark):
    df = spark.sql("SELECT named_struct('p', 1) AS `a b`, 'text' AS c")
    out = serialise_changed(df, df.schema, T.StructType.fromDDL("a_b string, c string"))
    assert out.first().asDict() == {"a_b": '{"p":1}', "c": "text"}


def both_counts(spark, value, target):
    df = spark.sql(f"SELECT {value} AS m")
    schema = T.StructType.fromDDL(f"m {target}")
    return align_to(df, schema).first()["m"], lost_in_alignment(df, schema).first()["m"]


@pytest.mark.parametrize("value, target, expected", [
    ("map('abc', 1, '7', 2)", "map<int,int>", ({7: 2}, 1)),
    ("map('7', 1, ' 7', 2, '8', 3)", "map<int,int>", ({7: 1, 8: 3}, 1)),                     # one key twice: the first stays
    ("map('7', 'x', '8', '9', 'z', 'q')", "map<int,int>", ({7: None, 8: 9}, 2)),
    ("map('1', named_struct('a', 1, 'b', 2))", "map<bigint,struct<a:int>>", ({1: (1,)}, 1)),
    ("CAST(NULL AS map<string,int>)", "map<int,int>", (None, 0)),
    ("CAST(map() AS map<string,int>)", "map<int,int>", ({}, 0)),
    ("named_struct('7', 1, 'abc', 2, 'none', CAST(NULL AS int))", "map<int,int>", ({7: 1}, 1)),
    ("named_struct('07', 1, '7', 2, '7.', CAST(NULL AS int))", "map<int,bigint>", ({7: 1}, 1)),
    ("named_struct('07', 'x', '7', '5')", "map<int,int>", ({7: 5}, 1)),
    ("named_struct('1', 'x', '2', '5')", "map<int,int>", ({2: 5}, 1)),
    ("CAST(NULL AS struct<a:int>)", "map<int,int>", (None, 0)),
    ("array(map('a', 1), map('1', 1), NULL)", "array<map<int,int>>", ([{}, {1: 1}, None], 1)),
])
def test_map_keys_that_do_not_fit(spark, value, target, expected):
    assert both_counts(spark, value, target) == expected


def test_map_entries_are_worked_out_once(spark):
    """Neither the keys of a map nor what is lost of it recompute the map's entries for every entry."""
    dst = T.StructType.fromDDL("m map<bigint,double>")
    df = spark.range(2).selectExpr("CASE WHEN id = 0 THEN map('1', 1D, '01', 2D, 'x', double(id)) END AS m")
    for frame in (align_to(df, dst), lost_in_alignment(df, dst)):
        assert frame._jdf.queryExecution().optimizedPlan().toString().count("map_entries(") == 1
    assert [r["m"] for r in align_to(df, dst).collect()] == [{1: 1.0}, None]
    assert lost_in_alignment(df, dst).collect() == [(2,)]


@pytest.mark.parametrize("kind", ["tinyint", "smallint", "int", "bigint"])
def test_whole_numbers_in_texts_are_found_as_by_a_cast(spark, kind):
    texts = ["12", " 12 ", "\t12\n", "+7", "-3", "- 3", "--3", "1.5", "1.", ".5", "1e2", "12L", "x", "x1", "1x", "1 2", "", " ", "0012", "300",
             "99999999999", "9223372036854775808", "٣", " 12", " 12", "1\n2", "12\r\n", "\x0012", "NaN", "true", "1,000", "_1", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    dtype = T.StructType.fromDDL(f"x {kind}")["x"].dataType
    looked = df.select("t", cast_or_null(F.col("t"), T.StringType(), dtype).alias("a"), F.col("t").try_cast(dtype).alias("b")).collect()
    assert [r for r in looked if r["a"] != r["b"]] == []
    assert "RLIKE" in df.select(cast_or_null(F.col("t"), T.StringType(), dtype))._jdf.queryExecution().optimizedPlan().toString()
