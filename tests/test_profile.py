from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from sedimenta.operators import profile as P
from sedimenta.operators.lookup import find_record, inspect_key, require_record
from sedimenta.plans.suggest import suggest_tables
from tests.conftest import rows


def docs(spark, *documents):
    return spark.createDataFrame(
        [(i, d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(documents)], "id int, json string")


def test_value_labels(spark):
    df = docs(spark, {"n": None, "b": True, "i": 1, "big": 12345678901234567890, "f": 1.0, "e": 1e3,
                      "s": "x", "a": [], "o": {}, "d": "2024-01-01"})
    assert {r["key"]: r["type"] for r in P.field_types(df, "json").collect()} == {
        "n": "null", "b": "boolean", "i": "integer", "big": "integer", "f": "float", "e": "float",
        "s": "string", "a": "array", "o": "object", "d": "string"}


def test_field_profile_counts_all_records(spark):
    df = docs(spark, {"a": 1, "b": None}, {"a": "x", "b": None}, {"a": "y"}, "{broken", {})
    assert rows(P.field_profile(df, "json")) == [("a", "string", 3, 60.0), ("b", "null", 0, 0.0)]


def test_equal_counts_fall_to_the_first_type(spark):
    df = docs(spark, {"a": 1}, {"a": "x"}, {"a": [1]})
    assert P.field_profile(df, "json").first()["type"] == "array"


def test_key_kinds(spark):
    df = docs(spark, {"e": [], "n": [None], "o": [{"x": 1}, 2], "s": [1, {"x": 1}], "d": {"x": 1}, "t": "x", "z": None})
    assert {r["key"]: r["kind"] for r in P.key_kinds(df, "json").collect()} == {
        "e": "array_empty", "n": "array_of_scalars", "o": "array_of_objects", "s": "array_of_scalars",
        "d": "object", "t": "string", "z": "null"}


def test_key_scan_order_and_example(spark):
    df = docs(spark, {"b": [{"v": 0}], "x": 1}, {"a": [{"v": 1}], "b": [{"v": 2}], "x": []}, {"a": 5, "b": "s"})
    got = [(r["key"], r["object_arrays"], r["value_kinds"], r["sample_id"], r["sample_element"])
           for r in P.key_scan(df, "json", "id").collect()]
    assert got == [
        ("b", 2, {"array_of_objects": 2, "string": 1}, 0, '{"v":0}'),
        ("a", 1, {"array_of_objects": 1, "integer": 1}, 1, '{"v":1}'),
        ("x", 0, {"array_empty": 1, "integer": 1}, None, None)]


def test_canonical_spelling(spark):
    df = spark.sql("""SELECT explode(array(map('Ec2', '[{"a":1}]', 'n', '1'), map('EC2', '[{"a":1}]'),
        map('EC2', '[{"a":2}]', 'Ec2', '["x"]'), map('tie', '[{}]'), map('TIE', '[{}]'))) AS m""")
    assert rows(P.canonical_keys(df, "m")) == [("ec2", "EC2", 3), ("tie", "TIE", 2)]


def test_array_statistics_and_distincts(spark):
    df = spark.sql("SELECT * FROM VALUES (array('a','b')), (array('a')), (NULL), (array()) AS t(x)")
    assert tuple(P.array_lengths(df, "x").first()) == (0.75, 2, 2)
    assert P.distinct_items(df, "x").first()[0] == 2
    assert P.distinct_items(df, "x", approximate=True).first()[0] == 2
    maps = spark.range(12).select(F.create_map(F.concat(F.lit("k"), "id"), "id").alias("m"))
    assert tuple(P.distinct_keys(maps, "m").first()) == (12, True)
    assert tuple(P.distinct_keys(maps, "m", 12).first()) == (12, False)


def test_column_profile_of_an_empty_frame(spark):
    assert rows(P.column_profile(spark.sql("SELECT 1 AS a, 'x' AS b WHERE false"))) == [
        ("a", "integer", 0, 0.0), ("b", "string", 0, 0.0)]


def test_suggested_layout(spark):
    df = docs(
        spark,
        {"AlertId": "a", "labels": ["x"], "RF": {"Id": "1", "s": "v", "cs": [{"line": "l", "pos": 1}],
                                               "arr": ["q"], "o": {"z": 1}}, "inv": [{"Id": 1, "id": "x"}, {"p": None}]},
        {"AlertId": "b", "n": None, "RF": {"CS": [{"line": "m"}], "e": []}, "inv": []},
        {"AlertId": "c"}, {"AlertId": "d"})
    got = {(r["table"], r["column"]): (r["type"], r["filled_pct"], r["is_fk"], r["is_sparse"])
           for r in suggest_tables(df, "json").collect()}
    assert got == {
        ("alerts", "AlertId"): ("string", 100.0, False, False),
        ("alerts", "labels"): ("array<string>", 25.0, False, True),
        ("alerts", "n"): ("null", 0.0, False, True),
        ("alerts", "rf_Id"): ("string", 50.0, False, False),
        ("alerts", "rf_s"): ("string", 50.0, False, False),
        ("alerts", "rf_arr"): ("array<string>", 50.0, False, False),
        ("alerts", "rf_e"): ("array<string>", 50.0, False, False),
        ("alerts", "rf_o"): ("object(json)", 50.0, False, False),
        ("alerts_inv", "alert_id"): ("string", 100.0, True, False),
        ("alerts_inv", "Id_"): ("integer", 50.0, False, False),
        ("alerts_inv", "id"): ("string", 50.0, False, False),
        ("alerts_inv", "p"): ("null", 0.0, False, True),
        ("alerts_rf_cs", "alert_id"): ("string", 100.0, True, False),
        ("alerts_rf_cs", "rf_id"): ("string", 50.0, True, False),
        ("alerts_rf_cs", "line"): ("string", 100.0, False, False),
        ("alerts_rf_cs", "pos"): ("integer", 50.0, False, False),
    }
    summary = P.group_summary(suggest_tables(df, "json"), ["RF"], "alerts")
    assert rows(summary) == [("rf", 5, 50.0)]


def test_lookup(spark):
    df = spark.sql("SELECT 'a' AS AlertId, 1 AS v UNION ALL SELECT 'b', 2")
    assert find_record(df, "alertid", "b").first()["v"] == 2
    assert require_record(df, "AlertId", "a").first()["v"] == 1
    with pytest.raises(LookupError):
        require_record(df, "AlertId", "zzz")
    with pytest.raises(ValueError):
        find_record(df, "nope", "a")


def test_inspect_key(spark):
    df = docs(spark, {"k": None}, {"k": [1, 2, 3, 4]}, {"k": "later"}, {"o": {"x": 1.5}})
    assert rows(inspect_key(df, "json", "id", "k")) == [(1, "array_of_scalars", "[1,2,3]")]
    assert rows(inspect_key(df, "json", "id", "o")) == [(3, "object", '{"x":1.5}')]
    assert rows(inspect_key(df, "json", "id", "absent")) == []


def test_elements_with_many_keys_are_variable(spark):
    def found(keys, profiled=None):
        df = spark.createDataFrame([([{k: 1} for k in keys] + [{}],), (None,)], "a array<map<string,int>>")
        return tuple(P.distinct_element_keys(df, "a", profiled).first())

    assert found("abcde") == (5, False) and found("abcdef") == (6, True) and found("aaaaaab") == (2, False)
    assert found("abcdefgh", 10) == (8, False) and found("abcdefghi", 10) == (9, True)


def test_profile_counts_what_is_no_json(spark):
    df = spark.createDataFrame([('{"a": 1}',), ('{"a"',), (None,), ("{}",), ("x",)], "json string")
    assert rows(P.field_profile(df, "json", with_unreadable=True)) == [("a", "integer", 1, 20.0, 2)]
    assert df.where("json = 'x'").agg(P.unreadable("json")).first()[0] == 1
    assert rows(P.field_profile(df, "json")) == [("a", "integer", 1, 20.0)]
