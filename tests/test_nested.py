from __future__ import annotations

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.operators import nested as N
from sedimenta.plans.trusted import child_frames, with_audit
from tests.conftest import rows


def children(df, main="alerts", **options):
    return child_frames(df, N.plan_normalisation(df, main, **options))


def mapped(spark, *records):
    """Records of (id, {key: text}) as a frame with a text map."""
    return spark.createDataFrame(list(records), "AlertId string, Findings map<string,string>")


def test_discovery_names_and_paths():
    schema = T.StructType.fromDDL("""
        AlertId string, Labels array<string>, Holdings struct<count:int, Value:array<struct<x:int>>>,
        a struct<b:struct<`c.d`:array<struct<y:int>>>>, Findings map<string,string>,
        s struct<m:map<string,string>>, typed map<string,array<struct<z:int>>>, plain map<string,int>""")
    found = {f.table: (f.path, f.kind) for f in N.nested_fields("alerts", schema)}
    assert found == {
        "alerts_holdings_value": (("Holdings", "Value"), "array"),
        "alerts_a_b_c_d": (("a", "b", "c.d"), "array"),
        "alerts_findings": (("Findings",), "map_text"),
        "alerts_s_m": (("s", "m"), "map_text"),
        "alerts_typed": (("typed",), "map_array"),
    }


def test_discovery_gives_each_field_its_own_table():
    schema = T.StructType.fromDDL("a struct<b_c:array<struct<x:int>>>, a_b struct<c:array<struct<x:int>>>")
    tables = [f.table for f in N.nested_fields("t", schema)]
    assert len(set(tables)) == 2 and tables[0] == "t_a_b_c"


@pytest.mark.parametrize("case_mode", ["false", "true"])
def test_array_child_in_both_case_modes(spark, case_mode):
    spark.conf.set("spark.sql.caseSensitive", case_mode)
    try:
        schema = "AlertId string, items array<struct<Id:int, id:int, `a b`:string, alertid:string>>"
        df = spark.createDataFrame([("r1", [(1, 2, "x", "own"), None]), ("r2", None), ("r3", [])], schema)
        child = children(df)["alerts_items"]
        assert child.columns == ["alertid", "id_", "id", "a_b", "alertid_"]
        assert rows(child) == [("r1", 1, 2, "x", "own")]
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_array_three_levels_deep_carries_every_id(spark):
    df = spark.sql("""SELECT 1 AS id, named_struct('Id', 'A', 'mid', named_struct('mid_id', 'M',
        'deep', array(named_struct('v', 1), named_struct('v', 2)))) AS Top""")
    child = children(df)["alerts_top_mid_deep"]
    assert child.columns == ["id", "top_id_ref", "mid_id_ref", "v"]
    assert rows(child) == [(1, "A", "M", 1), (1, "A", "M", 2)]


def test_arrays_inside_children_on_request(spark):
    df = spark.sql("""SELECT 1 AS id, array(named_struct('id', 7, 'tags', array(named_struct('t', 'x'),
        named_struct('t', 'y')))) AS lines""")
    assert list(children(df)) == ["alerts_lines"]
    deep = children(df, max_depth=2)
    assert rows(deep["alerts_lines_tags"]) == [(1, 7, "x"), (1, 7, "y")]


def test_map_children_take_every_shape(spark):
    df = mapped(
        spark,
        ("1", {"id": "k1", "scalar": "s", "empty": "[]", "scalars": '["a"]', "objs": '[{"a":1,"b-c":"x"}]'}),
        ("2", {"Id": "k2", "Objs": ' [ {"a":2.5,"Id":"I","id":9}, null]', "mixed": '[{"a":1},"s"]', "cut": '[{"a":1'}),
        ("3", {"objs": "plain text", "nulls": None}),
        ("4", None),
    )
    plan = N.plan_normalisation(df, "alerts")
    found = child_frames(df, plan)
    assert sorted(found) == ["alerts_findings_mixed", "alerts_findings_objs"]
    objs = found["alerts_findings_objs"]
    assert objs.columns == ["alertid", "findings_id", "_source_key", "id_", "a", "b_c", "id"]
    assert rows(objs, "alertid", "findings_id", "_source_key", "a", "b_c", "id_", "id") == [
        ("1", "k1", "objs", 1.0, "x", None, None), ("2", "k2", "Objs", 2.5, None, "I", 9)]
    assert rows(found["alerts_findings_mixed"], "a") == [(1,)]
    assert rows(N.map_rejects(df, plan.maps[0], plan.root_id)) == [("cut", 1), ("mixed", 1)]

    left = {r["AlertId"]: r["Findings"] for r in N.main_projection(df, plan).collect()}
    assert left["1"] == {"id": "k1", "scalar": "s", "empty": "[]", "scalars": '["a"]'}
    assert left["2"] == {"Id": "k2", "mixed": '[{"a":1},"s"]', "cut": '[{"a":1'}
    assert left["3"] == {"objs": "plain text", "nulls": None} and left["4"] is None


def test_late_fields_and_conflicting_types_are_inferred(spark):
    records = [(str(i), {"k": '[{"a":1}]'}) for i in range(150)] + [
        ("late", {"k": json.dumps([{"z": True, "a": "text", "o": {"n": 1}, "l": [1, "b"]}])})]
    child = children(mapped(spark, *records).repartition(1))["alerts_findings_k"]
    dtypes = dict(child.dtypes)
    assert (dtypes["a"], dtypes["z"], dtypes["o"], dtypes["l"]) == (
        "string", "boolean", "struct<n:bigint>", "array<string>")
    late = child.where("alertid = 'late'").first()
    assert (late["a"], late["z"], late["o"]["n"], late["l"]) == ("text", True, 1, ["1", "b"])
    assert child.count() == 151


def test_odd_field_names_and_keys(spark):
    names = ["it's", 'say "hi"', "both ' and \"", "back\\slash", "dot.ted", "x:y"]
    df = mapped(spark, ("1", {"weird key/ü": json.dumps([{n: i for i, n in enumerate(names)}])}),
                ("2", {"": '[{"v":1}]', "x" * 400: '[{"v":2}]'}))
    found = children(df)
    odd = found["alerts_findings_weird_key__"]
    assert sorted(odd.first()[3:]) == [0, 1, 2, 3, 4, 5]
    assert sorted(f.first()["v"] for n, f in found.items() if f is not odd) == [1, 2]


def test_every_key_gets_a_child(spark):
    df = mapped(spark, ("1", {f"k{i}": '[{"a":1}]' for i in range(50)}))
    nested = N.plan_normalisation(df, "alerts").maps[0]
    assert len(N.map_children(N.map_elements(df, nested, "AlertId"), nested)) == 50


def test_entries_without_elements_stay_in_the_map(spark):
    df = spark.sql("""SELECT 1 AS id, map('k', array(named_struct('a', 1)), 'e', array(), 'z', NULL,
                      'n', array(CAST(NULL AS STRUCT<a: INT>))) AS m""")
    plan = N.plan_normalisation(df, "t")
    left = N.main_projection(df, plan).first()["m"]
    assert left == {"e": [], "z": None, "n": [None]}


def test_map_inside_struct_is_extracted_and_pruned(spark):
    df = spark.sql("""SELECT 1 AS id, named_struct('m', map('k', '[{"a":1}]', 's', 'x'), 'n', 2) AS st
                      UNION ALL SELECT 2, NULL""")
    plan = N.plan_normalisation(df, "t")
    assert rows(child_frames(df, plan)["t_st_m_k"], "id", "a") == [(1, 1)]
    left = N.main_projection(df, plan).orderBy("id").collect()
    assert left[0]["st"].asDict() == {"m": {"s": "x"}, "n": 2} and left[1]["st"] is None


def test_map_of_struct_arrays(spark):
    df = spark.sql("SELECT 1 AS id, map('k', array(named_struct('a', 1), NULL), 'K', array(named_struct('a', 2))) AS m")
    plan = N.plan_normalisation(df, "t")
    assert rows(child_frames(df, plan)["t_m"]) == [(1, "K", 2), (1, "k", 1)]
    assert N.main_projection(df, plan).first().asDict() == {"id": 1, "m": {}}


def test_main_projection_drops_what_is_empty_and_keeps_null_parents(spark):
    df = spark.createDataFrame(
        [(1, ([(1,)],), ([(2,)], "keep"), [(3,)], ["a"]), (2, None, None, None, None)],
        "id int, only struct<arr:array<struct<x:int>>>, part struct<arr:array<struct<x:int>>, k:string>, "
        "root array<struct<x:int>>, labels array<string>")
    main = N.main_projection(df, N.plan_normalisation(df, "t"))
    assert main.columns == ["id", "part", "labels"]
    assert rows(main, "id", "part.k", F.col("part").isNull()) == [(1, "keep", False), (2, None, True)]


def test_children_and_main_together_hold_the_input(spark):
    records = [(str(i), {"s": str(i), "objs": json.dumps([{"n": j} for j in range(i % 4)]),
                         "bad": "[{" if i % 2 else "[1]"}) for i in range(20)]
    df = mapped(spark, *records)
    plan = N.plan_normalisation(df, "t")
    again = {r["AlertId"]: dict(r["Findings"]) for r in N.main_projection(df, plan).collect()}
    objects: dict = {}
    for r in child_frames(df, plan)["t_findings_objs"].collect():
        objects.setdefault(r["alertid"], []).append({"n": r["n"]})
    for key, values in objects.items():
        again[key]["objs"] = json.dumps(sorted(values, key=lambda v: v["n"]))
    assert again == {k: v for k, v in records}


def test_audit_columns_move_same_named_data_aside(spark):
    df = spark.sql("SELECT 1 AS id, 'mine' AS execution_date")
    out = with_audit(df, "2024-01-02", F.current_timestamp())
    assert out.columns == ["id", "execution_date_", "execution_date", "_trusted_ingested_at"]
    assert str(out.first()["execution_date"]) == "2024-01-02"


def test_case_fix_by_position(spark):
    df = spark.range(1).selectExpr("1 AS a", "2 AS b", "3 AS c").toDF("Id", "id", "ID")
    assert N.fix_case_conflicts(df).first().asDict() == {"id_": 1, "id": 2, "id__": 3}


def test_hot_key_does_not_change_the_result(spark):
    """A third of all elements under one key, one record with a very long array."""
    long = json.dumps([{"n": i} for i in range(20_000)])
    df = mapped(spark, ("hot", {"a": long}), *[(str(i), {"a": '[{"n":-1}]', f"k{i % 3}": '[{"n":1}]'})
                                               for i in range(500)]).repartition(4)
    found = children(df)
    assert found["alerts_findings_a"].count() == 20_500
    assert sum(found[f"alerts_findings_k{i}"].count() for i in range(3)) == 500


_object = st.dictionaries(st.sampled_from(["a", "b"]), st.integers(0, 9), max_size=2)
_text = st.one_of(
    st.sampled_from(["plain", "", "[]", '["x"]', '[{"a":', "{}", "[null]", "[ ", "null"]),
    st.lists(_object, max_size=3).map(json.dumps),
    st.lists(st.one_of(_object, st.none(), st.just("s")), max_size=3).map(json.dumps))
_maps = st.lists(st.none() | st.dictionaries(st.sampled_from(["k", "K", "m"]), st.none() | _text, max_size=3),
                 min_size=1, max_size=5)


def _parsed(text):
    """The array of a text that opens with an object, or None."""
    if text is None or not text.replace(" ", "").startswith("[{"):
        return None
    try:
        return json.loads(text)
    except json.JSONDecodeError:
        return None


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(_maps)
def test_map_normalisation_against_record_by_record(spark, maps):
    df = mapped(spark, *[(str(i), m) for i, m in enumerate(maps)])
    plan = N.plan_normalisation(df, "t")
    want_rows, want_left, typed = [], {}, set()
    for i, m in enumerate(maps):
        want_left[str(i)] = None if m is None else {}
        for key, text in (m or {}).items():
            array = _parsed(text)
            objects = [e for e in array or [] if isinstance(e, dict)]
            want_rows += [(key.lower(), str(i), key, o.get("a"), o.get("b")) for o in objects]
            typed |= {key.lower() for o in objects if o}
            mixed = any(e is not None and not isinstance(e, dict) for e in array or [])
            if mixed or not any(objects):
                want_left[str(i)][key] = text
    got = []
    for name, frame in child_frames(df, plan).items():
        value = lambda r, c: r[c] if c in r.__fields__ else None
        got += [(name.removeprefix("t_findings_"), r["alertid"], r["_source_key"], value(r, "a"), value(r, "b"))
                for r in frame.collect()]
    # A key whose objects are all empty has no column to make a table of.
    assert sorted(got, key=repr) == sorted((r for r in want_rows if r[0] in typed), key=repr)
    assert {r["AlertId"]: r["Findings"] for r in N.main_projection(df, plan).collect()} == want_left
