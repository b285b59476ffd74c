from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions.schema import RewriteRules
from sedimenta.sources.files import files_for_date, has_files
from sedimenta.sources.json_scan import CORRUPT, read_json, split_corrupt, unwrap_root
from tests.conftest import rows


def write(path, *documents):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(d if isinstance(d, str) else json.dumps(d) for d in documents))
    return str(path)


def test_sanitised_names_keep_values(spark, tmp_path, case_sensitive):
    path = write(tmp_path / "a.json", json.dumps([
        {"alert id": 1, "x": {"in-ner": {"de.ep": "v"}}, "arr": [{"k k": 2}], "a-b": 1, "a.b": 2}]))
    out = read_json(spark, path).records
    assert rows(out, "alert_id", "x.in_ner.de_ep", F.col("arr")[0]["k_k"], "a_b", "a_b_") == [
        (1, "v", 2, 1, 2)]


def test_dynamic_struct_reads_as_map_with_json_text(spark, tmp_path):
    path = write(tmp_path / "a.json", {"id": 1, "rf": {"CVE-2024-1": {"a": [1, 2]}, "CVE-2024-2": "s"}})
    scan = read_json(spark, path, multi_line=False)
    assert scan.schema["rf"].dataType == T.MapType(T.StringType(), T.StringType(), True)
    assert scan.records.first()["rf"] == {"CVE-2024-1": '{"a": [1, 2]}', "CVE-2024-2": "s"}


def test_oversize_struct_keeps_its_text(spark, tmp_path):
    path = write(tmp_path / "a.json", {"id": 1, "big": {"alpha": {"x": 1.50}, "beta": "t"}})
    scan = read_json(spark, path, multi_line=False, rules=RewriteRules(type_limit=20))
    assert json.loads(scan.records.first()["big"]) == {"alpha": {"x": 1.5}, "beta": "t"}


def test_table_types_win_with_source_spelling(spark, tmp_path, case_sensitive):
    path = write(tmp_path / "a.json",
                 {"AlertId": 7, "Info": {"Na-me": "n", "Extra": 1}, "m": {"a": 1}, "New": True, "n": [{"Q": 1}]})
    table = T.StructType.fromDDL(
        "alertid string, info struct<na_me:string, missing:int>, m map<string,string>, n array<struct<q:string>>")
    scan = read_json(spark, path, table, multi_line=False)
    assert scan.schema.fieldNames() == ["alertid", "info", "New", "m", "n"]
    row = scan.records.first()
    assert row["alertid"] == "7" and row["New"] is True and row["m"] == {"a": "1"}
    assert row["info"].asDict() == {"na_me": "n", "missing": None}
    assert row["n"][0]["q"] == "1"


def test_corrupt_files_are_split_off(spark, tmp_path):
    write(tmp_path / "d" / "good.json", json.dumps([{"id": 1}, {"id": 2}]))
    write(tmp_path / "d" / "bad.json", '{"id": 3, "x":')
    scan = read_json(spark, str(tmp_path / "d"))
    assert CORRUPT in scan.frame.columns and scan.records.count() == 3
    good, bad = split_corrupt(scan)
    assert rows(good, "id") == [(1,), (2,)]
    assert bad.count() == 1 and bad.first()["_source_file"].endswith("bad.json")
    assert bad.first()[CORRUPT].startswith('{"id": 3')


def test_all_records_corrupt(spark, tmp_path):
    path = write(tmp_path / "a.json", "{bad", "{worse")
    good, bad = split_corrupt(read_json(spark, path, multi_line=False))
    assert (good.count(), bad.count()) == (0, 2)


def test_known_schema_skips_inference(spark, tmp_path):
    path = write(tmp_path / "a.json", {"a b": 1, "other": 2})
    scan = read_json(spark, path, multi_line=False, schema=T.StructType.fromDDL("`a b` bigint"))
    assert scan.records.columns == ["a_b", "_raw_ingested_at", "_source_file"]
    assert scan.records.first()["a_b"] == 1


def test_unwrap_root(spark, tmp_path):
    path = write(tmp_path / "a.json", json.dumps({"v": 1, "data": [{"id": 1}, {"id": 2}]}))
    assert rows(unwrap_root(read_json(spark, path).records)) == [(1,), (2,)]
    two = spark.sql("SELECT array(named_struct('a', 1)) x, array(named_struct('b', 2)) y")
    with pytest.raises(ValueError, match="lists found"):
        unwrap_root(two)
    assert rows(unwrap_root(two, "y")) == [(2,)]
    flat = spark.range(1)
    assert unwrap_root(flat) is flat


def test_files_for_date(spark, tmp_path):
    for name in ("a/report-2024-01-02.json", "b/c/x_2024-01-02_part.json", "report-2024-01-03.json",
                 "2024-01-02/other.json", "a/sp ace-2024-01-02.json"):
        write(tmp_path / name, {"id": 1})
    by_date = files_for_date(spark, str(tmp_path), "2024-01-02")
    assert sorted(p.rsplit("/", 1)[1] for p in by_date) == [
        "report-2024-01-02.json", "sp ace-2024-01-02.json", "x_2024-01-02_part.json"]
    by_pattern = files_for_date(spark, str(tmp_path), "2024-01-02", r"^report-{date}\.json$")
    assert [p.rsplit("/", 1)[1] for p in by_pattern] == ["report-2024-01-02.json"]
    assert read_json(spark, by_date, multi_line=False).records.count() == 3
    assert files_for_date(spark, str(tmp_path), "1999-01-01") == []
    with pytest.raises(ValueError):
        files_for_date(spark, "  ", "2024-01-02")


def test_has_files(spark, tmp_path):
    assert not has_files(spark, str(tmp_path / "absent"))
    write(tmp_path / "x.txt", "1")
    assert not has_files(spark, str(tmp_path))
    write(tmp_path / "deep" / "x.csv", "1")
    assert has_files(spark, str(tmp_path))
