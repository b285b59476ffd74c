from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from sedimenta.plans.csv_load import csv_full_load
from sedimenta.plans.raw import raw_ingest
from sedimenta.plans.sql_load import sql_to_table
from sedimenta.plans.trusted import trusted_normalise
from sedimenta.scratch import new_database
from sedimenta.sinks.tables import create_or_append, create_table
from sedimenta.streaming.csv_stream import run_csv_stream
from tests.conftest import rows
from pyspark.sql import types as T

DAY = "2024-01-15"


def land(folder, name, documents):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(documents if isinstance(documents, str) else json.dumps(documents))


ALERTS = [
    {"AlertId": "a1", "Title": "t", "Labels": ["x"], "Risk Score": 5.1,
     "Findings": {"id": "rf1", **{f"k{i}": i for i in range(21)}, "AclGrants": [{"Id": 1, "id": "g", "name": "n"}],
                      "code_snippet": [{"line": "l1", "position": 1}, {"line": "l2", "position": 2}]},
     "Holdings": {"count": 1, "value": [{"RiskScore": 1.5, "RiskLevel": "high"}]}},
    {"AlertId": "a2", "Title": "u", "Findings": {"aclgrants": [{"name": "m"}], "k1": "text"},
     "Holdings": {"count": 0, "value": []}},
]


def test_raw_then_trusted(spark, tmp_path, case_sensitive):
    raw, trusted = new_database(spark, "raw"), new_database(spark, "trusted")
    land(tmp_path / "in", f"report-{DAY}.json", ALERTS)
    land(tmp_path / "in", f"broken-{DAY}.json", '[{"AlertId": "a3", ')
    config = {"source": {"input_path": str(tmp_path / "in")},
              "destination": {"database": raw, "table": "alert", "partition_by": ["execution_date"],
                              "write_mode": "overwrite", "quarantine_table": "alert_corrupt"}}
    report = raw_ingest(spark, DAY, config)
    assert (report.files, report.records, report.corrupt) == (2, 2, 1)
    stored = spark.table(f"{raw}.alert")
    assert stored.schema["Findings"].dataType.simpleString() == "map<string,string>"
    assert rows(stored, "AlertId", "Risk_Score", F.col("execution_date").cast("string")) == [
        ("a1", 5.1, DAY), ("a2", None, DAY)]
    assert spark.table(f"{raw}.alert_corrupt").count() == 1
    assert raw_ingest(spark, "1999-01-01", config).files == 0

    settings = {"source": {"database_name": raw, "table_name": "alert", "partition_date_by": "execution_date"},
                "destination": {"database_name": trusted, "main_table_name": "alerts",
                                "partition_by": ["execution_date"], "write_mode": "overwrite"}}
    for _ in range(2):
        assert trusted_normalise(spark, DAY, settings) == [
            "alerts", "alerts_holdings_value", "alerts_findings_aclgrants", "alerts_findings_code_snippet"]
    assert rows(spark.table(f"{trusted}.alerts_findings_code_snippet"),
                "alertid", "findings_id", "line", "position") == [
        ("a1", "rf1", "l1", 1), ("a1", "rf1", "l2", 2)]
    assert rows(spark.table(f"{trusted}.alerts_findings_aclgrants"),
                "alertid", "_source_key", "id_", "id", "name") == [
        ("a1", "AclGrants", 1, "g", "n"), ("a2", "aclgrants", None, None, "m")]
    assert rows(spark.table(f"{trusted}.alerts_holdings_value"), "alertid", "RiskScore") == [("a1", 1.5)]
    main = {r["AlertId"]: r for r in spark.table(f"{trusted}.alerts").collect()}
    assert main["a1"]["Findings"]["k3"] == "3" and "code_snippet" not in main["a1"]["Findings"]
    assert main["a1"]["Holdings"].asDict() == {"count": 1} and main["a1"]["Labels"] == ["x"]
    assert trusted_normalise(spark, "2000-01-01", settings) == []
    settings["source"]["table_name"] = "absent"
    assert trusted_normalise(spark, DAY, settings) == []


def test_second_runs_replace_the_first(spark, tmp_path):
    """Also the quarantined records, and the rows of children that have none any more."""
    raw, trusted = new_database(spark, "raw"), new_database(spark, "trusted")
    folder = tmp_path / "in"
    config = {"source": {"input_path": str(folder), "multi_line": False},
              "destination": {"database": raw, "table": "alert", "partition_by": ["execution_date"],
                              "write_mode": "overwrite", "quarantine_table": "bad"}}
    settings = {"source": {"database_name": raw, "table_name": "alert", "partition_date_by": "execution_date"},
                "destination": {"database_name": trusted, "main_table_name": "m", "root_id": "id",
                                "partition_by": ["execution_date"], "write_mode": "overwrite"}}
    full = {"id": 1, "a": [{"x": 1}], "f": {**{f"k{i}": "s" for i in range(21)}, "o": [{"y": 2}]}}
    for day in ("2024-01-01", "2024-01-02"):
        land(folder, f"d-{day}.json", json.dumps(full) + "\n{cut\n")
        raw_ingest(spark, day, config)
        trusted_normalise(spark, day, settings)
    assert {n: spark.table(f"{trusted}.{n}").count() for n in ("m", "m_a", "m_f_o")} == {"m": 2, "m_a": 2, "m_f_o": 2}
    land(folder, "d-2024-01-02.json", json.dumps({"id": 2, "a": [], "f": {"k1": "s"}}) + "\n")
    raw_ingest(spark, "2024-01-02", config)
    assert trusted_normalise(spark, "2024-01-02", settings) == ["m"]
    assert {n: spark.table(f"{trusted}.{n}").count() for n in ("m", "m_a", "m_f_o")} == {"m": 2, "m_a": 1, "m_f_o": 1}
    assert rows(spark.table(f"{raw}.bad").select(F.col("execution_date").cast("string"))) == [("2024-01-01",)]


def test_raw_evolves_and_counts_in_one_pass(spark, tmp_path, database):
    config = {"source": {"input_path": str(tmp_path), "multi_line": False},
              "destination": {"database": database, "table": "t"}}
    land(tmp_path, "d-2024-01-01.json", '{"id": 1}\n{"id": 2}\n{bad\n')
    land(tmp_path, "d-2024-01-02.json", '{"ID": 3, "fresh": {"x": 1}}\n')
    first = raw_ingest(spark, "2024-01-01", config)
    assert (first.records, first.corrupt) == (3, 1)
    raw_ingest(spark, "2024-01-02", config)
    got = rows(spark.table(f"{database}.t"), "id", "fresh.x")
    assert got == [(1, None), (2, None), (3, 1), (None, None)]


@pytest.mark.parametrize("config", [
    {"source": {}, "destination": {"database": "d", "table": "t"}},
    {"source": {"input_path": "x"}, "destination": {"table": "t"}},
])
def test_raw_needs_its_settings(spark, config):
    with pytest.raises(ValueError, match="required"):
        raw_ingest(spark, DAY, config)


def sql_config(tmp_path, database, text, mode, **merge):
    (tmp_path / "q.sql").write_text(text)
    return {"source": {"query_path": str(tmp_path / "q.sql")},
            "destination": {"database_name": database, "table_name": "t", "write_mode": mode,
                            "partition_by": ["p"], "options": {"merge_config": merge, "compression": "zstd"}}}


def test_sql_load_modes(spark, tmp_path, database):
    load = lambda text, mode, **merge: sql_to_table(
        spark, sql_config(tmp_path, database, text, mode, **merge), "2024-01-01", "2024-01-02")
    one = "SELECT * FROM VALUES (1, 10, 'a'), (2, 10, 'b'), (2, 11, 'b') AS v(k, ts, p)"
    assert load(one, "merge", primary_key=["k"], timestamp_column="ts") == 2
    assert rows(spark.table(f"{database}.t"), "k", "ts", "p") == [(1, 10, "a"), (2, 11, "b")]
    more = "SELECT * FROM VALUES (1, 9, 'c', true), (2, 12, 'c', true), (3, 1, 'a', true) AS v(k, ts, p, extra)"
    assert load(more, "merge", primary_key="k", timestamp_column="ts") == 3
    assert rows(spark.table(f"{database}.t"), "k", "ts", "p", "extra") == [
        (1, 10, "a", None), (2, 12, "c", True), (3, 1, "a", True)]
    assert load("SELECT 7 AS k, 'c' AS p", "overwrite") == 1
    assert load("SELECT 8L AS k, '{start_date}' AS p", "append") == 1
    assert rows(spark.table(f"{database}.t"), "k", "p") == [(1, "a"), (3, "a"), (7, "c"), (8, "2024-01-01")]
    assert load("SELECT 1 AS k, 'x' AS p WHERE false", "append") == 0
    assert not any(spark.sparkContext._jsc.getPersistentRDDs())


def test_sql_load_refuses_values_that_do_not_fit(spark, tmp_path, database):
    load = lambda text, mode, **merge: sql_to_table(
        spark, sql_config(tmp_path, database, text, mode, **merge), "a", "b")
    load("SELECT 1 AS k, 'x' AS p", "append")
    for mode, merge in (("append", {}), ("merge", {"primary_key": ["k"]})):
        with pytest.raises(Exception, match="OVERFLOW"):
            load("SELECT 99999999999L AS k, 'x' AS p", mode, **merge)
    assert rows(spark.table(f"{database}.t")) == [(1, "x")]


@pytest.mark.parametrize("mode, merge", [("upsert", {}), ("merge", {})])
def test_sql_load_refuses_bad_modes(spark, tmp_path, database, mode, merge):
    with pytest.raises(ValueError):
        sql_to_table(spark, sql_config(tmp_path, database, "SELECT 1 AS k, 'x' AS p", mode, **merge), "a", "b")


ADMINS = "admin_id int, username string, status string"


def csv_config(tmp_path, database):
    return {"tablename": "admins", "source_path": str(tmp_path / "toload"), "archive_path": str(tmp_path / "loaded"),
            "orc_location": str(tmp_path / "orc"), "database": database}


def test_csv_full_load(spark, tmp_path, database):
    create_table(spark, f"{database}.admins", T.StructType.fromDDL(ADMINS))
    config = csv_config(tmp_path, database)
    assert csv_full_load(spark, config) == 0
    land(tmp_path / "toload/admins", "a.csv", "1;x;on\n2;y;off\n")
    land(tmp_path / "toload/admins", "notes.txt", "keep")
    assert csv_full_load(spark, config) == 2
    land(tmp_path / "toload/admins", "a.csv", "3;z;on\n")
    assert csv_full_load(spark, config) == 1
    assert rows(spark.table(f"{database}.admins")) == rows(spark.read.orc(str(tmp_path / "orc"))) == [(3, "z", "on")]
    assert [p.name for p in (tmp_path / "toload").rglob("*") if p.is_file()] == ["notes.txt"]
    assert (tmp_path / "loaded/admins/a.csv").read_text() == "3;z;on\n"
    land(tmp_path / "toload/admins", "empty.csv", "")
    assert csv_full_load(spark, config) == 0 and spark.table(f"{database}.admins").count() == 1


def test_csv_stream_archives_one_run_later(spark, tmp_path, database):
    create_table(spark, f"{database}.admins", T.StructType.fromDDL(ADMINS))
    land(tmp_path / "toload", "a.csv", "1;x;on\n")
    run = lambda: run_csv_stream(
        spark, str(tmp_path / "toload"), f"{database}.admins", str(tmp_path / "orc"),
        str(tmp_path / "archive"), str(tmp_path / "progress")).awaitTermination()
    run()
    assert rows(spark.table(f"{database}.admins")) == [(1, "x", "on")]
    run()
    assert spark.table(f"{database}.admins").count() == 1  # nothing new: nothing replaced
    land(tmp_path / "toload", "b.csv", "2;y;on\n")
    run()
    assert rows(spark.table(f"{database}.admins")) == [(2, "y", "on")]
    archived = [p.name for p in (tmp_path / "archive").rglob("*.csv")]
    left = [p.name for p in (tmp_path / "toload").glob("*.csv")]
    assert sorted(archived + left) == ["a.csv", "b.csv"]


def test_children_without_rows_get_no_table(spark):
    raw, trusted = new_database(spark, "raw"), new_database(spark, "trusted")
    df = spark.sql(f"SELECT 1 AS id, CAST(array() AS array<struct<x:int>>) AS a, DATE '{DAY}' AS execution_date")
    create_or_append(spark, df, f"{raw}.r")
    names = trusted_normalise(spark, DAY, {
        "source": {"database_name": raw, "table_name": "r", "partition_date_by": "execution_date"},
        "destination": {"database_name": trusted, "main_table_name": "m"}})
    assert names == ["m"] and not spark.catalog.tableExists(f"{trusted}.m_a")


@pytest.mark.parametrize("quarantine", [False, True])
def test_new_nested_fields_are_counted(spark, tmp_path, quarantine):
    raw = new_database(spark, "raw")
    create_table(spark, f"spark_catalog.{raw}.alert", T.StructType.fromDDL("id string, s struct<a:string>, l array<struct<b:bigint>>"), [])
    land(tmp_path / "in", f"r-{DAY}.json", [
        {"id": "1", "s": {"a": "x", "new": {"deep": 1}}, "l": [{"b": 1, "c": "y"}, {"b": 2}, {"c": "z"}]},
        {"id": "2", "s": {"a": "x"}, "l": []}])
    report = raw_ingest(spark, DAY, {
        "source": {"input_path": str(tmp_path / "in")},
        "destination": {"database": raw, "table": "alert", "write_mode": "append"} | (
            {"quarantine_table": "bad"} if quarantine else {})})
    assert (report.records, report.corrupt, report.lost_values) == (2, 0, {"s": 1, "l": 2})
    assert sorted(spark.table(f"{raw}.alert").select("id", "s.a", "l.b").toPandas()["id"]) == ["1", "2"]
