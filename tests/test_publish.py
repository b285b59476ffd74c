"""Loads of several tables that show as one (sinks.publish, plans.fanout)."""

from __future__ import annotations

import json
import threading
from unittest import mock

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta import scratch
from sedimenta.operators.nested import map_child, map_children, plan_normalisation, stage_map_elements
from sedimenta.plans import fanout
from sedimenta.plans import trusted as plans_trusted
from sedimenta.plans.raw import raw_ingest
from sedimenta.plans.trusted import trusted_normalise, with_audit
from sedimenta.scratch import new_database, stage
from sedimenta.sinks import publish
from sedimenta.sinks.tables import create_or_append, overwrite_partitions
from tests.conftest import rows

DAY = "2024-01-15"


def raw_table(spark, documents, day=DAY):
    """A raw table of one day with an array and a text map."""
    database = new_database(spark, "raw")
    text = [(d["id"], d.get("a", []), {k: json.dumps(v) for k, v in d["m"].items()}) for d in documents]
    df = spark.createDataFrame(text, "id int, a array<struct<x:int>>, m map<string,string>")
    create_or_append(spark, df.withColumn("execution_date", F.lit(day).cast("date")), f"{database}.r", ["execution_date"])
    return database


def settings(raw, trusted, mode="overwrite", **more):
    return {"source": {"database_name": raw, "table_name": "r", "partition_date_by": "execution_date"},
            "destination": {"database_name": trusted, "main_table_name": "m", "root_id": "id",
                            "partition_by": ["execution_date"], "write_mode": mode} | more}


DOCUMENTS = [
    {"id": 1, "a": [(1,), (2,)], "m": {"one": [{"v": 1, "w": "s"}], "two": [{"v": "text"}], "s": "t"}},
    {"id": 2, "a": [(3,)], "m": {"one": [{"v": 2}, {"v": 3}], "three": [{"u": [1, 2]}]}},
]
TABLES = ["m", "m_a", "m_m_one", "m_m_two", "m_m_three"]


def contents(spark, database):
    found = {}
    for t in TABLES:
        name = f"{database}.{t}"
        if spark.catalog.tableExists(name):
            found[t] = rows(spark.table(name).drop("_trusted_ingested_at"))
    return found


def failing_after(monkeypatch, n):
    """``apply`` that dies after n steps."""
    real = publish.apply

    def apply(spark, steps):
        real(spark, steps[:n])
        raise RuntimeError("lost the driver")

    monkeypatch.setattr(publish, "apply", apply)


@pytest.mark.parametrize("mode", ["overwrite", "append"])
@pytest.mark.parametrize("done", [0, 1, 3])
def test_a_run_that_died_while_publishing_is_finished(spark, monkeypatch, mode, done):
    raw, trusted, other = raw_table(spark, DOCUMENTS), new_database(spark, "t"), new_database(spark, "o")
    trusted_normalise(spark, DAY, settings(raw, other, mode))
    with monkeypatch.context() as m:
        failing_after(m, done)
        with pytest.raises(RuntimeError, match="lost the driver"):
            trusted_normalise(spark, DAY, settings(raw, trusted, mode))
    assert sorted(trusted_normalise(spark, DAY, settings(raw, trusted, mode))) == sorted(TABLES)
    assert contents(spark, trusted) == contents(spark, other)
    states = spark.table(f"{trusted}.m__runs").groupBy("run_id").agg(F.max_by("state", "moment").alias("last"))
    assert {r["last"] for r in states.collect()} == {"done"}
    assert publish.recover(spark, f"{trusted}.m") == {}


@pytest.mark.parametrize("failing", ["write", "commit"])
def test_a_run_that_died_before_its_commit_is_undone(spark, monkeypatch, failing):
    raw, trusted = raw_table(spark, DOCUMENTS), new_database(spark, "t")
    trusted_normalise(spark, DAY, settings(raw, trusted))
    before = contents(spark, trusted)
    more = raw_table(spark, [{"id": 9, "a": [(9,)], "m": {"one": [{"v": 9, "new": True}]}}])
    folders = []
    with monkeypatch.context() as m:
        if failing == "write":
            def no_map(self, *_):
                folders.append(self.run.folder)
                raise RuntimeError("lost an executor")
            m.setattr("sedimenta.plans.trusted._Load.write_map", no_map)
        else:
            def no_commit(_, run, steps):
                folders.append(run.folder)
                raise RuntimeError("lost the driver")
            m.setattr("sedimenta.plans.trusted.publish", no_commit)
        with pytest.raises(RuntimeError, match="lost"):
            trusted_normalise(spark, DAY, settings(more, trusted))
    columns = {t: spark.table(f"{trusted}.{t}").drop("_trusted_ingested_at", "new").columns for t in TABLES}
    assert {t: rows(spark.table(f"{trusted}.{t}"), *columns[t]) for t in TABLES} == before
    assert trusted_normalise(spark, DAY, settings(more, trusted)) == ["m", "m_a", "m_m_one"]
    assert not publish._hadoop(spark, folders[0])[0].exists(publish._hadoop(spark, folders[0])[1])
    assert rows(spark.table(f"{trusted}.m_m_one"), "id", "v", "new") == [(9, 9, True)]
    assert spark.table(f"{trusted}.m_m_two").count() == spark.table(f"{trusted}.m_m_three").count() == 0


def test_appends_join_a_day_and_replaced_folders_go(spark):
    raw, trusted = raw_table(spark, DOCUMENTS), new_database(spark, "t")
    for _ in range(2):
        trusted_normalise(spark, DAY, settings(raw, trusted, "append"))
    assert {t: len(r) for t, r in contents(spark, trusted).items()} == {"m": 4, "m_a": 6, "m_m_one": 6, "m_m_two": 2, "m_m_three": 2}
    first = publish.location_of(spark, f"{trusted}.m", f"execution_date={DAY}")
    trusted_normalise(spark, DAY, settings(raw, trusted))
    fs, path = publish._hadoop(spark, first)
    assert not fs.exists(path) and len(contents(spark, trusted)["m"]) == 2
    # Later writes of other kinds find the switched partitions.
    table = spark.table(f"{trusted}.m")
    overwrite_partitions(stage(table.where("id = 1"), "one"), f"{trusted}.m")
    assert rows(spark.table(f"{trusted}.m"), "id") == [(1,)]


def test_children_equal_their_own_frames(spark, monkeypatch):
    """Every child by the common write as by a frame of its own: odd and clashing names, types of a known table, nulls."""
    documents = [{"id": i, "m": {
        "One": [{"v": i, "odd name": "s", "Id": 1, "id": "x"}], "one": [{"v": None}], "two": [{"v": f"t{i}", "odd.name": [i]}],
        "three": [{"execution_date": "mine", "v": 1.5}], "four": [{"nested": {"b": i, "a": [{"c": "d"}]}, "odd_name": "x"}],
        "five": [{"v": i, "odd-name": "t"}], "none": [{}]}} for i in range(4)]
    raw, trusted = raw_table(spark, documents), new_database(spark, "t")
    spark.sql(f"CREATE TABLE {trusted}.m_m_five (v string, extra int, execution_date date) USING parquet PARTITIONED BY (execution_date)")
    names = trusted_normalise(spark, DAY, settings(raw, trusted))
    assert names == ["m", *(f"m_m_{k}" for k in ("five", "four", "one", "three", "two"))]
    df = spark.table(f"{raw}.r")
    plan = plan_normalisation(df, "m", "id")
    elements = stage_map_elements(df, plan.maps[0], "id")
    for child in map_children(elements, plan.maps[0]):
        alone = with_audit(map_child(elements, plan.maps[0], child, "id"), DAY, F.current_timestamp()).drop("_trusted_ingested_at")
        got = spark.table(f"{trusted}.{child.table}")
        if child.table == "m_m_five":
            assert rows(got, "v", "extra", "odd_name") == rows(alone.select(F.col("v").cast("string"), F.lit(None), "odd_name"))
            continue
        assert rows(got.select(alone.columns)) == rows(alone)


def test_jobs_do_not_grow_with_the_keys(spark):
    def jobs(keys):
        documents = [{"id": i, "m": {f"k{k}": [{"v": i, f"own{k}": str(i)}] for k in range(keys)}} for i in range(3)]
        raw, trusted = raw_table(spark, documents), new_database(spark, "t")
        group = f"keys-{keys}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            assert len(trusted_normalise(spark, DAY, settings(raw, trusted))) == keys + 1
            return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    few, many = jobs(2), jobs(25)
    assert many <= few + 2


def test_layers_part_only_what_disagrees():
    def child(name, ddl):
        return fanout.ChildRows(name, name, [], T.StructType.fromDDL(ddl))

    children = [child("a", "v int, w string"), child("b", "v string"), child("c", "w string, x int"), child("d", "V int"), child("e", "v string, x int")]
    assert [[c.key for c in g] for g in fanout.layers(children)] == [["a", "c"], ["b", "e"], ["d"]]
    assert [[c.key for c in g] for g in fanout.layers(children[:1] + children[2:3], most_columns=2)] == [["a"], ["c"]]


def test_children_are_not_dealt_by_key(spark):
    """All rows of one key never meet in a task, however many rows and tasks there are."""
    elements = spark.range(100).select("id", F.when(F.col("id") % 10 == 0, "few").otherwise("many").alias("_key"))
    children = [fanout.ChildRows(key, f"t_{key}", [(T.StructField("id", T.LongType()), F.col("id"))], T.StructType.fromDDL("id bigint"))
                for key in ("few", "many")]
    wide, _ = fanout.wide_rows(elements, "_key", children)
    assert "Exchange hashpartitioning" not in wide._jdf.queryExecution().executedPlan().toString()
    assert wide.groupBy("_child").count().orderBy("_child").collect() == [("t_few", 10), ("t_many", 90)]


def test_folders_are_written_without_a_sort(spark, database):
    """Rows go to the folders of their partitions as they come; past the files a task may hold open nothing is lost."""
    folders = 2 * scratch.OPEN_FOLDERS
    df = spark.range(1000).select("id", (F.col("id") % folders).alias("p"))
    create_or_append(spark, df.limit(0), f"{database}.t", ["p"])
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    with scratch.unsorted_folders(spark):
        with scratch.unsorted_folders(spark):
            assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) == scratch.OPEN_FOLDERS
        plan = spark.sql(f"EXPLAIN INSERT INTO {database}.t SELECT id, id % {folders} FROM range(1000)").collect()[0][0]
    assert "Sort" not in plan and spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    run = publish.begin(spark, f"{database}.t", "x")
    asked = []
    with mock.patch.object(publish, "unsorted_folders", side_effect=lambda s: asked.append(s) or scratch.unsorted_folders(s)):
        folder = publish.stage_rows(run, df, "t", ["p"])
    assert asked and rows(spark.read.parquet(folder).select("id", F.col("p").cast("long"))) == rows(df)


def test_maps_do_not_wait_for_the_other_tables_nor_these_for_them(spark):
    """The main table is written while a map's elements are still to be laid out."""
    raw, trusted = raw_table(spark, [{"id": 1, "a": [(1,)], "m": {"k": [{"v": 1}]}}]), new_database(spark, "trusted")
    written = threading.Event()
    real_write, real_stage = plans_trusted._Load.write, plans_trusted.stage_map_elements

    def write(self, name, frame):
        real_write(self, name, frame)
        if name == "m":
            written.set()

    def staged(*args):
        assert written.wait(60)
        return real_stage(*args)

    with mock.patch.object(plans_trusted._Load, "write", write), mock.patch.object(plans_trusted, "stage_map_elements", staged):
        assert trusted_normalise(spark, DAY, settings(raw, trusted)) == ["m", "m_a", "m_m_k"]
    assert rows(spark.table(f"{trusted}.m_m_k").select("id", "v")) == [(1, 1)]


def test_partitions_with_odd_values(spark, database):
    """Values that folder names escape, and nulls."""
    df = spark.createDataFrame([(1, "a/b=c'd"), (2, None), (3, "ü %")], "id int, p string")
    create_or_append(spark, df.limit(0), f"{database}.t", ["p"])
    for i in range(2):
        run = publish.begin(spark, f"{database}.t", "x")
        folder = publish.stage_rows(run, df.withColumn("id", F.col("id") + i), "t", ["p"])
        publish.publish(spark, run, publish.steps_for(spark, f"{database}.t", folder, "overwrite"))
    assert rows(spark.table(f"{database}.t")) == [(2, "a/b=c'd"), (3, None), (4, "ü %")]


def land_day(folder, day, lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"d-{day}.json").write_text("\n".join(lines) + "\n")


def raw_settings(folder, database, mode="overwrite"):
    return {"source": {"input_path": str(folder), "multi_line": False},
            "destination": {"database": database, "table": "r", "partition_by": ["execution_date"], "write_mode": mode,
                            "quarantine_table": "bad"}}


@pytest.mark.parametrize("done", [0, 1])
def test_raw_load_publishes_good_and_corrupt_records_together(spark, tmp_path, monkeypatch, done):
    database = new_database(spark, "raw")
    land_day(tmp_path, DAY, ['{"id": 1, "v": "a"}', '{cut', '{"id": 2}'])
    with monkeypatch.context() as m:
        failing_after(m, done)
        with pytest.raises(RuntimeError, match="lost the driver"):
            raw_ingest(spark, DAY, raw_settings(tmp_path, database, "append"))
    assert raw_ingest(spark, DAY, raw_settings(tmp_path, database, "append")).files == 0  # finished what was committed
    assert rows(spark.table(f"{database}.r"), "id", "v") == [(1, "a"), (2, None)]
    assert rows(spark.table(f"{database}.bad"), "_corrupt_record") == [("{cut",)]
    land_day(tmp_path, DAY, ['{"id": 3, "w": 1.5}'])
    report = raw_ingest(spark, DAY, raw_settings(tmp_path, database))
    assert (report.files, report.records, report.corrupt) == (1, 1, 0)
    assert rows(spark.table(f"{database}.r"), "id", "v", "w") == [(3, None, 1.5)]
    assert spark.table(f"{database}.bad").count() == 0


def test_raw_load_parses_once_and_stages_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("sedimenta.sources.json_scan.stage", None)
    database = new_database(spark, "raw")
    land_day(tmp_path, DAY, ['{"id": 1}', '{"id": "x"', ' '])
    report = raw_ingest(spark, DAY, raw_settings(tmp_path, database))
    assert (report.records, report.corrupt) == (1, 1)
    assert "_corrupt_record" not in spark.table(f"{database}.r").columns


def evolving(folder, database, mode="overwrite", **more):
    config = raw_settings(folder, database, mode)
    config["destination"] |= {"evolve_nested": True} | more
    if more.get("quarantine_table", "") is None:
        del config["destination"]["quarantine_table"]
    return config


@pytest.mark.parametrize("quarantine", ["bad", None])
def test_new_nested_fields_are_stored(spark, tmp_path, quarantine):
    """At every level, beside new columns; earlier rows have null, nothing counts as lost, every schema is kept."""
    database = new_database(spark, "raw")
    config = evolving(tmp_path, database, quarantine_table=quarantine)
    land_day(tmp_path, "2024-01-01", ['{"id": 1, "s": {"a": "x", "l": [{"b": 1}]}}', "{cut"])
    land_day(tmp_path, "2024-01-02", ['{"id": 2, "s": {"A": "y", "new one": {"deep": 1.5}, "l": [{"b": 2, "c": "z"}, {}]}, "more": true}'])
    land_day(tmp_path, "2024-01-03", ['{"id": 3, "s": {"l": [{"c": "w"}], "new one": {"other": [1]}}}'])
    for day in ("2024-01-01", "2024-01-02", "2024-01-03", "2024-01-02"):
        assert raw_ingest(spark, day, config).lost_values == {}
    table = spark.table(f"{database}.r").where("id IS NOT NULL")
    assert table.schema["s"].dataType.simpleString() == (
        "struct<a:string,l:array<struct<b:bigint,c:string>>,new_one:struct<deep:double,other:array<bigint>>>")
    got = rows(table, "id", "s.a", "s.l.b", "s.l.c", "s.new_one.deep", "s.new_one.other", "more")
    assert got == [(1, "x", [1], [None], None, None, None), (2, "y", [2, None], ["z", None], 1.5, None, True),
                   (3, None, [None], ["w"], None, [1], None)]
    versions = publish.schema_versions(spark, f"{database}.r")
    assert [v["s"].dataType.simpleString().count(":") for v in versions] == [3, 6, 7] and versions[-1].fieldNames() == table.schema.fieldNames()


@pytest.mark.parametrize("done", [0, 1, 2])
def test_a_table_half_reshaped_is_finished(spark, tmp_path, monkeypatch, done):
    database = new_database(spark, "raw")
    land_day(tmp_path, "2024-01-01", ['{"id": 1, "s": {"a": "x"}}'])
    land_day(tmp_path, "2024-01-02", ['{"id": 2, "s": {"a": "y", "b": 2}}'])
    config = evolving(tmp_path, database)
    raw_ingest(spark, "2024-01-01", config)
    with monkeypatch.context() as m:
        if done == 2:  # dropped, not yet made anew
            real = publish.create_table
            m.setattr(publish, "create_table", lambda spark, table, *a, **k: None if k.get("location") and "sedimenta.schema.v2.0" in k["properties"]
                      else real(spark, table, *a, **k))
            with pytest.raises(Exception):
                raw_ingest(spark, "2024-01-02", config)
            assert not spark.catalog.tableExists(f"{database}.r")
        else:
            failing_after(m, done)
            with pytest.raises(RuntimeError, match="lost the driver"):
                raw_ingest(spark, "2024-01-02", config)
    raw_ingest(spark, "2024-01-02", config)
    assert rows(spark.table(f"{database}.r"), "id", "s.a", "s.b") == [(1, "x", None), (2, "y", 2)]


def test_tables_of_others_do_not_evolve(spark, tmp_path):
    database = new_database(spark, "raw")
    spark.sql(f"CREATE TABLE {database}.r (id bigint, s struct<a:string>, execution_date date) USING parquet PARTITIONED BY (execution_date)")
    land_day(tmp_path, DAY, ['{"id": 1, "s": {"a": "x", "b": 1}}'])
    assert raw_ingest(spark, DAY, evolving(tmp_path, database)).lost_values == {"s": 1}
    assert rows(spark.table(f"{database}.r"), "id", "s.a") == [(1, "x")]
    with pytest.raises(ValueError, match="evolve_nested"):
        raw_ingest(spark, DAY, evolving(tmp_path, database, partition_by=[]))
