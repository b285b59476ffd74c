from __future__ import annotations

from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.sinks import tables as S
from sedimenta.sinks.files import archive_files, has_success_marker, write_json, write_many, write_orc
from sedimenta.sources.csv_scan import read_csv, read_csv_like
from sedimenta.sources.sql_text import date_window, load_sql, read_sql, run_sql
from sedimenta.sources.tables import read_date_slice, table_schema
from tests.conftest import rows


def frame(spark, text):
    return spark.sql(f"SELECT {text}")


def test_create_only_once_with_properties(spark, database):
    name = f"{database}.t"
    schema = T.StructType.fromDDL("a int, `odd name` struct<`x-y`:int>, day date")
    assert S.create_table(spark, name, schema, ["day"], properties={"team": "data"})
    assert not S.create_table(spark, name, schema)
    assert table_schema(spark, name).fieldNames() == ["a", "odd name", "day"]
    shown = spark.sql(f"SHOW CREATE TABLE {name}").first()[0]
    assert "'team' = 'data'" in shown and "PARTITIONED BY (day)" in shown and "USING parquet" in shown


def test_create_as_orc_at_a_location(spark, database, tmp_path):
    name = f"{database}.admins"
    schema = T.StructType.fromDDL("admin_id int, username string")
    S.create_table(spark, name, schema, file_format="orc", location=str(tmp_path / "admins"))
    S.append(frame(spark, "1 AS admin_id, 'x' AS username"), name)
    assert list((tmp_path / "admins").glob("*.orc")) and spark.table(name).count() == 1


def test_sync_adds_all_new_columns_once(spark, database):
    name = f"{database}.t"
    S.create_or_append(spark, frame(spark, "1 AS a, 'p' AS part"), name, ["part"])
    schema = T.StructType.fromDDL("A int, b struct<`x y`:int>, c map<string,string>")
    assert S.sync_schema(spark, schema, name) == ["b", "c"]
    assert S.sync_schema(spark, schema, name) == []
    assert spark.table(name).columns == ["a", "b", "c", "part"]
    S.create_or_append(spark, frame(spark, "'q' AS part, named_struct('x y', 5) AS b, 2 AS a"), name, ["part"])
    assert rows(spark.table(name), "a", "b.`x y`", "part") == [(1, None, "p"), (2, 5, "q")]


def test_modes(spark, database):
    name = f"{database}.t"
    S.create_or_append(spark, frame(spark, "explode(array(1, 2)) AS a, 'p' AS part"), name, ["part"])
    S.create_or_append(spark, frame(spark, "9 AS a, 'q' AS part"), name, ["part"], "overwrite")
    assert rows(spark.table(name)) == [(1, "p"), (2, "p"), (9, "q")]
    S.create_or_append(spark, frame(spark, "5 AS a, 'p' AS part"), name, ["part"], "overwrite")
    assert rows(spark.table(name)) == [(5, "p"), (9, "q")]
    S.replace_all(frame(spark, "7 AS a, 'z' AS part"), name)
    assert rows(spark.table(name)) == [(7, "z")]
    with pytest.raises(ValueError, match="write mode"):
        S.create_or_append(spark, frame(spark, "1 AS a, 'p' AS part"), name, mode="upsert")
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_parallel_writes_of_both_overwrite_modes(spark, database):
    for i in range(4):
        S.create_or_append(spark, frame(spark, "1 AS a, 'p' AS part UNION ALL SELECT 2, 'q'"), f"{database}.t{i}", ["part"])
    new = frame(spark, "3 AS a, 'q' AS part")
    S.write_all([
        *[lambda i=i: S.overwrite_partitions(new, f"{database}.t{i}") for i in (0, 1)],
        *[lambda i=i: S.replace_all(new, f"{database}.t{i}") for i in (2, 3)]])
    assert [spark.table(f"{database}.t{i}").count() for i in range(4)] == [2, 2, 1, 1]


def test_parallel_write_errors_are_raised(spark):
    def fail():
        raise OSError("no space")

    with pytest.raises(OSError):
        S.write_all([fail, lambda: None])


def test_write_safely_refuses_what_the_catalog_cannot_hold(spark, database):
    name = f"{database}.t"
    S.create_table(spark, name, T.StructType.fromDDL("a int"))
    with pytest.raises(ValueError, match="'?s'?"):
        S.write_safely(spark, frame(spark, "1 AS a, named_struct('long', 1) AS s"), name, type_limit=10)
    assert spark.table(name).columns == ["a"]


def test_partition_transforms_on_the_built_in_catalog(spark, database):
    name = f"{database}.t"
    batch = frame(spark, "TIMESTAMP '2024-03-05 10:11:12' AS ts, 1 AS id")
    for _ in range(2):
        S.create_or_append(spark, batch, name, ["months(ts)", "hours(ts)", "bucket(2, id)"])
    assert [str(v) for v in spark.table(name).first()[-2:]] == ["2024-03-01", "2024-03-05 10:00:00"]
    assert spark.table(name).count() == 2


def test_only_text_options_reach_the_writer():
    assert S.string_options({"a": "b", "merge_config": {"x": 1}, "n": 3}) == {"a": "b"}
    assert S.string_options(None) == {}


def test_v2_is_a_question_of_the_catalog(spark):
    assert not S.is_v2(spark, "db.t") and not S.is_v2(spark, "spark_catalog.db.t")
    spark.conf.set("spark.sql.catalog.lake", "x.y.Z")
    assert S.is_v2(spark, "lake.db.t")
    spark.conf.unset("spark.sql.catalog.lake")


def test_csv_rows_of_every_kind(spark, tmp_path, database):
    (tmp_path / "a.csv").write_text('1;plain;x\n2;"semi;colon";"say ""hi"""\n3;short\nabc;bad int;y\n4;a;b;extra\n;;\n')
    schema = T.StructType.fromDDL("id int, name string, note string")
    got = rows(read_csv(spark, str(tmp_path), schema))
    assert got == sorted([
        (1, "plain", "x"), (2, "semi;colon", 'say "hi"'), (3, "short", None), (None, "bad int", "y"),
        (4, "a", "b"), (None, None, None)], key=repr)
    S.create_table(spark, f"{database}.t", schema)
    assert rows(read_csv_like(spark, str(tmp_path), f"{database}.t")) == got


def test_files(spark, tmp_path):
    df = frame(spark, "1 AS a, CAST(NULL AS STRING) AS b")
    write_orc(df, str(tmp_path / "orc"))
    assert has_success_marker(spark, str(tmp_path / "orc")) and not has_success_marker(spark, str(tmp_path))
    write_json(df, str(tmp_path / "json"))
    assert next((tmp_path / "json").glob("*.json")).read_text() == '{"a":1,"b":null}\n'


def test_empty_batch_is_not_written(spark):
    calls = []
    assert write_many(spark.range(0), [calls.append]) == 0 and calls == []
    assert write_many(spark.range(3), [lambda df: calls.append(df.count())]) == 3 and calls == [3]


def test_archive_moves_exactly_the_given_files(spark, tmp_path):
    for name in ("in/a.csv", "in/deep/b.csv", "in/later.csv", "out/a.csv"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(name)
    moved = archive_files(spark, [f"file:{tmp_path}/in/a.csv", f"file:{tmp_path}/in/deep/b.csv"], str(tmp_path / "out"))
    assert moved == 2
    assert (tmp_path / "out/a.csv").read_text() == "in/a.csv" and (tmp_path / "out/b.csv").exists()
    assert [p.name for p in (tmp_path / "in").rglob("*.csv")] == ["later.csv"]
    with pytest.raises(ValueError, match="one file"):
        archive_files(spark, [f"{tmp_path}/x/a.csv", f"{tmp_path}/y/a.csv"], str(tmp_path / "out"))


def test_sql_text(spark, tmp_path):
    (tmp_path / "q.sql").write_text("SELECT '{start_date}' AS a,\n CAST(:end_date AS DATE) AS b")
    assert "\n" in load_sql(spark, str(tmp_path / "q.sql"))
    row = read_sql(spark, str(tmp_path / "q.sql"), "2024-01-01", "2024-01-02").first()
    assert row["a"] == "2024-01-01" and str(row["b"]) == "2024-01-02"
    assert run_sql(spark, "SELECT 1 AS a", "x", "y").first()["a"] == 1


def test_date_window():
    assert date_window("2024-02-29") == ("2024-02-29", "2024-03-01")
    assert date_window("2024-02-29", "a", "b") == ("a", "b")
    assert date_window("2023-12-31", "a") == ("2023-12-31", "2024-01-01")


def test_date_slice(spark, database):
    assert read_date_slice(spark, f"{database}.absent", "ts", "2024-01-01") is None
    S.create_or_append(spark, frame(spark, "TIMESTAMP '2024-01-01 23:59:59' AS ts"), f"{database}.t")
    assert read_date_slice(spark, f"{database}.t", "ts", "2024-01-01").count() == 1
    assert read_date_slice(spark, f"{database}.t", "ts", "2024-01-02").count() == 0
    with pytest.raises(ValueError, match="no column"):
        read_date_slice(spark, f"{database}.t", "nope", "2024-01-01")


def test_scratch_is_the_folder_the_session_names(spark):
    from sedimenta.scratch import new_path, stage

    folder = spark.conf.get("spark.checkpoint.dir")
    path = new_path(spark, "x")
    assert path.startswith(folder) and path != new_path(spark, "x")
    staged = stage(spark.range(3), "numbers")
    assert all(urlparse(f).path.startswith(str(Path(folder))) for f in staged.inputFiles())


def test_values_that_do_not_fit_are_reported(spark, database):
    name = f"{database}.t"
    S.create_table(spark, name, T.StructType.fromDDL("a int, b string"))
    assert S.write_safely(spark, frame(spark, "explode(array('1', 'x', 'y')) AS a, 1 AS b"), name) == {"a": 2}
    assert S.create_or_append(spark, frame(spark, "'5' AS a, 'q' AS b"), name) == {}
    assert S.create_or_append(spark, frame(spark, "'z' AS a WHERE false"), name) == {}
    assert rows(spark.table(name)) == [(1, "1"), (5, "q"), (None, "1"), (None, "1")]


def test_gathered_partitions_have_few_files(spark, database):
    name = f"{database}.t"
    many = spark.range(0, 1000, 1, 8).selectExpr("id", "CAST(id % 5 AS STRING) AS part")
    S.create_or_append(spark, many, name, ["part"], gather=True)
    assert len(spark.table(name).inputFiles()) == 5 and spark.table(name).count() == 1000


@pytest.mark.parametrize("partition_by", [None, ["p"], ["bucket(2, id)"], ["days(at)"]])
def test_a_table_is_made_with_its_rows_or_not_at_all(spark, database, partition_by):
    df = spark.sql("SELECT CAST(id AS int) AS id, CAST(id % 2 AS string) AS p, TIMESTAMP_NTZ '2024-01-01 10:00:00' AS at FROM range(6)")
    broken = df.withColumn("id", F.when(F.col("id") == 5, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        S.create_or_append(spark, broken, f"{database}.t", partition_by)
    assert not spark.catalog.tableExists(f"{database}.t")
    for _ in range(2):
        S.create_or_append(spark, df, f"{database}.t", partition_by)
    assert rows(spark.table(f"{database}.t"), "id", "p") == rows(df.unionAll(df), "id", "p")
    with pytest.raises(ValueError, match="mode"):
        S.create_or_append(spark, df, f"{database}.u", partition_by, mode="sideways")
