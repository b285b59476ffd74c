"""Loads that know their files (sources.ledger, plans.csv_load)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.plans import csv_load
from sedimenta.sinks import files
from sedimenta.sinks.tables import create_table
from sedimenta.sources.ledger import Ledger, files_in, only_claimed
from tests.conftest import rows

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())])


def land(folder, **contents):
    folder.mkdir(parents=True, exist_ok=True)
    for name, text in contents.items():
        (folder / f"{name}.csv").write_text(text)


@pytest.fixture
def config(spark, tmp_path, database):
    create_table(spark, f"{database}.t", SCHEMA)
    return {"tablename": "t", "source_path": str(tmp_path / "in"), "archive_path": str(tmp_path / "done"),
            "orc_location": str(tmp_path / "orc"), "database": database}


def both_sinks(spark, config):
    return rows(spark.table(f"{config['database']}.t")), rows(spark.read.orc(config["orc_location"]))


def names(folder):
    return sorted(p.name for p in folder.rglob("*.csv"))


def last_states(spark, config):
    return sorted(r["state"] for r in Ledger.open(spark, f"spark_catalog.{config['database']}.t").rows().groupBy("batch_id").agg(
        F.max_by("state", "moment").alias("state")).collect())


def test_died_between_the_sinks(spark, tmp_path, config, monkeypatch):
    """A file comes before the next run: every file's rows once, in both sinks, and every file in the archive."""
    land(tmp_path / "in/t", a="1;x\n", b="2;y\n")

    def lost(*_):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as m:
        m.setattr(csv_load, "write_orc", lost)
        with pytest.raises(RuntimeError):
            csv_load.csv_full_load(spark, config)
    assert rows(spark.table(f"{config['database']}.t")) == [(1, "x"), (2, "y")] and names(tmp_path / "in") == ["a.csv", "b.csv"]
    land(tmp_path / "in/t", c="3;z\n")
    assert csv_load.csv_full_load(spark, config) == 3
    assert both_sinks(spark, config) == ([(1, "x"), (2, "y"), (3, "z")],) * 2
    assert names(tmp_path / "in") == [] and names(tmp_path / "done") == ["a.csv", "b.csv", "c.csv"]
    assert last_states(spark, config) == ["archived", "superseded"]


@pytest.mark.parametrize("moved", [0, 1, 2])
def test_died_while_archiving(spark, tmp_path, config, monkeypatch, moved):
    """The next run finishes that, and loads only what came since."""
    land(tmp_path / "in/t", a="1;x\n", b="2;y\n")
    real, done = files._move, []

    def some(spark, source, target):
        if len(done) == moved:
            raise RuntimeError("lost the driver")
        done.append(source)
        real(spark, source, target)

    with monkeypatch.context() as m:
        m.setattr(files, "_move", some)
        if moved == 2:  # all moved, and not recorded
            mark = csv_load.Ledger.mark

            def unrecorded(self, batch, state):
                if state == "archived":
                    raise RuntimeError("lost the driver")
                mark(self, batch, state)

            m.setattr(csv_load.Ledger, "mark", unrecorded)
        with pytest.raises(RuntimeError):
            csv_load.csv_full_load(spark, config)
    assert both_sinks(spark, config) == ([(1, "x"), (2, "y")],) * 2
    assert csv_load.csv_full_load(spark, config) == 0
    assert both_sinks(spark, config) == ([(1, "x"), (2, "y")],) * 2
    assert names(tmp_path / "in") == [] and names(tmp_path / "done") == ["a.csv", "b.csv"]
    land(tmp_path / "in/t", a="9;new\n")
    assert csv_load.csv_full_load(spark, config) == 1
    assert both_sinks(spark, config) == ([(9, "new")],) * 2 and (tmp_path / "done/t/a.csv").read_text() == "9;new\n"


def test_files_that_come_while_a_load_runs_wait(spark, tmp_path, config, monkeypatch):
    land(tmp_path / "in/t", a="1;x\n")
    real = csv_load.require_own_names

    def arriving(claimed):
        land(tmp_path / "in/t", b="2;y\n")
        real(claimed)

    monkeypatch.setattr(csv_load, "require_own_names", arriving)
    assert csv_load.csv_full_load(spark, config) == 1
    assert both_sinks(spark, config) == ([(1, "x")],) * 2
    assert names(tmp_path / "in") == ["b.csv"] and names(tmp_path / "done") == ["a.csv"]


def test_equal_names_are_refused_before_anything_is_written(spark, tmp_path, config):
    land(tmp_path / "in/t", a="1;x\n")
    land(tmp_path / "in/t/deep", a="2;y\n")
    with pytest.raises(ValueError, match="a.csv"):
        csv_load.csv_full_load(spark, config)
    assert spark.table(f"{config['database']}.t").count() == 0 and names(tmp_path / "in") == ["a.csv", "a.csv"]


def test_claims_are_of_files_as_they_were(spark, tmp_path, database):
    """A file that has grown since is another one; odd names meet."""
    create_table(spark, f"{database}.t", SCHEMA)
    land(tmp_path, **{"a b%": "1;x\n", "c": "2;y\n"})
    ledger = Ledger.open(spark, f"{database}.t")
    batch = ledger.claim(files_in(spark, str(tmp_path), "*.csv"))
    land(tmp_path, c="2;y\n3;z\n", d="4;w\n")
    read = spark.read.schema(SCHEMA).option("sep", ";").csv(str(tmp_path))
    assert rows(only_claimed(read, ledger.claimed(batch))) == [(1, "x")]
    assert sorted(p.rsplit("/", 1)[-1] for p in ledger.paths(batch)) == ["a b%.csv", "c.csv"]
    assert ledger.batches("claimed", ["loaded"]) == [batch] and ledger.batches("loaded", []) == []
