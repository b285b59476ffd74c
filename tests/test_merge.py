from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sedimenta.operators.merge import latest_per_key, merge_frames, merge_pruned
from sedimenta.sinks.tables import align_for, create_or_append
from sedimenta.sinks.upsert import merge_statement, upsert
from tests.conftest import rows

DDL = "k int, ts int, v string"
TARGET = [(1, 10, "t"), (2, 10, "t"), (3, 10, "t"), (4, None, "t"), (5, 10, "t"), (None, 1, "t")]
SOURCE = [(1, 10, "s"), (2, 9, "s"), (3, 11, "s"), (4, 5, "s"), (5, None, "s"), (6, 1, "s"), (None, 1, "s")]


def expected(target, source, floor=None):
    """The merge, row by row."""
    out, matched = [], set()
    for k, ts, v in target:
        open_ = floor is None or (ts is not None and ts >= floor)
        hit = next((s for s in source if s[0] == k), None) if k is not None and open_ else None
        if hit:
            matched.add(k)
        take = hit and hit[1] is not None and ts is not None and hit[1] >= ts
        out.append(hit if take else (k, ts, v))
    return sorted(out + [s for s in source if s[0] is None or s[0] not in matched], key=repr)


def test_merge_rules(spark):
    t, s = spark.createDataFrame(TARGET, DDL), spark.createDataFrame(SOURCE, DDL)
    merged = rows(merge_frames(t, s, ["k"], "ts"))
    assert merged == expected(TARGET, SOURCE)
    assert (1, 10, "s") in merged and (2, 10, "t") in merged and (4, None, "t") in merged
    assert (None, 1, "t") in merged and (None, 1, "s") in merged


def test_merge_without_timestamp_always_updates(spark):
    t, s = spark.createDataFrame(TARGET, DDL), spark.createDataFrame(SOURCE, DDL)
    got = rows(merge_frames(t, s, ["k"]))
    assert [r for r in got if r[0] is not None] == [s for s in SOURCE if s[0] is not None]


def test_pruned_merge_duplicates_below_the_minimum(spark):
    target, source = [(1, 3, "t"), (2, 20, "t")], [(1, 7, "s"), (2, 25, "s")]
    t, s = spark.createDataFrame(target, DDL), spark.createDataFrame(source, DDL)
    got = rows(merge_pruned(t, s, ["k"], "ts", "ts"))
    assert got == expected(target, source, 7) == [(1, 3, "t"), (1, 7, "s"), (2, 25, "s")]


def test_pruned_merge_of_all_null_batch_prunes_nothing(spark):
    target, source = [(1, 3, "t")], [(1, None, "s")]
    t, s = spark.createDataFrame(target, DDL), spark.createDataFrame(source, DDL)
    assert rows(merge_pruned(t, s, ["k"], "ts", "ts")) == expected(target, source)


_rows = st.lists(st.tuples(st.none() | st.integers(0, 4), st.none() | st.integers(0, 3),
                           st.sampled_from("xyz")), max_size=8)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(_rows, st.lists(st.tuples(st.none() | st.integers(0, 4), st.none() | st.integers(0, 3),
                                 st.just("s")), max_size=5, unique_by=lambda r: r[0]))
def test_merge_against_row_by_row(spark, target, source):
    t, s = spark.createDataFrame(target, DDL), spark.createDataFrame(source, DDL)
    assert rows(merge_frames(t, s, ["k"], "ts")) == expected(target, source)


def test_latest_per_key(spark):
    data = [(1, 1, "a"), (1, 2, "b"), (1, None, "c"), (2, 5, "x"), (2, 5, "y"), (None, 1, "n"), (None, 2, "m")]
    df = spark.createDataFrame(data, DDL)
    for n in (1, 3):
        assert rows(latest_per_key(df.repartition(n), ["k"], "ts")) == [(1, 2, "b"), (2, 5, "y"), (None, 2, "m")]


def test_latest_per_key_with_map_column(spark):
    df = spark.sql("SELECT 1 AS k, 1 AS ts, map('a', 1) AS m UNION ALL SELECT 1, 2, map('b', 2)")
    assert latest_per_key(df, ["k"], "ts").first()["m"] == {"b": 2}


@pytest.mark.parametrize("partition_by", [None, ["v"], ["ts", "v"]])
def test_upsert_on_tables(spark, database, partition_by):
    name = f"{database}.t"
    create_or_append(spark, spark.createDataFrame(TARGET, DDL), name, partition_by)
    source = spark.createDataFrame(SOURCE, DDL)
    upsert(spark, name, align_for(spark, source, name), ["k"], "ts")
    assert rows(spark.table(name), "k", "ts", "v") == expected(TARGET, SOURCE)


def test_upsert_empties_a_partition_and_leaves_others(spark, database):
    name = f"{database}.t"
    create_or_append(spark, spark.createDataFrame([(1, 1, "old"), (2, 1, "far")], DDL), name, ["v"])
    before = {r["_metadata"]["file_path"] for r in spark.table(name).where("v = 'far'").select("_metadata").collect()}
    source = spark.createDataFrame([(1, 2, "new"), (None, 2, None)], DDL)
    upsert(spark, name, align_for(spark, source, name), ["k"], "ts")
    assert rows(spark.table(name), "k", "ts", "v") == [(1, 2, "new"), (2, 1, "far"), (None, 2, None)]
    after = {r["_metadata"]["file_path"] for r in spark.table(name).where("v = 'far'").select("_metadata").collect()}
    assert before == after
    again = spark.createDataFrame([(3, 2, None)], DDL)
    upsert(spark, name, align_for(spark, again, name), ["k"], "ts")
    assert spark.table(name).where("v IS NULL").count() == 2


def test_upsert_of_many_partitions_leaves_others_alone(spark, database):
    name = f"{database}.many"
    ddl = "k int, v string, p string, q int"
    old = [(i, "old", f"p'{i % 40}\\\\", i % 3) for i in range(240)] + [(900, "old", None, 1), (901, "old", "far", 7)]
    create_or_append(spark, spark.createDataFrame(old, ddl), name, ["p", "q"])
    far = spark.table(name).where("p = 'far'").select("_metadata.file_path").first()[0]
    batch = [(i, "new", f"p'{i % 40}\\\\", i % 3) for i in range(0, 200, 2)] + [(900, "new", "moved", 2), (950, "new", None, 5)]
    upsert(spark, name, align_for(spark, spark.createDataFrame(batch, ddl), name), ["k"])
    want = {r[0]: r for r in old} | {r[0]: r for r in batch}
    assert rows(spark.table(name), "k", "v", "p", "q") == sorted(want.values(), key=repr)
    assert spark.table(name).where("p = 'far'").select("_metadata.file_path").first()[0] == far
    assert spark.table(name).where("p is null and q = 1").isEmpty()


def test_merge_statement_text():
    text = merge_statement("cat.db.t", "v", ["a", "b"], "ts")
    assert "ON target.`a` = source.`a` AND target.`b` = source.`b` WHEN MATCHED AND source.`ts` >= target.`ts`" in text
    assert "None" not in merge_statement("cat.db.t", "v", ["a"], None)
    assert "target.`d` >= CAST('2024-01-01' AS TIMESTAMP) AND" in merge_statement(
        "cat.db.t", "v", ["a"], "ts", "d", "2024-01-01")


def test_upsert_needs_a_key(spark, database):
    with pytest.raises(ValueError, match="primary_key"):
        upsert(spark, f"{database}.t", spark.range(1), [])


def test_hot_target_key(spark):
    """A third of the target has one key, another third a null key."""
    t = spark.range(3000).selectExpr(
        "CAST(CASE WHEN id < 1000 THEN 7 WHEN id < 2000 THEN NULL ELSE id END AS INT) AS k", "1 AS ts", "'t' AS v")
    s = spark.createDataFrame([(7, 2, "s"), (None, 2, "s"), (9999, 2, "s")], DDL)
    merged = merge_frames(t, s, ["k"], "ts")
    assert {(r["v"], r["k"]): r["count"] for r in merged.where("k = 7 OR k IS NULL OR v = 's'")
            .groupBy("v", "k").count().collect()} == {
        ("s", 7): 1000, ("t", None): 1000, ("s", None): 1, ("s", 9999): 1}


@pytest.mark.parametrize("partition_by", [None, ["v"]])
def test_pruned_upsert_on_tables(spark, database, partition_by):
    name = f"{database}.t"
    target, source = [(1, 3, "t"), (2, 20, "t"), (3, 30, "u")], [(1, 7, "s"), (2, 25, "s"), (4, 9, "s")]
    create_or_append(spark, spark.createDataFrame(target, DDL), name, partition_by)
    upsert(spark, name, align_for(spark, spark.createDataFrame(source, DDL), name), ["k"], "ts", "ts")
    assert rows(spark.table(name), "k", "ts", "v") == expected(target, source, 7)


def test_upsert_with_two_keys_and_partition_in_the_key(spark, database):
    name = f"{database}.t"
    create_or_append(spark, spark.createDataFrame([(1, 1, "a"), (1, 1, "b")], DDL), name, ["v"])
    source = spark.createDataFrame([(1, 2, "a"), (1, 2, "c")], DDL)
    upsert(spark, name, align_for(spark, source, name), ["k", "v"], "ts")
    assert rows(spark.table(name), "k", "ts", "v") == [(1, 1, "b"), (1, 2, "a"), (1, 2, "c")]
