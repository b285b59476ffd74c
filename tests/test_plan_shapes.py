"""What the physical plans must and must not contain."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from sedimenta.operators import nested as N
from sedimenta.operators.merge import latest_per_key, look_once, merge_frames
from sedimenta.operators.profile import field_profile
from sedimenta.sources.tables import on_date
from workload.shapes import document_lines, nested_orders, table

SF = "/root/testdata/sf0.001"
IN_PLACE = ["field_profile", "key_scan", "align_nested", "main_projection", "merge_upsert", "dedupe_latest",
            "array_child_lines", "canonical_keys", "date_slice", "lookup_by_id", "map_prune_by_value"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", IN_PLACE)
def test_no_python_worker_and_no_cross_join(spark, name):
    text = plan(entry_points.queries()[name](spark, SF))
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


def test_date_slice_reaches_the_scan(spark):
    text = plan(on_date(table(spark, SF, "events"), "ts", "2024-01-15").select("event_id"))
    pushed = text.split("PushedFilters:")[1].split("]")[0]
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed
    assert "struct<event_id:bigint,ts:timestamp_ntz>" in text


def test_dedupe_limits_before_the_shuffle(spark):
    text = plan(latest_per_key(table(spark, SF, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate"))
    before_exchange = text[text.index("Exchange"):]
    assert "WindowGroupLimit" in before_exchange and "Partial" in before_exchange


def test_array_child_reads_two_columns_and_shuffles_nothing(spark):
    docs = document_lines(spark, SF)
    text = plan(N.explode_array(docs, N.plan_normalisation(docs, "d").arrays[0], "doc_id"))
    assert "Exchange" not in text and "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_main_projection_shuffles_nothing(spark):
    orders = nested_orders(spark, SF)
    assert "Exchange" not in plan(N.main_projection(orders, N.plan_normalisation(orders, "o")))


def test_child_reads_only_its_slot(spark):
    orders = nested_orders(spark, SF)
    nested = N.plan_normalisation(orders, "o").maps[0]
    elements = N.stage_map_elements(orders, nested, "OrderId")
    child = N.map_children(elements, nested)[0]
    text = plan(N.map_child(elements, nested, child, "OrderId"))
    assert f"PartitionFilters: [isnotnull(_slot" in text and f"= {child.slot})" in text


def test_large_merge_splits_skew_on_the_target_side(spark):
    """Without a broadcast the join is sort-merge with the splittable side left, and the target is scanned once."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        orders = table(spark, SF, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderdate").alias("ts"))
        batch = table(spark, SF, "customer").select(F.col("c_custkey").alias("k"), F.lit(None).cast("timestamp_ntz").alias("ts"))
        text = plan(look_once(orders, batch, ["k"], "ts"))
        assert "SortMergeJoin" in text and "LeftOuter" in text and "FullOuter" not in text
        assert text.count("orders.parquet") == 1
        merged = plan(merge_frames(orders, batch, ["k"], "ts"))
        assert "orders.parquet" not in merged and "LeftAnti" in merged  # of what the look has written
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_small_batch_never_shuffles_the_target(spark):
    orders = table(spark, SF, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderdate").alias("ts"))
    batch = table(spark, SF, "region").select(F.col("r_regionkey").cast("bigint").alias("k"),
                                              F.lit(None).cast("timestamp_ntz").alias("ts"))
    text = plan(look_once(orders, batch, ["k"], "ts"))
    assert any("LeftOuter, BuildRight" in line for line in text.splitlines() if "BroadcastHashJoin" in line)
    assert "Exchange hashpartitioning" not in text


def test_rows_without_a_key_do_not_meet_in_one_task(spark):
    """Null keys, and rows below the floor, are dealt by numbers of their own; a repeated key is split at run time."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": -1, "spark.sql.shuffle.partitions": 16,
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": 4096, "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": 2048, "spark.sql.adaptive.coalescePartitions.enabled": False}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        hot = spark.range(20000).select(F.when(F.col("id") % 2 == 0, 7).cast("long").alias("k"), F.col("id").alias("v")).repartition(8)
        batch = spark.createDataFrame([(7, -1), (8, -2)], "k long, v long")
        looked = look_once(hot, batch, ["k"]).select("*", F.spark_partition_id().alias("task"))
        per_task = Counter((r["k"] is None, r["task"]) for r in looked.collect())
        assert max(n for (no_key, _), n in per_task.items() if no_key) < 2000
        assert max(n for (no_key, _), n in per_task.items() if not no_key) < 5000
        assert "__apart" in next(line for line in plan(looked).splitlines() if "Exchange hashpartitioning" in line)
    finally:
        for name in settings:
            spark.conf.unset(name)
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_profile_combines_before_the_shuffle(spark):
    docs = table(spark, SF, "events").select(F.col("props").alias("json"))
    text = plan(field_profile(docs, "json"))
    assert "partial_count" in text and "ReadSchema: struct<props:string>" in text


def test_layout_reads_the_documents_once(spark):
    """One pass writes the histogram; the layout scans that twice, once for the number of documents."""
    from sedimenta.plans.suggest import path_histogram, suggest_tables

    df = spark.range(50).selectExpr("""'{"a": 1, "o": {"l": [{"x": 1}], "id": 2}, "i": [{"y": 3}]}' AS json""")
    histogram = plan(path_histogram(df, "json"))
    assert histogram.count("Range (") == 1 and "Python" not in histogram and histogram.count("Exchange") == 1
    layout = plan(suggest_tables(df, "json"))
    assert layout.count("FileScan") <= 3 and "Join" not in layout
