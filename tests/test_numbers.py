from __future__ import annotations

from decimal import Decimal

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions.numbers import NumberShape, number_shape, number_type
from sedimenta.functions.schema import RewriteRules, rewrite_type
from sedimenta.operators import nested as N
from tests.conftest import rows

D, L, S = T.DoubleType(), T.LongType(), T.StringType()


def shape_of(spark, *texts):
    df = spark.createDataFrame([(t,) for t in texts], "j string").select(F.parse_json("j").alias("v"))
    r = df.withColumn("s", F.schema_of_variant("v")).agg(
        *[c.alias(n) for n, c in number_shape(F.col("v"), F.col("s")).items()]).first()
    return NumberShape(**r.asDict())


@pytest.mark.parametrize("texts, dtype", [
    (["1", "22"], L), (["1", "1.50"], D), (["1.0"], D), (["9007199254740993", "0.25"], T.DecimalType(18, 2)),
    (["9007199254740993", "1e-7", "0.5"], T.DecimalType(23, 7)), (["1", "1e300"], D), (["1e3", "-20.125"], D),
    (["123456789012345678901234567890"], T.DecimalType(30, 0)), (["123456789012345678901234567890", "0.1234567890"], D),
    (["0.1234567890123456"], T.DecimalType(16, 16)), (["-00"[1:2], "-0.5"], D), (['"x"', "true", "null"], L)])
def test_least_type(spark, texts, dtype):
    assert shape_of(spark, *texts).dtype == dtype


shapes = st.builds(NumberShape, st.integers(0, 40), st.integers(0, 20), st.booleans(), st.booleans())


@given(shapes, shapes, shapes)
def test_join_is_a_lattice(a, b, c):
    assert a.join(b) == b.join(a) and a.join(b).join(c) == a.join(b.join(c))
    assert a.join(a) == a.join(NumberShape()) == a


def test_map_values_of_several_number_types():
    mixed = T.StructType([T.StructField("2024-01-01", L), T.StructField("2024-01-02", D)])
    assert rewrite_type(mixed) == T.MapType(S, S, True)
    assert rewrite_type(mixed, RewriteRules(mixed_numbers=True)) == T.MapType(S, T.DecimalType(38, 18), True)
    assert number_type([L, S]) is None and number_type([L, T.DecimalType(10, 2)]) == T.DecimalType(21, 2)


def test_map_children_keep_numbers(spark):
    texts = ['[{"n": 9007199254740993, "m": 1, "d": 1.5, "x": {"y": 12345678901234567}}]', '[{"n": 0.125, "m": 2, "d": 2, "x": {"y": 0.5}}]',
             '[{"n": 2.5e-3, "m": 3, "d": 1e2}]']
    df = spark.createDataFrame([(i, {"k": t}) for i, t in enumerate(texts)], "id int, m map<string,string>")
    plan = N.plan_normalisation(df, "t")
    elements = N.stage_map_elements(df, plan.maps[0], "id")
    child, = N.map_children(elements, plan.maps[0])
    assert child.element.simpleString() == "struct<d:double,m:bigint,n:decimal(20,4),x:struct<y:decimal(18,1)>>"
    got = rows(N.map_child(elements, plan.maps[0], child, "id"), "id", "n", "d", "x.y")
    assert got == [(0, Decimal("9007199254740993.0000"), 1.5, Decimal("12345678901234567.0")),
                   (1, Decimal("0.1250"), 2.0, Decimal("0.5")), (2, Decimal("0.0025"), 100.0, None)]
