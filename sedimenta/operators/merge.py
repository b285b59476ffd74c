"""De-duplication and timestamp-guarded upsert as DataFrame compositions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions.naming import quote
from sedimenta.operators.align import any_null
from sedimenta.scratch import stage

_UNORDERED = (T.MapType, T.VariantType)


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    return not isinstance(dtype, _UNORDERED)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: str | None = None) -> DataFrame:
    """One row per key, the newest by ``order_by``; ties fall to the other columns.

    A ``row_number() = 1`` filter makes Spark keep one row per key and task before the
    shuffle, so a key that holds a third of the rows moves one row per task. Null keys
    count as equal.
    """
    rest = [f.name for f in df.schema.fields
            if f.name not in (*keys, order_by) and _orderable(f.dataType)]
    order = [F.col(quote(order_by)).desc_nulls_last()] if order_by else []
    order += [F.col(quote(c)).desc_nulls_last() for c in rest]
    window = Window.partitionBy(*[F.col(quote(k)) for k in keys]).orderBy(*(order or [F.lit(1)]))
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def low_watermark(df: DataFrame, column: str) -> DataFrame:
    """the smallest value of a column, as one row."""
    return df.agg(F.min(quote(column)).alias(column))


MATCHED = "__matched"
_APART = "__apart"


def look_once(target: DataFrame, source: DataFrame, keys: Sequence[str], order_by: str | None = None,
              floor: Column | None = None) -> DataFrame:
    """The target's rows after the upsert, each with whether its key is in the source (``__matched``). One scan of it.

    The target is on the side of the join that adaptive execution can split, so a key it repeats does not pile up, and
    the batch on the side Spark broadcasts when its size allows: a small batch never shuffles the target. Target rows
    that cannot match (a null key, or below ``floor`` for E2) have numbers of their own as a further key, which spreads
    them over all tasks.
    """
    can_match = ~any_null([F.col(quote(k)) for k in keys])
    if floor is not None:
        can_match = can_match & F.coalesce(floor, F.lit(False))
    apart = F.when(can_match, 0).otherwise(1 + F.pmod(F.monotonically_increasing_id(), F.lit(1 << 20))).cast("int")
    t = target.withColumn(_APART, apart).alias("t")
    # No constant, or the optimizer would take it out of the keys that rows are dealt by.
    with_key = F.when(any_null([F.col(quote(k)) for k in keys]), -1).otherwise(0).cast("int")
    s = source.withColumns({MATCHED: F.lit(True), _APART: with_key}).alias("s")
    on = [F.col(f"t.{quote(k)}") == F.col(f"s.{quote(k)}") for k in [*keys, _APART]]
    matched = F.coalesce(F.col(f"s.{MATCHED}"), F.lit(False))
    take = matched
    if order_by:
        newer = F.col(f"s.{quote(order_by)}") >= F.col(f"t.{quote(order_by)}")
        take = matched & F.coalesce(newer, F.lit(False))
    return t.join(s, on, "left").select(
        *[F.when(take, F.col(f"s.{quote(c)}")).otherwise(F.col(f"t.{quote(c)}")).alias(c) for c in target.columns],
        matched.alias(MATCHED))


def not_matched(looked: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The source's rows that no target row had the key of, those with a null key among them. ``looked`` is a written
    :func:`look_once`; keys are distinct within its tasks before they are shuffled.

    The source's rows are told by their own keys: an update brings these with it.
    """
    known = looked.where(MATCHED).select(*[F.col(quote(k)) for k in keys]).distinct()
    return source.join(known, list(keys), "left_anti").select(*source.columns)


def merge_frames(target: DataFrame, source: DataFrame, keys: Sequence[str],
                 order_by: str | None = None, floor: Column | None = None) -> DataFrame:
    """The target after the upsert. ``source`` has the target's columns and unique keys.

    Matched rows take the source when its timestamp is not older (always, without a
    timestamp); a null on either side keeps the target. Source rows without a match, and
    those with a null key, are inserted. The target is read once; its rows are written to the shared folder, where the
    rows to insert are found.
    """
    looked = stage(look_once(target, source, keys, order_by, floor), "looked")
    return looked.drop(MATCHED).unionByName(not_matched(looked, source, keys).select(*target.columns))


def merge_pruned(target: DataFrame, source: DataFrame, keys: Sequence[str],
                 order_by: str | None, column: str) -> DataFrame:
    """Only target rows at or above the batch's smallest ``column`` may match.

    Opt-in, as it changes results: a match below the minimum is inserted a second time. An
    empty or all-null batch prunes nothing.
    """
    lowest = low_watermark(source, column).first()[0]
    floor = None if lowest is None else F.col(quote(column)) >= F.lit(lowest)
    return merge_frames(target, source, keys, order_by, floor)
