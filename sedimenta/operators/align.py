"""Alignment of frames to table schemas, always by name."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions.naming import clean_name, quote
from sedimenta.functions.schema import nullable

_NESTED = (T.StructType, T.ArrayType, T.MapType)

# Every text that is a whole number matches: one run of digits, no letter.
_MAY_BE_WHOLE = r"^[^0-9A-Za-z]*[0-9]+[^0-9A-Za-z]*$"


def typed_null(dtype: T.DataType) -> Column:
    """Null of a given type."""
    return F.lit(None).cast(dtype)


def cast_or_null(col: Column, src: T.DataType, dst: T.DataType) -> Column:
    """A value of the other type, null where it does not fit.

    A text that is no number costs ``try_cast`` an exception, so what cannot be a whole number never gets there.
    """
    if isinstance(src, T.StringType) and isinstance(dst, T.IntegralType):
        return F.when(col.rlike(_MAY_BE_WHOLE), col.try_cast(dst))
    return col.try_cast(dst)


def _with_value(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` over a value that is worked out once, also where lambdas within ask for it for every element."""
    return F.transform(F.array(value), use)[0]


def field_of(column: Column, struct: T.StructType, name: str) -> Column:
    """One struct field, also where another one is named the same up to case.

    Such fields are told apart by position: a cast renames a struct's fields in order.
    """
    names = struct.fieldNames()
    if sum(n.lower() == name.lower() for n in names) == 1:
        return column.getField(name)
    by_position = T.StructType([T.StructField(f"_{i}", f.dataType) for i, f in enumerate(struct.fields)])
    return column.cast(by_position).getField(f"_{names.index(name)}")


def _match(name: str, fields: list[T.StructField]) -> T.StructField | None:
    """The field with this name: same spelling first, then case and odd characters aside."""
    exact = next((f for f in fields if f.name == name), None)
    if exact is not None:
        return exact
    wanted = clean_name(name).lower()
    return next((f for f in fields if clean_name(f.name).lower() == wanted), None)


def _from_map(col: Column, value: T.DataType, dst: T.StructType) -> Column:
    fields = [align_column(col.getItem(f.name), value, f.dataType).alias(f.name) for f in dst.fields]
    return F.when(col.isNotNull(), F.struct(*fields))


def _field_entries(col: Column, src: T.StructType, dst: T.MapType, value) -> Column:
    """A struct's fields as (key, value) entries; a name that is no key of the map's type has a null key."""
    return F.array(*[F.struct(F.lit(f.name).try_cast(dst.keyType).alias("key"), value(field_of(col, src, f.name), f.dataType).alias("value"))
                     for f in src.fields])


def _with_kept(entries: Column, use: Callable[[Column, Callable[[Column, Column], Column]], Column]) -> Column:
    """``use`` over entries and whether one, at its place, goes into the map: those without a key do not, and of one key
    only the first does."""

    def first_of_its_key(found: Column, keys: Column) -> Column:
        return use(found, lambda e, i: e.getField("key").isNotNull() & (F.array_position(keys, e.getField("key")) == i + 1))

    return _with_value(entries, lambda found: _with_value(
        F.transform(found, lambda e: e.getField("key")), lambda keys: first_of_its_key(found, keys)))


def _map_of(entries: Column) -> Column:
    return _with_kept(entries, lambda found, kept: F.map_from_entries(F.filter(found, kept)))


def _to_map(col: Column, src: T.StructType, dst: T.MapType) -> Column:
    if not src.fields:
        return F.when(col.isNotNull(), F.create_map().cast(dst))
    entries = _field_entries(col, src, dst, lambda c, t: align_column(c, t, dst.valueType))
    filled = F.filter(entries, lambda e: e.getField("value").isNotNull())
    return F.when(col.isNotNull(), _map_of(filled).cast(dst))


def _recast_keys(col: Column, src: T.MapType, dst: T.MapType, value) -> Column:
    """A map's entries with keys of the other type, null where they do not fit."""
    return F.transform(F.map_entries(col), lambda e: F.struct(
        cast_or_null(e.getField("key"), src.keyType, dst.keyType).alias("key"), value(e.getField("value")).alias("value")))


def align_column(col: Column, src: T.DataType, dst: T.DataType) -> Column:
    """Bring one value to ``dst``: nested fields meet by name, null parents stay null."""
    if nullable(src) == nullable(dst):
        return col
    if isinstance(dst, T.StringType) and isinstance(src, _NESTED):
        return F.to_json(col)
    if isinstance(src, T.StringType) and isinstance(dst, _NESTED):
        return F.from_json(col, dst)
    if isinstance(src, T.StructType) and isinstance(dst, T.StructType):
        fields = []
        for field in dst.fields:
            found = _match(field.name, src.fields)
            value = (align_column(field_of(col, src, found.name), found.dataType, field.dataType)
                     if found else typed_null(field.dataType))
            fields.append(value.alias(field.name))
        return F.when(col.isNotNull(), F.struct(*fields))
    if isinstance(src, T.ArrayType) and isinstance(dst, T.ArrayType):
        return F.transform(col, lambda e: align_column(e, src.elementType, dst.elementType))
    if isinstance(src, T.MapType) and isinstance(dst, T.MapType):
        if nullable(src.keyType) != nullable(dst.keyType):
            entries = _recast_keys(col, src, dst, lambda v: align_column(v, src.valueType, dst.valueType))
            return _map_of(entries)
        return F.transform_values(col, lambda _, v: align_column(v, src.valueType, dst.valueType))
    if isinstance(src, T.MapType) and isinstance(dst, T.StructType):
        return _from_map(col, src.valueType, dst)
    if isinstance(src, T.StructType) and isinstance(dst, T.MapType):
        return _to_map(col, src, dst)
    # A value that does not fit becomes null instead of ending the job.
    return cast_or_null(col, src, dst)


def align_to(df: DataFrame, table: T.StructType) -> DataFrame:
    """The table's columns in the table's order; extra columns are left out."""
    columns = []
    for field in table.fields:
        found = _match(field.name, df.schema.fields)
        value = (align_column(F.col(quote(found.name)), found.dataType, field.dataType)
                 if found else typed_null(field.dataType))
        columns.append(value.alias(field.name))
    return df.select(*columns)


def _sum(counts: list[Column]) -> Column | None:
    return reduce(lambda a, b: a + b, counts) if counts else None


def _over(array: Column, count) -> Column:
    """The sum of ``count`` over an array's elements, 0 for a null array."""
    return F.coalesce(F.aggregate(F.transform(array, count), F.lit(0), lambda a, b: a + b), F.lit(0))


def _is_lost(before: Column, after: Column) -> Column:
    return (before.isNotNull() & after.isNull()).cast("int")


def _lost_entries(entries: Column) -> Column:
    """Over (key, values lost within) entries: one for each that does not go into the map, else what is lost within."""
    each = _with_kept(entries, lambda found, kept: F.transform(
        found, lambda e, i: F.when(kept(e, i), e.getField("value")).otherwise(1)))
    return F.coalesce(F.aggregate(each, F.lit(0), lambda a, b: a + b), F.lit(0))


def _lost_in_text(text: Column, parsed: Column, dst: T.DataType) -> Column:
    """How many values of a JSON text its parsed form lacks; fields that ``dst`` does not have count as one each."""
    whole = _is_lost(text, parsed)
    if isinstance(dst, T.StructType):
        texts = F.from_json(text, T.MapType(T.StringType(), T.StringType()))
        names = [f.name for f in dst.fields]
        extra = F.map_filter(texts, lambda k, v: ~k.isin(names) & v.isNotNull())
        counts = [_lost_in_text(texts.getItem(f.name), parsed.getField(f.name), f.dataType) for f in dst.fields]
        inside = _sum([F.when(extra.isNotNull(), F.size(extra)).otherwise(0), *counts])
        return F.when(parsed.isNull() | (text.isNotNull() & texts.isNull()), text.isNotNull().cast("int")).otherwise(inside)
    if isinstance(dst, T.ArrayType):
        both = F.arrays_zip(F.from_json(text, T.ArrayType(T.StringType())).alias("t"), parsed.alias("p"))
        return F.when(parsed.isNull(), whole).otherwise(_over(
            both, lambda e: _lost_in_text(e.getField("t"), e.getField("p"), dst.elementType)))
    if isinstance(dst, T.MapType):
        both = F.arrays_zip(F.map_values(F.from_json(text, T.MapType(dst.keyType, T.StringType()))).alias("t"),
                            F.map_values(parsed).alias("p"))
        return F.when(parsed.isNull(), whole).otherwise(_over(
            both, lambda e: _lost_in_text(e.getField("t"), e.getField("p"), dst.valueType)))
    return whole


def lost_values(col: Column, src: T.DataType, dst: T.DataType) -> Column | None:
    """How many values :func:`align_column` loses in one value, at any level; None where it cannot lose any.

    Lost is what is not null before and null after, each nested field with a value that ``dst`` does not have, and each
    entry of a map whose key does not fit the other key type or, once it does, is there already.
    """
    if nullable(src) == nullable(dst) or isinstance(dst, T.StringType) and isinstance(src, _NESTED):
        return None
    if isinstance(src, T.StringType) and isinstance(dst, _NESTED):
        return _lost_in_text(col, F.from_json(col, dst), dst)
    if isinstance(src, T.StructType) and isinstance(dst, T.StructType):
        counts, met = [], set()
        for field in dst.fields:
            found = _match(field.name, src.fields)
            if found is not None:
                met.add(found.name)
                counts.append(lost_values(field_of(col, src, found.name), found.dataType, field.dataType))
        counts += [field_of(col, src, f.name).isNotNull().cast("int") for f in src.fields if f.name not in met]
        return _sum([c for c in counts if c is not None])
    if isinstance(src, T.ArrayType) and isinstance(dst, T.ArrayType):
        if lost_values(F.lit(None), src.elementType, dst.elementType) is None:
            return None
        return _over(col, lambda e: lost_values(e, src.elementType, dst.elementType))
    if isinstance(src, T.MapType) and isinstance(dst, T.MapType):
        inside = lost_values(F.lit(None), src.valueType, dst.valueType)
        if nullable(src.keyType) != nullable(dst.keyType):
            entries = _recast_keys(col, src, dst, lambda v: F.lit(0) if inside is None else F.coalesce(
                lost_values(v, src.valueType, dst.valueType), F.lit(0)))
            return _lost_entries(entries)
        if inside is None:
            return None
        return _over(F.map_values(col), lambda v: lost_values(v, src.valueType, dst.valueType))
    if isinstance(src, T.MapType) and isinstance(dst, T.StructType):
        names = [f.name for f in dst.fields]
        extra = F.map_filter(col, lambda k, v: ~k.isin(names) & v.isNotNull())
        counts = [lost_values(col.getItem(f.name), src.valueType, f.dataType) for f in dst.fields]
        return _sum([F.when(extra.isNotNull(), F.size(extra)).otherwise(0), *(c for c in counts if c is not None)])
    if isinstance(src, T.StructType) and isinstance(dst, T.MapType):
        if not src.fields:
            return None

        def within(value: Column, dtype: T.DataType) -> Column:
            # A field that has no value, or loses it, gives no entry and takes no key from another one.
            count = lost_values(value, dtype, dst.valueType)
            return F.when(align_column(value, dtype, dst.valueType).isNotNull(), F.lit(0) if count is None else F.coalesce(count, F.lit(0)))

        entries = F.filter(_field_entries(col, src, dst, within), lambda e: e.getField("value").isNotNull())
        fields = [(field_of(col, src, f.name), f.dataType) for f in src.fields]
        whole = _sum([_is_lost(c, align_column(c, t, dst.valueType)) for c, t in fields])
        return F.when(col.isNotNull(), _lost_entries(entries) + whole).otherwise(0)
    return _is_lost(col, cast_or_null(col, src, dst))


def losses(df: DataFrame, table: T.StructType) -> dict[str, Column]:
    """Per table column that is cast: the count of values that would become null or be left out, at any level."""
    counts = {}
    for field in table.fields:
        found = _match(field.name, df.schema.fields)
        if found is None or nullable(found.dataType) == nullable(field.dataType):
            continue
        lost = lost_values(F.col(quote(found.name)), found.dataType, field.dataType)
        if lost is not None:
            counts[field.name] = F.coalesce(F.sum(lost), F.lit(0).cast("bigint"))
    return counts


def lost_in_alignment(df: DataFrame, table: T.StructType) -> DataFrame:
    """One row: per table column, how many values would not survive :func:`align_to`."""
    counts = losses(df, table)
    return df.agg(*[counts.get(f.name, F.lit(0).cast("bigint")).alias(f.name) for f in table.fields])


def align_by_union(df: DataFrame, table: DataFrame) -> DataFrame:
    """Union with the table's empty shape; types widen, missing columns become null."""
    return df.unionByName(table.limit(0), allowMissingColumns=True)


def serialise_changed(df: DataFrame, before: T.StructType, after: T.StructType) -> DataFrame:
    """Columns that turned into strings are serialised, root names take the new spelling."""
    held = {f.name: f.dataType for f in df.schema.fields}
    new_by_old = {b.name: a for b, a in zip(before.fields, after.fields)}
    columns = []
    for name, dtype in held.items():
        target = new_by_old.get(name)
        value = F.col(quote(name))
        if target is None:
            columns.append(value)
            continue
        if isinstance(target.dataType, T.StringType) and isinstance(dtype, _NESTED):
            value = F.to_json(value)
        columns.append(value.alias(target.name))
    return df.select(*columns)


def any_null(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, [c.isNull() for c in columns])
