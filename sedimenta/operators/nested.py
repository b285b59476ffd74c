"""Nested normalisation: arrays of structs and JSON-valued maps become child tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions.json_values import (
    array_elements, field_value, first_key, is_object, looks_like_object_array, only_objects,
    variant_type,
)
from sedimenta.functions.naming import (
    clean_name, clean_names, quote, resolve_case_conflicts, root_id_column, unique_names,
)
from sedimenta.functions.numbers import NumberShape, number_shape
from sedimenta.operators.align import field_of
from sedimenta.scratch import stage

Path = tuple[str, ...]

# Folders the staged map elements are spread over, by hash of the key: keys may be long or
# empty, folder names must not be.
_SLOTS = 1024

# Tasks one key is spread over at least, before adaptive execution looks at sizes.
_SALTS = 16


@dataclass(frozen=True)
class NestedField:
    """A field that becomes a table of its own.

    ``steps`` holds one path per explode: a single path for an array below structs only,
    more where the array sits inside the elements of another one.
    """

    steps: tuple[Path, ...]
    table: str
    kind: str  # "array", "map_text" or "map_array"
    dtype: T.DataType

    @property
    def path(self) -> Path:
        return self.steps[0]


@dataclass(frozen=True)
class MapChild:
    """One object-array key of a map: its table and the type of its elements."""

    key: str
    slot: int
    table: str
    element: T.StructType
    elements: int


@dataclass(frozen=True)
class NormalisationPlan:
    """Everything known before the first row is written."""

    main_table: str
    root_id: str
    arrays: list[NestedField] = field(default_factory=list)
    maps: list[NestedField] = field(default_factory=list)

    @property
    def nested(self) -> list[NestedField]:
        return self.arrays + self.maps


def _struct_element(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType)


def _map_kind(dtype: T.MapType) -> str | None:
    if isinstance(dtype.valueType, T.StringType):
        return "map_text"
    return "map_array" if _struct_element(dtype.valueType) else None


def nested_fields(main_table: str, schema: T.StructType, max_depth: int = 1) -> list[NestedField]:
    """G1: arrays of structs and maps, found through structs of any depth.

    With ``max_depth`` above 1 the arrays inside the elements of a child are found too.
    """
    found: list[tuple[tuple[Path, ...], str, T.DataType]] = []

    def walk(struct: T.StructType, outer: tuple[Path, ...], prefix: Path) -> None:
        for f in struct.fields:
            here = prefix + (f.name,)
            steps = outer + (here,)
            if _struct_element(f.dataType):
                found.append((steps, "array", f.dataType))
                if len(steps) < max_depth:
                    walk(f.dataType.elementType, steps, ())
            elif isinstance(f.dataType, T.MapType):
                kind = _map_kind(f.dataType)
                if kind and not outer:
                    found.append((steps, kind, f.dataType))
            elif isinstance(f.dataType, T.StructType):
                walk(f.dataType, outer, here)

    walk(schema, (), ())
    names = unique_names(
        "_".join([main_table, *(clean_name(part.lower()) for path in steps for part in path)])
        for steps, _, _ in found
    )
    return [NestedField(steps, name, kind, dtype)
            for (steps, kind, dtype), name in zip(found, names)]


def plan_normalisation(df: DataFrame, main_table: str, root_id: str | None = None,
                       max_depth: int = 1) -> NormalisationPlan:
    """G10 without a job: the schema alone says what is nested."""
    fields = nested_fields(main_table, df.schema, max_depth)
    return NormalisationPlan(
        main_table, root_id_column(df.columns, root_id),
        [f for f in fields if f.kind == "array"], [f for f in fields if f.kind != "array"],
    )


def at_path(base: Column | None, path: Path, struct: T.StructType) -> Column:
    """Field access by name parts, none of which is parsed for dots."""
    column = F.col(quote(path[0])) if base is None else field_of(base, struct, path[0])
    for part, name in zip(path, path[1:]):
        struct = struct[part].dataType
        column = field_of(column, struct, name)
    return column


def _fields(element: Column, struct: T.StructType) -> list[Column]:
    """Every field of a struct under a positional name."""
    return [field_of(element, struct, n).alias(f"_{i}") for i, n in enumerate(struct.fieldNames())]


def with_names(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename by position, so that names equal up to case never meet."""
    return df.toDF(*names)


def fix_case_conflicts(df: DataFrame) -> DataFrame:
    """C17 applied to a frame's columns."""
    names = resolve_case_conflicts(df.columns)
    return df if names == df.columns else with_names(df, names)


def _parent_id(path: Path, struct: T.StructType) -> tuple[str, str] | None:
    """The id of the struct at ``path`` as (field, column name), if it has one."""
    parent = path[-1].lower()
    names = struct.fieldNames()
    chosen = next((n for n in ("id", "Id", f"{parent}_id") if n in names), None)
    return (chosen, f"{parent}_id_ref") if chosen else None


def _ids_along(base: Column | None, path: Path, struct: T.StructType) -> list[Column]:
    """Ids of every struct passed on the way to the last part of ``path``."""
    ids, current = [], struct
    for depth in range(1, len(path)):
        current = current[path[depth - 1]].dataType
        found = _parent_id(path[:depth], current)
        if found:
            ids.append(at_path(base, (*path[:depth], found[0]), struct).alias(found[1]))
    return ids


def explode_array(df: DataFrame, nested: NestedField, root_id: str) -> DataFrame:
    """One row per element with the root id, the ids on the way, and its fields.

    Only the id and the array are read; nothing is shuffled.
    """
    first = nested.steps[0]
    current = df.select(
        F.col(quote(root_id)).alias(root_id.lower()),
        *_ids_along(None, first, df.schema),
        F.explode(at_path(None, first, df.schema)).alias("_element"),
    ).where(F.col("_element").isNotNull())
    element = _type_at(df.schema, first).elementType
    for previous, path in zip(nested.steps, nested.steps[1:]):
        keys = current.columns[:-1]
        parent = _parent_id(previous, element)
        own = [field_of(F.col("_element"), element, parent[0]).alias(parent[1])] if parent else []
        current = current.toDF(*unique_names(keys), "_element").select(
            *[F.col(quote(k)) for k in unique_names(keys)], *own,
            *_ids_along(F.col("_element"), path, element),
            F.explode(at_path(F.col("_element"), path, element)).alias("_element"),
        ).where(F.col("_element").isNotNull())
        element = _type_at(element, path).elementType
    keys = unique_names(current.columns[:-1])
    current = current.toDF(*keys, "_element")
    names = resolve_case_conflicts(keys + clean_names(element.fieldNames()))
    return with_names(current.select(
        *[F.col(quote(k)) for k in keys], *_fields(F.col("_element"), element)), names)


def _type_at(struct: T.StructType, path: Path) -> T.DataType:
    dtype: T.DataType = struct
    for part in path:
        dtype = dtype[part].dataType
    return dtype


def map_entries(df: DataFrame, nested: NestedField, root_id: str) -> DataFrame:
    """(root id, map id, key, value) for every entry with a value."""
    mapping = at_path(None, nested.path, df.schema)
    map_id = f"{nested.path[-1].lower()}_id"
    text_values = isinstance(nested.dtype.valueType, T.StringType)
    return df.select(
        F.col(quote(root_id)).alias(root_id.lower()),
        *([first_key(mapping, "id", "Id").alias(map_id)] if text_values else []),
        F.explode(mapping).alias("_source_key", "_value"),
    ).where(F.col("_value").isNotNull())


def object_array_keys(df: DataFrame, nested: NestedField, root_id: str) -> DataFrame:
    """The distinct keys under which some row holds an array of objects."""
    return (
        map_entries(df, nested, root_id)
        .where(looks_like_object_array(F.col("_value")))
        .select(F.col("_source_key").alias("key"))
        .distinct()
    )


def _object_array_entries(df: DataFrame, nested: NestedField, root_id: str) -> DataFrame:
    """Entries that open an array of objects, with their folded key and its slot."""
    folded = F.lower("_source_key")
    return (
        map_entries(df, nested, root_id)
        .where(looks_like_object_array(F.col("_value")))
        .withColumns({"_key": folded, "_slot": F.pmod(F.xxhash64(folded), F.lit(_SLOTS)).cast("int")})
    )


def _explode_objects(entries: DataFrame, nested: NestedField, root_id: str) -> DataFrame:
    return entries.select(
        *[F.col(quote(c)) for c in _key_columns(nested, root_id)], "_source_key", "_key",
        F.explode(array_elements(F.col("_value"))).alias("_element"), "_slot",
    ).where(is_object(F.col("_element")))


def map_elements(df: DataFrame, nested: NestedField, root_id: str) -> DataFrame:
    """The objects in all object arrays of a text map, one variant per row.

    ``_key`` is the lower-case key: all spellings of a key feed one child. Entries that are
    no arrays of objects give nothing here; they stay in the main table's map.
    """
    return _explode_objects(_object_array_entries(df, nested, root_id), nested, root_id)


def _key_columns(nested: NestedField, root_id: str) -> list[str]:
    return [root_id.lower(), f"{nested.path[-1].lower()}_id"]


def stage_map_elements(df: DataFrame, nested: NestedField, root_id: str) -> DataFrame:
    """One pass over the source for all children: elements laid out by key slot.

    The texts are spread before they are parsed. A salt splits each key over several tasks,
    and adaptive execution splits what is still large and packs what is small, so a key with
    a third of all texts is neither one task nor one file.
    """
    entries = _object_array_entries(df, nested, root_id)
    salt = F.pmod(F.xxhash64(quote(root_id.lower()), "_value"), F.lit(_SALTS)).cast("int")
    spread = entries.withColumn("_salt", salt).hint("rebalance", "_slot", "_salt")
    return stage(_explode_objects(spread, nested, root_id), "map-elements", partition_by=["_slot"])


def map_children(elements: DataFrame, nested: NestedField) -> list[MapChild]:
    """One job infers the element type of every key, over all values; where fields hold fractions, a second one
    finds the least type that keeps their numbers exact.

    Partial aggregation keeps a hot key harmless. The result is the list of tables to write.
    """
    element = F.col("_element")
    rows = (
        elements.groupBy("_key", "_slot")
        .agg(F.schema_of_variant_agg(element).alias("type"), F.count(F.lit(1)).alias("elements"))
        .collect()
    )
    children = []
    for row in sorted(rows, key=lambda r: r["_key"]):
        dtype = variant_type(row["type"])
        if isinstance(dtype, T.StructType) and dtype.fields:
            children.append((row["_key"], row["_slot"], dtype, row["elements"]))
    children = _exact_numbers(elements, children)
    names = unique_names(f"{nested.table}_{clean_name(key)}" for key, *_ in children)
    return [MapChild(key, slot, name, dtype, n)
            for (key, slot, dtype, n), name in zip(children, names)]


def _exact_numbers(elements: DataFrame, children: list[tuple]) -> list[tuple]:
    """The children, (key, slot, type, elements), their fractional fields as wide as all their values need."""
    fractional = {key: [f.name for f in dtype.fields if isinstance(f.dataType, (T.DecimalType, T.DoubleType))]
                  for key, _, dtype, _ in children}
    keys = [key for key, names in fractional.items() if names]
    if not keys:
        return children
    view = elements.where(F.col("_key").isin(keys)).select("_key", "_element")
    values = view.lateralJoin(view.sparkSession.tvf.variant_explode(F.col("_element").outer()).select("key", "value"))
    typed = values.select("_key", "key", "value", F.schema_of_variant("value").alias("_schema"))
    found = typed.groupBy("_key", "key").agg(
        *[c.alias(n) for n, c in number_shape(F.col("value"), F.col("_schema")).items()]).where("fraction").collect()
    shapes = {(r["_key"], r["key"]): NumberShape(r["whole"], r["scale"], r["fraction"], r["huge"]) for r in found}

    def exact(key: str, f: T.StructField) -> T.StructField:
        shape = shapes.get((key, f.name))
        return T.StructField(f.name, shape.dtype) if shape and f.name in fractional[key] else f

    return [(key, slot, T.StructType([exact(key, f) for f in dtype.fields]), n) for key, slot, dtype, n in children]


def map_child_fields(elements: DataFrame, nested: NestedField, child: MapChild,
                     root_id: str) -> list[tuple[T.StructField, Column]]:
    """The columns of one key's child over the elements, each field cast and named on its own.

    Works for names with any characters and for ``Id`` beside ``id``.
    """
    keys = [*_key_columns(nested, root_id), "_source_key"]
    names = resolve_case_conflicts(keys + clean_names(child.element.fieldNames()))
    columns = [(T.StructField(name, elements.schema[k].dataType), F.col(quote(k))) for name, k in zip(names, keys)]
    return columns + [
        (T.StructField(name, f.dataType, True, {"source": f.name}), field_value(F.col("_element"), f.name, f.dataType))
        for name, f in zip(names[len(keys):], child.element.fields)]


def map_child(elements: DataFrame, nested: NestedField, child: MapChild, root_id: str) -> DataFrame:
    """One key's objects as a frame."""
    fields = map_child_fields(elements, nested, child, root_id)
    mine = elements.where((F.col("_slot") == child.slot) & (F.col("_key") == child.key))
    return with_names(mine.select(*[c.alias(f"_{i}") for i, (_, c) in enumerate(fields)]), [f.name for f, _ in fields])


def keep_without_elements(mapping: Column) -> Column:
    """The entries of a map of arrays that give no child row: null arrays, and arrays of nothing but nulls."""
    return F.map_filter(mapping, lambda _, v: ~F.coalesce(F.exists(v, lambda x: x.isNotNull()), F.lit(False)))


def map_array_child(df: DataFrame, nested: NestedField, root_id: str) -> DataFrame:
    """The child of a map whose values are arrays of structs already: one table, all keys."""
    keys = [root_id.lower(), "_source_key"]
    exploded = map_entries(df, nested, root_id).select(
        *[F.col(quote(k)) for k in keys], F.explode("_value").alias("_element"),
    ).where(F.col("_element").isNotNull())
    element = nested.dtype.valueType.elementType
    names = resolve_case_conflicts(keys + clean_names(element.fieldNames()))
    return with_names(exploded.select(
        *[F.col(quote(k)) for k in keys], *_fields(F.col("_element"), element)), names)


def map_rejects(df: DataFrame, nested: NestedField, root_id: str) -> DataFrame:
    """Per key: object-array values that stay in the map, as no child holds them in full.

    They are unparseable, have other elements beside objects, or objects without fields.
    """
    return (
        map_entries(df, nested, root_id)
        .where(looks_like_object_array(F.col("_value")) & ~only_objects(F.col("_value")))
        .groupBy(F.lower("_source_key").alias("key"))
        .agg(F.count(F.lit(1)).alias("rejected_values"))
    )


def prune_map(mapping: Column) -> Column:
    """Drop the entries whose whole content went to a child, keep all others.

    Decided by the value, not by the key's name: a key that is an array in one record and a
    scalar in the next keeps the scalar.
    """
    return F.map_filter(mapping, lambda _, v: F.when(
        F.coalesce(looks_like_object_array(v), F.lit(False)), ~only_objects(v)).otherwise(True))


def _drop_in_struct(column: Column, struct: T.StructType, prefix: Path,
                    gone: set[Path], pruned: dict[Path, Callable[[Column], Column]]) -> Column | None:
    """A struct without its extracted fields; None when no field is left. Null stays null."""
    drop, replace = [], []
    for f in struct.fields:
        here = prefix + (f.name,)
        if here in gone:
            drop.append(f.name)
        elif here in pruned:
            replace.append((f.name, pruned[here](column.getField(f.name))))
        elif isinstance(f.dataType, T.StructType) and any(
                p[:len(here)] == here for p in gone | pruned.keys()):
            inner = _drop_in_struct(column.getField(f.name), f.dataType, here, gone, pruned)
            if inner is None:
                drop.append(f.name)
            else:
                replace.append((f.name, inner))
    if len(drop) == len(struct.fields):
        return None
    for name, value in replace:
        column = column.withField(quote(name), value)
    return column.dropFields(*[quote(n) for n in drop]) if drop else column


def main_projection(df: DataFrame, plan: NormalisationPlan) -> DataFrame:
    """The root rows without what the children hold. One projection, no shuffle."""
    gone = {n.path for n in plan.arrays if len(n.steps) == 1}
    pruned = {n.path: prune_map if n.kind == "map_text" else keep_without_elements for n in plan.maps}
    columns = []
    for f in df.schema.fields:
        here = (f.name,)
        column: Column | None = F.col(quote(f.name))
        if here in gone:
            continue
        if here in pruned:
            column = pruned[here](column)
        elif isinstance(f.dataType, T.StructType):
            column = _drop_in_struct(column, f.dataType, here, gone, pruned)
        if column is not None:
            columns.append(column.alias(f.name))
    return df.select(*columns)
