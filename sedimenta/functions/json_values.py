"""Column expressions and type translation for JSON held as text or variant."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions.numbers import DOUBLE_DIGITS
from sedimenta.functions.schema import ddl_type

_OBJECT_ARRAY = r"^\s*\[\s*\{"
_QUOTED = re.compile(r"(`(?:[^`]|``)*`)")


def looks_like_array(text: Column) -> Column:
    """Text whose first visible character opens a JSON array."""
    return F.trim(text).startswith("[")


def looks_like_object_array(text: Column) -> Column:
    """Text that opens an array whose first element is an object."""
    return text.rlike(_OBJECT_ARRAY)


def first_key(mapping: Column, *keys: str) -> Column:
    """Value of the first of several keys that is present."""
    return F.coalesce(*[mapping.getItem(k) for k in keys])


def array_elements(text: Column) -> Column:
    """The elements of a JSON array as variants; null when the text is no JSON array."""
    return F.try_variant_get(F.try_parse_json(text), "$", "array<variant>")


def is_object(element: Column) -> Column:
    """Is this variant a JSON object?"""
    return F.schema_of_variant(element).startswith("OBJECT")


def only_objects(text: Column) -> Column:
    """Does a JSON array hold nothing but objects (and nulls), with some field? Never null.

    One look at the merged element type: anything else beside an object makes it a variant.
    """
    merged = F.schema_of_variant(F.try_parse_json(text))
    # One use of the type: inside map_filter nothing is shared, and a second one would parse the text again.
    return F.coalesce(merged.rlike("^ARRAY<OBJECT<[^>]"), F.lit(False))


def first_is_object(text: Column) -> Column:
    """Does a JSON array start with an object? Never null; other texts are not parsed."""
    first = F.try_variant_get(F.try_parse_json(text), "$[0]", "variant")
    return F.coalesce(F.when(looks_like_object_array(text), is_object(first)), F.lit(False))


def value_label(element: Column, schema: Column | None = None) -> Column:
    """The profiler's label for one variant value; ``schema`` is its schema text, if at hand.

    A decimal without fraction digits is an integer only when it is too wide for a bigint;
    a narrower one was written with a fraction, as ``1.0``.
    """
    text = F.schema_of_variant(element) if schema is None else schema
    wide_integer = text.rlike(r"^DECIMAL\((19|[23]\d),0\)$")
    return (
        F.when(element.isNull() | (text == "VOID"), "null")
        .when(text == "BOOLEAN", "boolean")
        .when((text == "BIGINT") | wide_integer, "integer")
        .when(text.startswith("DECIMAL") | text.isin("DOUBLE", "FLOAT"), "float")
        .when(text.startswith("ARRAY"), "array")
        .when(text.startswith("OBJECT"), "object")
        .otherwise("string")
    )


def key_kind(element: Column, schema: Column | None = None) -> Column:
    """The key scan's label: arrays by their first element, scalars by type name."""
    label = value_label(element, schema)
    first = F.try_variant_get(element, "$[0]", "variant")
    return (
        F.when(label != "array", label)
        .when(first.isNull(), "array_empty")
        .when(is_object(first), "array_of_objects")
        .otherwise("array_of_scalars")
    )


def field_value(element: Column, name: str, dtype: T.DataType) -> Column:
    """One typed field of a variant object, whatever characters its name holds."""
    target = ddl_type(dtype)
    if "'" not in name and "\\" not in name:
        return F.try_variant_get(element, f"$['{name}']", target)
    if '"' not in name and "\\" not in name:
        return F.try_variant_get(element, f'$["{name}"]', target)
    entry = F.try_variant_get(element, "$", "map<string,variant>").getItem(name)
    return F.try_variant_get(entry, "$", target)


def _decimal(match: re.Match) -> str:
    precision, scale = int(match.group(1)), int(match.group(2))
    # Wide integers stay exact, and so do fractions with more digits than a double gives back.
    return f"DECIMAL({precision},{scale})" if precision > (DOUBLE_DIGITS if scale else 18) else "DOUBLE"


def variant_type(text: str) -> T.DataType:
    """Translate the text of an aggregated variant schema to a Spark type.

    Conflicts (``VARIANT``), nulls only (``VOID``) and empty objects become strings.
    """
    parts = _QUOTED.split(text)
    for i in range(0, len(parts), 2):
        part = parts[i].replace("OBJECT<>", "STRING").replace("OBJECT<", "STRUCT<")
        part = re.sub(r"\b(?:VOID|VARIANT)\b(?!:)", "STRING", part)
        parts[i] = re.sub(r"\bDECIMAL\((\d+),(\d+)\)", _decimal, part)
    return T.DataType.fromDDL("".join(parts))
