"""A relational layout suggested from JSON documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.functions.json_values import is_object, value_label
from sedimenta.functions.naming import quote
from sedimenta.operators.profile import SPARSE_BELOW, dominant_type, filled_records, percent
from sedimenta.scratch import stage


def _fields_of(variant: Column) -> Column:
    """The entries (key, value) of a variant object; none for other values."""
    entries = F.map_entries(F.try_variant_get(variant, "$", "map<string,variant>"))
    return F.coalesce(entries, F.array().cast("array<struct<key:string,value:variant>>"))


def _objects_in(variant: Column) -> Column:
    """The objects among the elements of a variant array; none for other values."""
    elements = F.filter(F.try_variant_get(variant, "$", "array<variant>"), is_object)
    return F.coalesce(elements, F.array().cast("array<variant>"))


def _node(place: str, key=None, field=None, sub=None, value=None, hit=None) -> Column:
    none = F.lit(None)
    return F.struct(
        F.lit(place).alias("place"), (none if key is None else key).cast("string").alias("key"),
        (none if field is None else field).cast("string").alias("field"), (none if sub is None else sub).cast("string").alias("sub"),
        (F.lit("") if value is None else value_label(value)).alias("type"),
        (F.lit(False) if hit is None else F.coalesce(hit, F.lit(False))).alias("hit"))


def _walk(root: Column) -> Column:
    """Every node of a document that a layout depends on: where it is, its label, and whether it holds objects.

    ``document``: the document itself; ``root``: its fields; ``object``: the fields of root objects; ``items``, ``item``:
    the objects in root arrays and their fields; ``subitems``, ``subitem``: those of arrays in root objects.
    """
    def in_array(place: str, array: Column, **at) -> Column:
        named = (lambda e: {"sub": e["key"]}) if "field" in at else (lambda e: {"field": e["key"]})
        return F.flatten(F.transform(_objects_in(array), lambda x: F.concat(
            F.array(_node(place + "s", **at)),
            F.transform(_fields_of(x), lambda e: _node(place, value=e["value"], **at, **named(e))))))

    def in_object(key: Column, e: Column) -> Column:
        first = F.coalesce(is_object(F.try_variant_get(e["value"], "$[0]", "variant")), F.lit(False))
        below = F.when(first, in_array("subitem", e["value"], key=key, field=e["key"]))
        return F.concat(F.array(_node("object", key, e["key"], value=e["value"], hit=first)),
                        F.coalesce(below, F.filter(F.array(_node("")), lambda _: F.lit(False))))

    def in_root(e: Column) -> Column:
        hit = F.size(_objects_in(e["value"])) > 0
        return F.concat(
            F.array(_node("root", e["key"], value=e["value"], hit=hit)), in_array("item", e["value"], key=e["key"]),
            F.flatten(F.transform(_fields_of(e["value"]), lambda f: in_object(e["key"], f))))

    return F.concat(F.array(_node("document")), F.flatten(F.transform(_fields_of(root), in_root)))


def path_histogram(df: DataFrame, json: str) -> DataFrame:
    """place, key, field, sub, type, records, hits: every document walked once, and only counts leave its task."""
    walked = df.select(F.explode(_walk(F.try_parse_json(quote(json)))).alias("n")).select("n.*")
    return walked.groupBy("place", "key", "field", "sub", "type").agg(
        F.count(F.lit(1)).alias("records"), F.count_if("hit").alias("hits"))


def _profile(counted: DataFrame) -> DataFrame:
    """One row for each field of each place, and one for each group of elements, with what its layout depends on.

    Everything about a root field and what is below it is brought together by windows over its key; all rows there are one
    per path and count, never one per document.
    """
    in_object = F.col("place").isin("object", "subitem", "subitems")
    at = counted.withColumns({
        "folded": F.when(in_object, F.lower("field")),
        "column": F.when(F.col("place") == "root", F.col("key")).when(F.col("place") == "subitem", F.col("sub"))
        .when(F.col("place").isin("object", "item"), F.col("field"))})
    fields = at.groupBy("place", "key", "folded", "column").agg(
        dominant_type().alias("kind"), filled_records().alias("filled"), F.sum("records").alias("seen"), F.sum("hits").alias("hits"),
        F.sum(F.when(F.col("type") == "object", F.col("records"))).alias("objects"))
    below, together = Window.partitionBy("key"), Window.partitionBy("key", "folded")

    def over(window: Window, place: str, value: str) -> Column:
        return F.max(F.when(F.col("place") == place, F.col(value))).over(window)

    found = fields.withColumns({
        "root_kind": over(below, "root", "kind"), "root_hits": over(below, "root", "hits"),
        "root_objects": over(below, "root", "objects"), "root_items": over(below, "items", "seen"),
        "group_items": over(together, "subitems", "seen"), "group_hits": over(together, "object", "hits")})
    is_id = (F.col("place") == "object") & (F.lower("column") == "id")
    fill = F.struct("filled", percent(F.col("filled"), F.col("root_objects")).alias("pct"))
    return found.withColumn("id_pct", F.max(F.when(is_id, fill)).over(below).getField("pct")).withColumn(
        "child", (F.col("root_kind") == "array") & (F.col("root_hits") > 0))


def _laid_out(profile: DataFrame, root: str, fk: str, documents: Column) -> DataFrame:
    """The columns that each row of the profile stands for, with their tables."""
    key, name, kind = F.lower("key"), F.col("column"), F.col("kind")
    root_table = F.concat(F.lit(f"{root}_"), key)
    sub_table = F.concat(root_table, F.lit("_"), F.col("folded"))

    def column(table: Column, column: Column, dtype: Column, pct: Column, is_fk: bool = False) -> Column:
        return F.struct(table.alias("table"), column.alias("column"), dtype.alias("type"), pct.alias("filled_pct"), F.lit(is_fk).alias("is_fk"))

    def keyed(table: Column, name: Column, pct: Column) -> Column:
        return column(table, name, F.lit("string"), pct, True)

    flat = F.when(kind == "array", "array<string>").when((kind == "object") & (F.col("place") == "object"), "object(json)").otherwise(kind)
    place, in_object, whole = F.col("place"), F.col("root_kind") == "object", F.lit(100.0)
    becomes = (
        F.when((place == "root") & ~F.col("child") & ~in_object, F.array(column(F.lit(root), name, flat, percent(F.col("filled"), documents))))
        .when((place == "items") & F.col("child"), F.array(keyed(root_table, F.lit(fk), whole)))
        .when((place == "item") & F.col("child"), F.array(column(root_table, name, kind, percent(F.col("filled"), F.col("root_items")))))
        .when((place == "object") & in_object & ~((kind == "array") & (F.col("group_hits") > 0)), F.array(column(
            F.lit(root), F.concat(key, F.lit("_"), name), flat, percent(F.col("filled"), F.col("root_objects")))))
        .when((place == "subitems") & in_object, F.filter(F.array(
            keyed(sub_table, F.lit(fk), whole), keyed(sub_table, F.concat(key, F.lit("_id")), F.col("id_pct"))),
            lambda c: c["filled_pct"].isNotNull()))
        .when((place == "subitem") & in_object, F.array(column(sub_table, name, kind, percent(F.col("filled"), F.col("group_items"))))))
    return profile.select(F.inline(becomes))


def suggest_tables(df: DataFrame, json: str, root: str = "alerts", fk: str = "alert_id") -> DataFrame:
    """(table, column, type, filled_pct, is_fk, is_sparse) for JSON text documents.

    Scalars and scalar arrays of the root, and the fields of its objects under an
    ``<object>_`` prefix, go to the main table; object arrays, of the root or of an object,
    become child tables with a foreign key and, where the object has one, its id. All
    records are counted, none is sampled. The documents are read once, into a histogram of
    paths; the layout is made of that alone.
    """
    counted = stage(path_histogram(df, json), "path-histogram")
    documents = counted.where("place = 'document'").agg(F.coalesce(F.sum("records"), F.lit(0))).scalar()
    rows = _laid_out(_profile(counted), root, fk, documents)
    # C18 within each table; the rows are columns of the suggestion, a few per table.
    same = Window.partitionBy("table", F.lower("column"))
    marked = F.when((F.count(F.lit(1)).over(same) > 1) & (F.col("column") != F.lower("column"))
                    & (F.col("table") != root), F.concat("column", F.lit("_")))
    return rows.withColumn("column", F.coalesce(marked, F.col("column"))).withColumn(
        "is_sparse", F.col("filled_pct") < SPARSE_BELOW).select("table", "column", "type", "filled_pct", "is_fk", "is_sparse")
