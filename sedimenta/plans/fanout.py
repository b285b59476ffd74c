"""All children of a map written by one partitioned write, whatever their number."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions.naming import quote
from sedimenta.functions.schema import nullable
from sedimenta.operators.align import _match, align_column, lost_values, typed_null
from sedimenta.sinks.tables import observe_losses

CHILD = "_child"
_NUMBER = "_number"

#: Columns of one write; more children than fit into so many are written by a further one.
MOST_COLUMNS = 2000


@dataclass(frozen=True)
class ChildRows:
    """One child among the rows of a common frame: its key there, its table, its columns over the frame, and the schema
    its table has."""

    key: str
    table: str
    columns: Sequence[tuple[T.StructField, Column]]
    stored: T.StructType

    def aligned(self) -> list[tuple[T.StructField, tuple, Column, Column | None]]:
        """Per stored column what its value is made of, the value over the common frame, and how many values that loses
        (None: it cannot). Equal makings give equal values."""
        fields = [f for f, _ in self.columns]
        value_of = {f.name: c for f, c in self.columns}
        out = []
        for field in self.stored.fields:
            kind = field.dataType.json()
            found = _match(field.name, fields)
            if found is None:
                out.append((field, (None, None, kind), typed_null(field.dataType), None))
                continue
            value = value_of[found.name]
            out.append((field, (found.metadata.get("source", found.name), found.dataType.json(), kind),
                        align_column(value, found.dataType, field.dataType),
                        lost_values(value, found.dataType, field.dataType)))
        return out


def layers(children: Sequence[ChildRows], most_columns: int = MOST_COLUMNS) -> list[list[ChildRows]]:
    """The children in groups that one schema holds: columns of one name have one type and spelling.

    A file has a single schema, so children that disagree about a column are written apart. How many groups there are
    depends on the types a name has, not on the number of children.
    """
    found: list[tuple[dict[str, tuple[str, T.DataType]], list[ChildRows]]] = []
    for child in children:
        mine = {f.name.lower(): (f.name, nullable(f.dataType)) for f in child.stored.fields}
        for held, members in found:
            if all(held.get(k, v) == v for k, v in mine.items()) and len(held.keys() | mine.keys()) <= most_columns:
                held.update(mine)
                members.append(child)
                break
        else:
            found.append((dict(mine), [child]))
    return [members for _, members in found]


def wide_rows(rows: DataFrame, key: str, children: Sequence[ChildRows]) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """The children's rows under one schema with the table's name as ``_child``, and how many values their types lose,
    to be asked once the rows have been written.

    Each child fills its own columns; the others are null in its rows and no part of its table. Rows of other keys are
    left out. The keys, a row for each table, are broadcast: dealt by key, all rows of one would meet in a task.
    """
    names = rows.sparkSession.createDataFrame(
        [(c.key, c.table, i) for i, c in enumerate(children)], f"_of string, {CHILD} string, {_NUMBER} int")
    numbered = rows.join(F.broadcast(names), F.col(quote(key)) == F.col("_of")).drop("_of")
    values: dict[str, dict[tuple, tuple[Column, list[int]]]] = {}
    lost: dict[str, Column] = {}
    for number, child in enumerate(children):
        for field, made_of, value, losing in child.aligned():
            values.setdefault(field.name, {}).setdefault(made_of, (value, []))[1].append(number)
            if losing is not None:
                mine = F.when(F.col(_NUMBER) == number, losing)
                lost[f"{child.table}.{field.name}"] = F.coalesce(F.sum(mine), F.lit(0).cast("bigint"))
    watched, result = observe_losses(numbered, "map children", lost)
    columns = []
    for name, choices in values.items():
        column = None
        for value, numbers in choices.values():
            mine = F.col(_NUMBER).isin(numbers)
            column = F.when(mine, value) if column is None else column.when(mine, value)
        columns.append(column.alias(name))
    return watched.select(CHILD, *columns), result
