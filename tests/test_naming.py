from __future__ import annotations

import pytest
from hypothesis import given
from hypothesis import strategies as st

from sedimenta.functions.naming import (
    clean_names, mark_case_conflicts, quote_table, resolve_case_conflicts, root_id_column, unique_names,
)


@pytest.mark.parametrize("names, expected", [
    (["id", "Id"], ["id", "id_"]),
    (["Id", "id"], ["id_", "id"]),
    (["Id", "ID"], ["Id", "id_"]),
    (["iD", "id"], ["id_", "id"]),
    (["ID", "Id", "id"], ["id_", "id__", "id"]),
    (["id_", "Id", "id"], ["id_", "id__", "id"]),
    (["a", "B"], ["a", "B"]),
    (["k", "k"], ["k", "k_"]),
])
def test_case_conflicts(names, expected):
    assert resolve_case_conflicts(names) == expected


def test_profiler_marks_keep_case():
    assert mark_case_conflicts(["Id", "id", "ID", "Name"]) == ["Id_", "id", "ID_", "Name"]


@given(st.lists(st.text("aAbB_", min_size=1, max_size=3), max_size=12))
def test_names_end_up_distinct(names):
    for rename in (resolve_case_conflicts, unique_names):
        out = rename(names)
        assert len(out) == len(names) == len({n.lower() for n in out})


@given(st.lists(st.text("a-._", min_size=1, max_size=3), max_size=8, unique=True))
def test_clean_names_stay_distinct(names):
    out = clean_names(names)
    assert len(set(out)) == len(names)
    assert all(c.isalnum() or c == "_" for n in out for c in n)


def test_root_id():
    assert root_id_column(["title", "AlertId", "otherid"]) == "AlertId"
    assert root_id_column(["title", "x"]) == "title"
    assert root_id_column(["AlertId", "key"], "key") == "key"
    with pytest.raises(ValueError):
        root_id_column(["a"], "b")


def test_quote_table():
    assert quote_table("c.d.t-1") == "`c`.`d`.`t-1`"
    assert quote_table("`a.b`.t") == "`a.b`.t"
