"""Field and table names: sanitising, uniqueness, case conflicts, root id."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Sequence

_UNSAFE = re.compile(r"[^A-Za-z0-9_]")


def quote(name: str) -> str:
    """Back-quote one identifier part."""
    return "`" + name.replace("`", "``") + "`"


def quote_table(identifier: str) -> str:
    """Back-quote each part of a dotted table identifier that is not quoted yet."""
    if "`" in identifier:
        return identifier
    return ".".join(quote(part) for part in identifier.split("."))


def clean_name(name: str) -> str:
    """Every character outside ``[A-Za-z0-9_]`` becomes an underscore."""
    return _UNSAFE.sub("_", name)


def unique_names(names: Iterable[str]) -> list[str]:
    """Make names distinct regardless of case by appending underscores to later ones."""
    used: set[str] = set()
    out = []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def clean_names(names: Iterable[str]) -> list[str]:
    """Sanitised names; one that would meet another name gets more underscores."""
    raw = list(names)
    used = {n for n in raw if clean_name(n) == n}
    out = []
    for name in raw:
        cleaned = clean_name(name)
        if cleaned != name:
            while cleaned in used:
                cleaned += "_"
            used.add(cleaned)
        out.append(cleaned)
    return out


def resolve_case_conflicts(names: Sequence[str]) -> list[str]:
    """C17: names equal up to case; the upper-case one becomes ``lower + '_'``.

    One name of each group keeps its spelling: the first that does not start with an
    upper-case letter (the all-lower spelling before others), else the first. The rest
    become ``lower_``, with more underscores until nothing collides.
    """
    groups: dict[str, list[int]] = {}
    for position, name in enumerate(names):
        groups.setdefault(name.lower(), []).append(position)
    taken = set(groups)
    out = list(names)
    for lower, positions in groups.items():
        if len(positions) == 1:
            continue
        keeper = min(
            positions,
            key=lambda p: (names[p] != lower, names[p][:1].isupper(), p),
        )
        for position in positions:
            if position == keeper:
                continue
            renamed = lower + "_"
            while renamed in taken:
                renamed += "_"
            taken.add(renamed)
            out[position] = renamed
    return out


def mark_case_conflicts(names: Sequence[str]) -> list[str]:
    """C18, profiler spelling: in a conflict every name that is not all lower case gets ``_``."""
    seen = Counter(n.lower() for n in names)
    return [n + "_" if seen[n.lower()] > 1 and n != n.lower() else n for n in names]


def root_id_column(columns: Sequence[str], override: str | None = None) -> str:
    """The configured column, else the first ending in ``id``, else the first."""
    if override is not None:
        if override not in columns:
            raise ValueError(f"root id column {override!r} is not among {list(columns)}")
        return override
    return next((c for c in columns if c.lower().endswith("id")), columns[0])
