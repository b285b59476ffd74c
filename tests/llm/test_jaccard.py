from __future__ import annotations

import random
import re

import numpy as np
import pytest

from sedimenta.llm import op5_jaccard_join as op5
from sedimenta.llm.op5_jaccard_join import (
    band, components, components_with_links, links, odd_sketch, segment_sums, segments,
)

from .cases import clashing, frame, odd_rows, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain(rows):
    sets = []
    for _, text in rows:
        words = WORD.findall((text or "").translate(LOWER))
        sets.append({tuple(words)} if 0 < len(words) < 5 else {tuple(words[i : i + 5]) for i in range(len(words) - 4)})
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                parent[find(i)] = find(j)
    smallest = {}
    for i, (doc_id, _) in enumerate(rows):
        smallest[find(i)] = min(smallest.get(find(i), doc_id), doc_id)
    return sorted((rows[i][0], len(sets[i]), smallest[find(i)]) for i in range(len(rows)))


def near_copies(seed: int) -> list[tuple]:
    """Chains and clusters around the limit, of many sizes, with shared passages."""
    rng = random.Random(seed)
    shared = prose(99, 40)
    rows = []
    for size in (5, 6, 7, 8, 9, 11, 14, 20, 35, 36, 70, 130, 300):
        words = prose(size, size).split()
        for copy in range(9):
            mine = list(words)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3]) * max(1, size // 90)):
                where = rng.randrange(len(mine))
                kind = rng.randrange(3)
                mine[where : where + (kind < 2)] = [f"n{rng.randrange(10**6)}"] * (kind != 1)
            if size > 100 and copy % 3 == 0:
                mine += shared.split()
            rows.append((len(rows) * 3 + 1, " ".join(mine), "en", "s", 1))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_near_copies_equal_the_plain_version(spark, seed):
    rows = near_copies(seed)
    got = sorted(map(tuple, components(frame(spark, rows)).collect()))
    assert got == plain([r[:2] for r in rows])


def test_odd_rows(spark):
    rows = odd_rows()
    found = components(clashing(frame(spark, rows), "id", "n", "key", "component_id"))
    assert sorted(map(tuple, found.collect())) == plain([r[:2] for r in rows])


def test_empty_table(spark):
    assert components(frame(spark, [])).count() == 0


def test_null_id_joins_a_component_but_does_not_name_it(spark):
    text = prose(5)
    found = components(frame(spark, [(None, text, "en", "s", 1), (8, text, "en", "s", 1), (None, "alone here", "en", "s", 1)]))
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        [(None, 116, 8), (8, 116, 8), (None, 1, None)], key=str)


def test_similar_sets_share_a_segment():
    rng = np.random.default_rng(3)
    for n in (6, 9, 40, 200, 700):
        items = rng.integers(1, 1 << 62, n, dtype=np.uint64)
        differ = (2 * n) // 9
        other = np.concatenate([items[differ // 2 :], rng.integers(1, 1 << 62, differ - differ // 2, dtype=np.uint64)])
        b = band(len(other))
        if band(n) != b:
            continue
        _, one = segment_sums(items, b)
        _, two = segment_sums(other, b)
        changed = len(np.setxor1d(items, other))
        assert (one == two).sum() >= segments(b) - changed
        bits = int.from_bytes((odd_sketch(items, b) ^ odd_sketch(other, b)).tobytes(), "little").bit_count()
        assert bits <= changed


def test_sets_of_a_slice_get_the_keys_they_get_one_by_one():
    rng = np.random.default_rng(4)
    sizes = np.array([0, 1, 4, 9, 31, 0, 40, 300, 5, 0])
    sets = [np.sort(rng.integers(1, 1 << 62, n, dtype=np.uint64)) for n in sizes]
    flat, bands = np.concatenate(sets), np.array([band(int(n)) if n else 0 for n in sizes])
    wanted = (sizes >= 4) & (sizes != 9)
    keys = op5._segment_keys(flat, sizes, bands, wanted).to_pylist()
    for items, b, some, found, name in zip(sets, bands.tolist(), wanted, keys, op5._set_ids(flat, sizes).tolist()):
        assert name == (op5.set_id(items) if len(items) else 0)
        _, sums = segment_sums(items, b)
        assert found == (op5._key(sums, np.arange(len(sums)), b, 0).tolist() if some else None)


def test_segments_are_laid_out_once(spark, monkeypatch):
    staged, plans = op5.stage_lean, {}

    def noted(df, label, *more):
        plans.setdefault(label, df._jdf.queryExecution().executedPlan().toString())
        return staged(df, label, *more)

    monkeypatch.setattr(op5, "stage_lean", noted)
    components(frame(spark, near_copies(5)))
    assert [label for label, plan in plans.items() if "Generate posexplode" in plan] == ["shared-segments"]
    assert "Join" not in plans["shared-segments"]


def plain_links(rows):
    sets = []
    for _, text in rows:
        words = WORD.findall((text or "").translate(LOWER))
        sets.append({tuple(words)} if 0 < len(words) < 5 else {tuple(words[i : i + 5]) for i in range(len(words) - 4)})
    return [sum(i != j and bool(x) and bool(y) and 100 * len(x & y) >= 80 * len(x | y) for j, y in enumerate(sets))
            for i, x in enumerate(sets)]


def test_links_within_components_equal_the_plain_version(spark):
    base = prose(7, 200).split()
    rows = [*near_copies(3), *odd_rows()]
    for k in range(30):  # near copies that all link to each other
        rows.append((1000 + k, " ".join([*base[: 5 * k], f"n{k}", *base[5 * k + 1 :]]), "en", "s", 1))
    got = sorted(map(tuple, components_with_links(frame(spark, rows)).collect()))
    assert [r[:3] for r in got] == plain([r[:2] for r in rows])
    assert sorted((r[0], r[3]) for r in got) == sorted(zip([r[0] for r in rows], plain_links([r[:2] for r in rows])))


def test_sets_without_an_id_link_to_others(spark):
    words = prose(5).split()
    words[60] = "changed"
    rows = [(None, prose(5), "en", "s", 1), (8, " ".join(words), "en", "s", 1)]
    assert {tuple(r) for r in components(frame(spark, rows)).collect()} == {(None, 116, 8), (8, 116, 8)}
    pairs, members = links(frame(spark, rows))
    assert pairs.count() == 1 and members.count() == 2


def large_group(m: int, seed: int = 8, words: int = 90) -> list[tuple]:
    """Copies of one text, each with up to five other words at places that many share, some of them twice."""
    rng = random.Random(seed)
    base = prose(seed, words).split()
    rows = []
    for k in range(m):
        mine = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 2, 3, 5])):
            mine[rng.randrange(words)] = rng.choice([f"n{rng.randrange(3)}", f"n{k}"])
        if k % 20 == 0:
            mine += [f"end{rng.randrange(4)}"] * rng.randrange(12)
        rows.append((seed * 10_000 + k, " ".join(mine), "en", "s", 1))
    return [*rows, *((r[0] + 5_000, *r[1:]) for r in rows[::7])]


def test_links_of_large_groups_equal_the_plain_version(spark, monkeypatch):
    monkeypatch.setattr(op5, "_BLOCK", 20)
    rows = [*large_group(200), *large_group(60, 9), *near_copies(4), *odd_rows()]
    got = sorted(map(tuple, components_with_links(frame(spark, rows)).collect()))
    assert [r[:3] for r in got] == plain([r[:2] for r in rows])
    assert sorted((r[0], r[3]) for r in got) == sorted(zip([r[0] for r in rows], plain_links([r[:2] for r in rows])))


def test_counting_links_lists_no_pairs_of_a_large_group(spark, monkeypatch):
    staged, most = op5.stage_lean, {}

    def counted(df, label, *more):
        out = staged(df, label, *more)
        most[label] = max(most.get(label, 0), out.count())
        return out

    monkeypatch.setattr(op5, "stage_lean", counted)
    for m in (150, 450):
        most.clear()
        rows = large_group(m)
        links = sum(r.n_links for r in components_with_links(frame(spark, rows)).collect())
        assert links > m * m / 8
        assert most["pairs"] < 8 * m, most
