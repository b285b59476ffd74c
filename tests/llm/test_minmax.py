"""Op 12: min-max hashing against exact similarities of all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from sedimenta.llm import op12_minmax as op
from sedimenta.llm.text import slices, span_digests
from .cases import clashing, frame, odd_rows, prose

_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(0x41, 0x5B)})


def plain(rows, share=85):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOWER))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()})
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for k in range(i):
            common = len(sets[i] & sets[k])
            if sets[i] and sets[k] and 100 * common >= share * (len(sets[i]) + len(sets[k]) - common):
                old, new = group[i], group[k]
                group = [new if g == old else g for g in group]
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[k][0] for k in range(len(rows)) if group[k] == group[i] and rows[k][0] is not None]
        first = min(ids) if ids and sets[i] else doc_id
        out.append((doc_id, len(sets[i]), first, doc_id == first))
    return sorted(out, key=repr)


def found(docs):
    return sorted((tuple(r) for r in op.near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


def test_odd_rows(spark):
    """Nulls in any column, empty, short and very long texts, ties, repeated rows, clashing names."""
    rows = odd_rows() + [(None, prose(1), None, None, None), (None, None, None, None, None)]
    docs = clashing(frame(spark, rows), "row", "id", "n", "version", "digest", "key", "component")
    assert found(docs) == plain([(r[0], r[1]) for r in rows])


def test_empty_table(spark):
    assert found(frame(spark, [])) == []


def test_chains_stars_and_near_misses(spark):
    """Groups whose members link to some others only, and sets right at the threshold."""
    rng = random.Random(7)
    rows, doc = [], 0
    for seed in range(6):
        words = prose(seed + 100, 150).split()
        for _ in range(12):  # a chain: each text changes one more word
            rows.append((doc, " ".join(words)))
            doc += 1
            words[rng.randrange(len(words))] = f"new{doc}"
    base = prose(200, 160).split()
    for _ in range(40):  # a star: each text differs from the others in twice as much as from the middle
        other = list(base)
        for at in rng.sample(range(5, 155, 6), 2):
            other[at] = f"own{doc}"
        rows.append((doc, " ".join(other)))
        doc += 1
    rows.append((doc, " ".join(base)))
    for n in (5, 6, 9, 10, 16, 17):  # a word more at the end
        short = prose(300 + n, n).split()
        rows += [(doc + 1, " ".join(short)), (doc + 2, " ".join([*short, "more"]))]
        doc += 2
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(docs) == plain(rows)


def test_words_of_doubling_patterns_differ(spark):
    """Words that sums of powers of one base modulo 2^64 cannot tell apart."""
    one, two = "a", "b"
    for _ in range(11):
        one, two = one + two, two + one
    assert found(spark.createDataFrame([(1, one), (2, two)], "doc_id long, text string")) == [(1, 1, 1, True), (2, 1, 2, True)]


@pytest.mark.parametrize("share", [0.5, 0.85])
def test_both_ends_estimate_similarity(share):
    """The mean over both ends is unbiased, with less variance than minima of as many permutations would have."""
    rng = np.random.default_rng(3)
    n = 400
    common = int(round(2 * n * share / (1 + share)))
    likeness = []
    for _ in range(150):
        items = rng.integers(0, 1 << 64, 2 * n - common, dtype=np.uint64)
        both = np.concatenate([items[:n], items[n - common :]])
        ends = op.minmax(both, np.array([n, n]))
        likeness.append((ends[:, :, 0] == ends[:, :, 1]).mean())
    true = common / (2 * n - common)
    values = 2 * len(op._KEYS)
    assert abs(np.mean(likeness) - true) < 4 * np.sqrt(true * (1 - true) / values / len(likeness))
    assert np.var(likeness) < 1.3 * true * (1 - true) / values


def test_span_digests_are_of_the_bytes():
    texts = ["a", "ab", "abcdefgh", "abcdefghi", "x" * 300, "x" * 301, "abcdefgh", ""]
    part = next(slices(pa.array([" ".join(texts)])))
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    found_ = span_digests(part.buf, ends - [len(t) for t in texts], ends).tolist()
    assert found_[2] == found_[6] and len(set(found_)) == len(texts) - 1
