from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sedimenta.llm import op2_repeated_bytes
from sedimenta.llm.bwt_repeats import covered_windows
from sedimenta.llm.op2_repeated_bytes import remove_repeats

from .cases import clashing, frame, odd_rows, prose


def plain(rows, length=100):
    """(doc_id, text) in order -> bytes kept, by looking up every window."""
    seen, out = set(), []
    for doc_id, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - length + 1):
            window = raw[k : k + length]
            if window in seen:
                gone[k : k + length] = True
            seen.add(window)
        edges = np.flatnonzero(np.diff(gone, prepend=False, append=False))
        out.append((doc_id, len(raw), int(gone.sum()), len(edges) // 2, np.frombuffer(raw, np.uint8)[~gone].tobytes()))
    return out


@given(st.lists(st.binary(max_size=60).map(lambda b: bytes(x % 3 + 97 for x in b)), min_size=1, max_size=6),
       st.integers(1, 20), st.randoms())
@settings(max_examples=150, deadline=None)
def test_expansion_finds_repeated_windows(pieces, length, random):
    order = list(range(len(pieces)))
    random.shuffle(order)
    seen, want = set(), [None] * len(pieces)
    for k in sorted(range(len(pieces)), key=order.__getitem__):
        mine = []
        for i in range(len(pieces[k]) - length + 1):
            window = pieces[k][i : i + length]
            mine.append(window in seen)
            seen.add(window)
        want[k] = mine
    got = covered_windows(pieces, np.array(order), length)
    assert [g.tolist() for g in got] == want


@pytest.mark.parametrize("hot", [4096, 0])
def test_odd_rows_equal_the_plain_version(spark, monkeypatch, hot):
    monkeypatch.setattr(op2_repeated_bytes, "HOT_PIECES", hot)
    rows = odd_rows()
    found = remove_repeats(clashing(frame(spark, rows), "kept", "doc", "start", "runs", "version"))
    got = sorted({(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found.collect()})
    assert found.count() == len(rows)
    # A document given twice is one document.
    assert got == sorted(plain(list(dict.fromkeys((r[0], r[1]) for r in rows))))


def test_null_id_comes_first_and_spans_fit(spark):
    text = prose(7)[:130]
    found = {r.doc_id: r for r in remove_repeats(frame(
        spark, [(5, "x" + text, "en", "s", 1), (None, text, "en", "s", 1)])).collect()}
    assert found[None].n_removed == 0 and found[5].n_removed == 130
    assert [(s.start, s.stop) for s in found[5].spans] == [(1, 131)]


def test_empty_table(spark):
    assert remove_repeats(frame(spark, [])).count() == 0
