"""Op 13: spelling variants against all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st

from sedimenta.llm import op13_spellings as op
from sedimenta.llm.text import slices
from .cases import clashing, frame, odd_rows

_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(0x41, 0x5B)})


def plain_counts(rows):
    n = Counter()
    for doc_id, text in rows:
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = word.translate(_LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 199 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            n[word] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def edit(a, b):
    """Whether one insertion, deletion or replacement turns a into b."""
    letters = set(a + b)
    return b in {a[:k] + a[k + 1 :] for k in range(len(a))} | {a[:k] + x + a[k:] for k in range(len(a) + 1) for x in letters} \
        | {a[:k] + x + a[k + 1 :] for k in range(len(a)) for x in letters} and a != b


def plain(rows):
    n = plain_counts(rows)
    near = {a: [b for b in n if abs(len(a) - len(b)) <= 1 and edit(a, b)] for a in n}
    form = {}
    for a, others in near.items():
        best = min(others, key=lambda b: (-n[b], b), default=None)
        if best is not None and n[best] >= 5 * n[a]:
            form[a] = best
    out = []
    for a in n:
        root = a
        while root in form:
            root = form[root]
        out.append((a, form.get(a), root, n[a], len(near[a]), n[form[a]] if a in form else None))
    return sorted(out, key=repr)


def found(docs):
    return sorted((tuple(r) for r in op.group_spellings(docs).select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)


def variants(seed=5):
    """Words with variants of variants, in Latin-1 letters as well, spread over documents."""
    rng = random.Random(seed)
    words = []
    for base, n in (("separate", 700), ("seperate", 120), ("seperat", 20), ("separately", 300), ("definitely", 400), ("definately", 70),
                    ("définir", 90), ("definir", 12), ("naïveté", 60), ("naïvete", 9), ("abcdef", 30), ("abdcef", 6),
                    ("abcdefg", 6), ("×÷×÷×÷", 7), ("×÷×÷××", 35)):
        words += [base if rng.random() < 0.7 else base.upper() if base.isascii() else base for _ in range(n)]
    rng.shuffle(words)
    return [(k, " ".join(words[at : at + 37]) + ". x-y") for k, at in enumerate(range(0, len(words), 37))]


def test_variants_and_roots(spark):
    rows = variants()
    expected = plain(rows)
    assert any(r[1] is not None and r[1] != r[2] for r in expected)  # a form of a form
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == expected


def test_odd_rows(spark):
    """Nulls in any column, empty and very long texts, ties and repeated rows, clashing names."""
    rows = odd_rows() * 3 + [(None, "nobody nobody nobody nobodi nobody nobody " * 9, None, None, None)]
    docs = clashing(frame(spark, rows), "word", "n", "cell", "block", "pair")
    assert found(docs) == plain([(r[0], r[1]) for r in rows])


def test_empty_table(spark):
    assert found(frame(spark, [])) == []


def test_cells_in_many_blocks(spark):
    """A cell larger than a block meets all its blocks, and its words those of other cells."""
    rng = random.Random(2)
    words = sorted({"".join(rng.choices("abc", k=rng.choice([6, 7]))) for _ in range(500)})
    pairs = op.near_words(spark.createDataFrame([(w,) for w in words], "word string"), groups=2, block=16)
    got = sorted(tuple(sorted(p)) for p in pairs.collect())
    assert got == sorted((a, b) for a in words for b in words if a < b and abs(len(a) - len(b)) <= 1 and edit(a, b))


@given(st.text("abcé", max_size=7), st.text("abcé", max_size=7))
def test_one_edit(a, b):
    assert op.one_edit(a, b) == edit(a, b)


@given(st.lists(st.text("aZÀÿĀ .€", max_size=12), max_size=6))
def test_runs(texts):
    column = pa.array(texts, pa.string())
    got = []
    for part in slices(column):
        starts, ends, owner = op.letter_runs(part)
        got += [(part.lo + int(o), bytes(part.buf[s:e]).decode()) for s, e, o in zip(starts, ends, owner)]
    assert got == [(k, w) for k, t in enumerate(texts) for w in re.findall("[A-Za-zÀ-ÿ]+", t)]


def test_crc32_carries_on():
    words = [b"a", b"word", b"x" * 64, b"y" * 65, b"z" * 900]
    buf = np.frombuffer(b" ".join(words), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    begun = np.array([zlib.crc32(f"{k}:".encode()) for k in range(len(words))], np.uint32)
    got = op.span_crc32(buf, ends - [len(w) for w in words], ends, begun)
    assert got.tolist() == [zlib.crc32(f"{k}:".encode() + w) for k, w in enumerate(words)]
