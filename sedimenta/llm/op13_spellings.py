"""Spelling variants: words one edit apart, found by Gram matrices of letter counts block by block.

Words of nearly one spelling have nearly the same letters: one inserted or deleted letter moves the vector of letter
counts by a squared distance of 1, a replaced one by 2. A block of words is one NumPy matrix X of such vectors, and
|x|^2 + |y|^2 - 2 X Y^T are the squared distances of all its words from those of another block. Pairs at most two apart
are kept and their edits verified.

Only blocks that can hold such pairs meet. The letters are dealt into ``GROUPS`` groups by their frequency; a word's cell
is the count of its letters in each group. One edit changes at most two of these counts by one, so a cell meets itself
and the cells one insertion or one replacement away. Cells are cut into blocks of some hundred words, and each pair of
blocks is a row group of its own, so no task holds more than two blocks however large a cell is.

Words are counted by slice in the tasks and again before the shuffle; everything else works on the table of words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .staging import discard, stage_lean
from .text import LOWER, SLICE_BYTES, Slice, slices, span_digests

LEAST_LETTERS = 6
LEAST_COUNT = 5
SHRINK = 199  # one run in so many loses a letter
FORM_FACTOR = 5
GROUPS = 6
_BLOCK = 512  # words
_LEAD = 0xC3  # the first byte of U+00C0 to U+00FF in UTF-8

# Fixed value: letters from frequent to rare; their ranks deal them to the groups.
_FREQUENT = "etaoinshrdlucmfwygpbvkxqjz"


def letter_runs(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of each maximal run of letters."""
    buf = part.buf
    if not len(buf):
        none = np.zeros(0, np.int64)
        return none, none, none
    low = LOWER[buf]
    inside = ((low >= 0x61) & (low <= 0x7A)) | (buf == _LEAD)
    inside[1:] |= buf[:-1] == _LEAD
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edge = part.offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(buf))]
    begins[edge] = inside[edge]
    ends[edge - 1] = inside[edge - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(part.offsets, starts, "right") - 1


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()


def span_crc32(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, begun: np.ndarray) -> np.ndarray:
    """The crc32 of each span, carried on from ``begun``; long spans by the library."""
    state = begun.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    size = ends - starts
    left = np.flatnonzero((size > 0) & (size <= 64))
    at = 0
    while len(left):
        state[left] = _CRC[(state[left] ^ buf[starts[left] + at]) & np.uint32(255)] ^ (state[left] >> np.uint32(8))
        at += 1
        left = left[size[left] > at]
    state ^= np.uint32(0xFFFFFFFF)
    for k in np.flatnonzero(size > 64).tolist():
        state[k] = zlib.crc32(buf[starts[k] : ends[k]].tobytes(), int(begun[k]))
    return state


def slice_words(part: Slice, doc_ids: list) -> tuple[pa.Array, np.ndarray]:
    """The distinct words of a slice with enough letters, and how often each occurs."""
    starts, ends, owner = letter_runs(part)
    low = LOWER[part.buf]
    letters = ends - starts
    marks = np.concatenate([[0], np.cumsum(part.buf == _LEAD)])
    letters = letters - (marks[ends] - marks[starts])
    # Shorter runs cannot become long enough.
    keep = letters >= LEAST_LETTERS
    starts, ends, owner, letters = starts[keep], ends[keep], owner[keep], letters[keep]
    named = np.array([zlib.crc32(f"{'' if d is None else d}:".encode()) for d in doc_ids], np.uint32)
    crc = span_crc32(low, starts, ends, named[owner] if len(owner) else np.zeros(0, np.uint32))
    cut = crc % SHRINK == 0
    changed = []
    for k in np.flatnonzero(cut & (letters > LEAST_LETTERS)).tolist():
        word = low[starts[k] : ends[k]].tobytes().decode()
        at = int(crc[k]) % len(word)
        changed.append(word[:at] + word[at + 1 :])
    starts, ends = starts[~cut], ends[~cut]
    _, first, count = np.unique(span_digests(low, starts, ends), return_index=True, return_counts=True)
    starts, ends = starts[first], ends[first]
    size = ends - starts
    into = np.concatenate([[0], np.cumsum(size)])
    data = low[np.repeat(starts - into[:-1], size) + np.arange(into[-1])] if len(size) else low[:0]
    words = pa.Array.from_buffers(pa.large_string(), len(size), [None, pa.py_buffer(into.astype(np.int64)), pa.py_buffer(data)])
    return (pa.concat_arrays([words, pa.array(changed, pa.large_string())]),
            np.concatenate([count, np.ones(len(changed), np.int64)]))


def count_words(docs: DataFrame) -> DataFrame:
    """word, n (occurrences in all texts, at least ``LEAST_COUNT``) of every word with ``LEAST_LETTERS`` letters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(1), 4 * SLICE_BYTES):
                words, n = slice_words(part, batch.column(0).slice(part.lo, part.n).to_pylist())
                yield pa.RecordBatch.from_arrays([words.cast(pa.string()), pa.array(n, pa.int64())], ["word", "n"])

    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInArrow(run, "word string, n long") \
        .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _letter_groups(groups: int) -> list[str]:
    """The letters of each group: the alphabet dealt by frequency, forth and back; accented letters by code point."""
    dealt = ["" for _ in range(groups)]
    for rank, letter in enumerate(_FREQUENT):
        turn, at = divmod(rank, groups)
        dealt[at if turn % 2 == 0 else groups - 1 - at] += letter
    for code in range(0xC0, 0x100):
        dealt[code % groups] += chr(code)
    return dealt


def _cell(word: Column, groups: int) -> Column:
    """The number of a word's letters in each group."""
    return F.array(*(F.length(word) - F.length(F.translate(word, g, "")) for g in _letter_groups(groups)))


def _text(cell: Column) -> Column:
    return F.array_join(cell.cast("array<string>"), ".")


def _beside(cell: Column, groups: int) -> Column:
    """The cell itself, those with one letter more and those with one letter replaced, each unordered pair from one side."""
    here = [cell.getItem(g) for g in range(groups)]
    steps = [[0] * groups]
    steps += [[int(k == g) for k in range(groups)] for g in range(groups)]
    steps += [[int(k == h) - int(k == g) for k in range(groups)] for g in range(groups) for h in range(g)]
    return F.array(*(_text(F.array(*(x + s for x, s in zip(here, step)))) for step in steps))


def letter_counts(words: list[str]) -> np.ndarray:
    """One row of letter counts for each word: a to z, then U+00C0 to U+00FF."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    of = np.repeat(np.arange(len(words)), [len(w) for w in words])
    dim = np.where(flat >= 0xC0, flat - 0xC0 + 26, flat - 0x61)
    return np.bincount(of * 90 + dim, minlength=90 * len(words)).reshape(-1, 90).astype(np.float32)


def one_edit(a: str, b: str) -> bool:
    """Whether the words differ by exactly one inserted, deleted or replaced letter."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    at = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[at + (len(a) >= len(b)) :] == b[at + (len(b) >= len(a)) :]


def _near_in(one: list[str], other: list[str], same: bool) -> Iterator[tuple[str, str]]:
    """Pairs one edit apart between two blocks, or within one; each pair once."""
    x, y = letter_counts(one), letter_counts(other)
    size, size2 = x.sum(1), y.sum(1)
    apart = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)
    close = (apart <= 2) & (np.abs(size[:, None] - size2[None, :]) <= 1)
    for i, k in np.argwhere(np.triu(close, 1) if same else close).tolist():
        if one_edit(one[i], other[k]):
            yield one[i], other[k]


def near_words(words: DataFrame, groups: int = GROUPS, block: int = _BLOCK) -> DataFrame:
    """a, b: all pairs of ``words`` (word) one edit apart, each pair once."""
    cells = words.select("word", _cell(F.col("word"), groups).alias("at")).withColumn("cell", _text(F.col("at")))
    many = cells.groupBy("cell").agg(F.count("*").alias("held"), F.any_value("at").alias("at")).select(
        "cell", "at", F.ceil(F.col("held") / block).cast("int").alias("blocks"))
    many = stage_lean(many, "cells")
    dealt = stage_lean(cells.join(many.select("cell", "blocks"), "cell").select(
        "word", F.concat_ws("/", "cell", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("string")).alias("block")), "word-blocks")
    there = many.select(F.col("cell").alias("other"), F.col("blocks").alias("others"))
    met = many.select("cell", "blocks", F.explode(_beside(F.col("at"), groups)).alias("other")).join(there, "other")
    pairs = met.select("cell", "other", "others", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("i")) \
        .select("cell", "other", "i", F.explode(F.sequence(F.lit(0), F.col("others") - 1)).alias("k")) \
        .where((F.col("cell") != F.col("other")) | (F.col("i") <= F.col("k"))) \
        .select(F.concat_ws("/", "cell", F.col("i").cast("string")).alias("left"),
                F.concat_ws("/", "other", F.col("k").cast("string")).alias("right"))
    pairs = stage_lean(pairs.withColumn("pair", F.concat_ws("|", "left", "right")), "block-pairs")
    sides = [dealt.join(pairs.select("pair", F.col(side).alias("block"), (F.col("left") == F.col("right")).alias("same")), "block")
             .select("pair", "word", "same", F.lit(side == "right").alias("second")) for side in ("left", "right")]
    both = sides[0].unionByName(sides[1].where(~F.col("same")))

    def run(group: pa.Table) -> pa.Table:
        word = np.array(group.column("word").to_pylist(), object)
        second = group.column("second").to_numpy()
        same = bool(group.column("same")[0].as_py())
        one, other = word[~second].tolist(), word[second].tolist()
        found = list(_near_in(one, one if same else other, same))
        return pa.table({"a": pa.array([p[0] for p in found], pa.string()), "b": pa.array([p[1] for p in found], pa.string())})

    return both.groupBy("pair").applyInArrow(run, "a string, b string")


def _roots(forms: DataFrame, most: int) -> DataFrame:
    """word, root for each word with a form: the forms followed to the last, in steps that double.

    A form is ``FORM_FACTOR`` times as frequent as its word, so a way of forms has no more steps than the logarithm of
    the most frequent word's count.
    """
    roots, length, longest = forms.select("word", F.col("form").alias("root")), 1, 1
    while FORM_FACTOR ** longest <= most:
        longest += 1
    while length < longest:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("last"))
        roots = stage_lean(roots.join(further, "root", "left").select("word", F.coalesce("last", "root").alias("root")), "roots")
        length *= 2
    return roots


def group_spellings(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``docs`` (doc_id, text).

    A word is a run of the letters A-Z, a-z and U+00C0 to U+00FF, lower-cased in ASCII; of one run in ``SHRINK``, chosen by
    the crc32 of doc_id and run (a null doc_id counts as empty), a letter is left out. Words have six letters and five
    occurrences at least. ``form`` is the most frequent word one edit apart (ties: the smallest), if it is five times as
    frequent; ``root`` the last of a word's forms. Null and empty texts have no words; repeated rows count each.
    """
    words = stage_lean(count_words(docs), "words")
    pairs = stage_lean(near_words(words), "near-words")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    beside = both.join(words.select(F.col("word").alias("b"), "n"), "b")
    best = F.min(F.struct((-F.col("n")).alias("less"), F.col("b").alias("word")))
    near = beside.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), best.alias("best"))
    often = F.col("best.less") <= -FORM_FACTOR * F.col("n")
    known = stage_lean(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(often, F.col("best.word")).alias("form"),
        F.when(often, -F.col("best.less")).alias("form_n")), "forms")
    most = words.agg(F.max("n")).first()[0] or 0
    roots = _roots(known.where("form is not null"), most)
    done = known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
    discard(words, pairs)
    return done


def op13_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word of ``documents`` with the spelling it is a variant of."""
    return group_spellings(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
