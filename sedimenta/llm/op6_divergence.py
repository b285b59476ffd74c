"""Quality rules by divergence: character-class and common-word histograms against those of the document's language.

A language's reference is the sum over all its documents; every language has one, and references are joined to the
documents. Words are counted in hashed bins; the bins with most words
are the language's common words, all others count together. Distance is Jensen-Shannon divergence in bits. It is not
judged below a minimum length, and what a short text may differ by chance is allowed for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .doc_stats import CHARACTER_CLASSES, Words
from .text import slices

WORD_BINS = 1 << 14
COMMON_WORDS = 64
MIN_WORDS = 50
MAX_CHARACTER_DIVERGENCE = 0.08
MAX_WORD_DIVERGENCE = 0.20

_HISTOGRAM = "lang string, kind int, bin int, n long"
_PARTS = ("__classes", "__bins", "__common", "__rest")
_ADDED = T.StructType([
    *(T.StructField(c, T.LongType()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
    T.StructField("base_failed", T.BooleanType()), T.StructField("character_divergence", T.DoubleType()),
    T.StructField("word_divergence", T.DoubleType()), T.StructField("kept", T.BooleanType())])


def _bins(words: Words) -> np.ndarray:
    return (words.lower_hashes() % np.uint64(WORD_BINS)).astype(np.int64)


def histograms(docs: DataFrame) -> DataFrame:
    """lang, kind (0: character classes, 1: word bins), bin, n: over all documents; null languages count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, list[np.ndarray]] = {}

        def rows():
            for lang, both in sums.items():
                for kind, counts in enumerate(both):
                    at = np.flatnonzero(counts)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(at), pa.string()), pa.array(np.full(len(at), kind, np.int32)),
                         pa.array(at.astype(np.int32)), pa.array(counts[at])], ["lang", "kind", "bin", "n"])
            sums.clear()

        for batch in batches:
            langs = np.array([x or "" for x in batch.column(0).to_pylist()], object)
            for part in slices(batch.column(1)):
                words = Words(part)
                classes, bins = words.classes(), _bins(words)
                mine = langs[part.lo : part.hi]
                names, index = np.unique(mine.astype(str), return_inverse=True)
                by_word = index[words.owner]
                for k, name in enumerate(names.tolist()):
                    both = sums.setdefault(name, [np.zeros(len(CHARACTER_CLASSES), np.int64), np.zeros(WORD_BINS, np.int64)])
                    both[0] += classes[index == k].sum(axis=0)
                    both[1] += np.bincount(bins[by_word == k], minlength=WORD_BINS)
                if len(sums) > 64:
                    yield from rows()
        yield from rows()

    counted = docs.select(F.col("lang").cast("string").alias("lang"), "text").mapInArrow(run, _HISTOGRAM)
    return counted.groupBy("lang", "kind", "bin").agg(F.sum("n").alias("n"))


def references(docs: DataFrame) -> DataFrame:
    """One row for each language with words: __of (the language), the words of each class, the bins of the common words,
    their words, and the words of all other bins."""
    from .staging import stage_lean

    counted = histograms(docs)
    order = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "bin")
    ranked = counted.withColumn("common", (F.col("kind") == 1) & (F.row_number().over(order) <= COMMON_WORDS))
    classes = [F.coalesce(F.sum(F.when((F.col("kind") == 0) & (F.col("bin") == k), F.col("n"))), F.lit(0))
               for k in range(len(CHARACTER_CLASSES))]
    common = F.sort_array(F.collect_list(F.when(F.col("common"), F.struct("bin", "n"))))  # COMMON_WORDS at most
    rest = F.coalesce(F.sum(F.when((F.col("kind") == 1) & ~F.col("common"), F.col("n"))), F.lit(0))
    rows = ranked.groupBy(F.col("lang").alias("__of")).agg(F.array(*classes).alias("__classes"), common.alias("x"), rest.alias("__rest"))
    return stage_lean(rows.select("__of", "__classes", F.col("x.bin").alias("__bins"), F.col("x.n").alias("__common"), "__rest"),
                      "references")


def jensen_shannon(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Divergence in bits of each row of ``p`` from ``q``; both hold shares. A row without mass has distance 0."""
    m = (p + q) / 2

    def relative(a):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(a > 0, a * np.log2(a / m), 0.0).sum(axis=1)

    return np.where(p.sum(axis=1) > 0, (relative(p) + relative(np.broadcast_to(q, p.shape))) / 2, 0.0)


def judge(docs: DataFrame) -> DataFrame:
    """Every row with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, both divergences and kept.

    A document is kept if the base rules pass (50 words, at most half of them in repeated 3-word windows) and neither
    histogram is further from its language than allowed: a fixed distance, and what sampling that many words or
    characters makes by chance. Null texts have no words and fail the base rules. A null or empty language is one of its
    own. Where a language has no words at all, the distances are 0.
    Columns of the same names are replaced.
    """
    reference = references(docs)
    kept = [c for c in docs.columns if c not in _ADDED.names]
    width = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array([x or "" for x in batch.column(width).to_pylist()], object)
            with_words = batch.column(width + 1).is_valid().to_numpy(zero_copy_only=False)
            text = batch.column(batch.schema.get_field_index("text"))
            for part in slices(text):
                words = Words(part)
                n, repeated = words.count(), words.repeated()
                classes, bins = words.classes().astype(float), _bins(words)
                by_class, by_word = np.zeros(part.n), np.zeros(part.n)
                mine = langs[part.lo : part.hi]
                mine[~with_words[part.lo : part.hi]] = None  # a language without words: no text of it has any distance
                for name in {x for x in mine.tolist() if x is not None}:
                    rows = np.flatnonzero(mine == name)
                    share, common, shares = _reference(*(batch.column(width + 1 + k)[part.lo + int(rows[0])].as_py() for k in range(4)))
                    place = np.full(part.n, -1)
                    place[rows] = np.arange(len(rows))
                    column = np.full(WORD_BINS, len(common))
                    column[common] = np.arange(len(common))
                    at = place[words.owner]
                    cells = len(common) + 1
                    counts = np.bincount((at * cells + column[bins])[at >= 0], minlength=len(rows) * cells).reshape(-1, cells)
                    by_class[rows] = jensen_shannon(_shares(classes[rows]), share)
                    by_word[rows] = jensen_shannon(_shares(counts), shares)
                failed = (n < MIN_WORDS) | (100 * repeated > 50 * n)
                chance = lambda cells, size: cells / (8 * np.log(2) * np.maximum(size, 1))
                far = (by_class > MAX_CHARACTER_DIVERGENCE + chance(len(CHARACTER_CLASSES), classes.sum(axis=1))) \
                    | (by_word > MAX_WORD_DIVERGENCE + chance(COMMON_WORDS + 1, n))
                added = [n, words.characters(), words.symbols(), words.duplicate_lines(), repeated, failed, by_class,
                         by_word, ~failed & ~far]
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(part.lo, part.n) for c in batch.columns[:width]), *map(pa.array, added)],
                    [*kept, *_ADDED.names])

    source = docs.select(*kept, F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("__lang"))
    joined = source.join(reference, F.col("__lang") == F.col("__of"), "left").select(*kept, "__lang", *_PARTS)
    return joined.mapInArrow(run, T.StructType([docs.schema[c] for c in kept] + _ADDED.fields))


def _reference(classes: list, bins: list, common: list, rest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shares of classes, bins of common words and their shares, with that of all others at the end."""
    share, shares = np.array(classes, float), np.array([*common, rest], float)
    return share / max(share.sum(), 1), np.array(bins, np.int64), shares / max(shares.sum(), 1)


def _shares(counts: np.ndarray) -> np.ndarray:
    return counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)


def op6_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the divergence verdict of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return judge(docs).select("doc_id", *_ADDED.names)
