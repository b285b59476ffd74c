"""Toxicity by multiple-instance learning: sentences are scored, a document is toxic if any sentence is (noisy-or).

Only document labels are known. A sentence's log-odds is a sum over its words of the weights of the word and of its
beginnings, so unseen endings of a known stem count too. A document's score is one minus the product over sentences of
one minus their probability. Weights follow the gradient of the document likelihood, and the sentences with large
probability are those that offend.

Features are exact 64-bit hashes; only those with a weight are looked up, so rare words never share one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import LOWER, Slice, slices, span_digests

MAX_TRAINING_DOCS = 5000  # of labelled documents; a third of them toxic at most
MAX_TRAINING_BYTES = 100_000  # of one training document
THRESHOLD = 0.7
_BIAS = -9.0  # log-odds of a sentence without evidence; kept, so that thousands of such sentences stay harmless
_BEGINNINGS = (4, 5, 6)
_BITS = 20

_LETTER = np.zeros(256, bool)
_LETTER[ord("a") : ord("z") + 1] = True
_LETTER[0x80:] = True
_SENTENCE_END = np.zeros(256, bool)
_SENTENCE_END[list(b".!?\n")] = True


@dataclass
class Sentences:
    """Features of a slice: hashes of each kind by word, the sentence of each word and the text of each sentence."""

    features: np.ndarray
    sentence: np.ndarray
    owner: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def sentences(part: Slice) -> Sentences:
    low = LOWER[part.buf]
    letter = _LETTER[low]
    begins, ends = letter.copy(), letter.copy()
    begins[1:] &= ~letter[:-1]
    ends[:-1] &= ~letter[1:]
    edge = part.offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(low))]
    begins[edge] = letter[edge]
    ends[edge - 1] = letter[edge - 1]
    first, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    # Every text has a sentence, also an empty one.
    cut = np.flatnonzero(_SENTENCE_END[low[:-1]]) + 1 if len(low) else np.zeros(0, np.int64)
    inner = cut[~np.isin(cut, part.offsets)]
    starts = np.sort(np.concatenate([part.offsets[:-1], inner]), kind="stable")
    owner = np.sort(np.concatenate([np.arange(part.n), np.searchsorted(part.offsets, inner, "right") - 1]), kind="stable")
    stops = np.minimum(np.append(starts[1:], len(low)), part.offsets[owner + 1])
    sentence = np.searchsorted(starts, first, "right") - 1
    kinds = [span_digests(low, first, stop)]
    for k in _BEGINNINGS:  # of bytes; told apart from whole words by their lowest bit
        kinds.append(span_digests(low, first, np.minimum(first + k, stop)) | np.uint64(1))
    kinds[0] &= ~np.uint64(1)
    return Sentences(np.stack(kinds, axis=1) if len(first) else np.zeros((0, 1 + len(_BEGINNINGS)), np.uint64),
                     sentence, owner, starts, stops)


@dataclass
class Model:
    """Sorted feature hashes and their weights, and the log-odds of a sentence without any."""

    hashes: np.ndarray
    weights: np.ndarray
    bias: float

    def __post_init__(self):
        self._near = np.zeros(1 << _BITS, bool)  # most words fail this look-up, the others are searched
        self._near[(self.hashes >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def log_odds(self, found: Sentences) -> np.ndarray:
        out = np.full(len(found.owner), self.bias)
        if not len(self.hashes):
            return out
        for k in range(found.features.shape[1]):
            h = found.features[:, k]
            word = np.flatnonzero(self._near[(h >> np.uint64(64 - _BITS)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.hashes, h[word]), len(self.hashes) - 1)
            hit = self.hashes[at] == h[word]
            out += np.bincount(found.sentence[word[hit]], self.weights[at[hit]], len(out))
        return out


def noisy_or(log_odds: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    return 1 - np.exp(-np.bincount(owner, np.logaddexp(0, log_odds), n))


def fit(texts: pa.Array, labels: np.ndarray, rounds: int = 80, rate: float = 0.5, decay: float = 2e-4) -> Model:
    """Follow the gradient of the documents' log-likelihood under noisy-or."""
    kinds: list[list[np.ndarray]] = [[] for _ in range(1 + len(_BEGINNINGS))]
    where, owners, docs, count = [], [], [], 0
    for part in slices(texts):
        found = sentences(part)
        for k, rows in enumerate(kinds):
            rows.append(found.features[:, k])
        where.append(found.sentence + count)
        docs.append(found.owner[found.sentence] + part.lo)
        owners.append(found.owner + part.lo)
        count += len(found.owner)
    owner, word_sentence, word_doc = np.concatenate(owners), np.concatenate(where), np.concatenate(docs)
    n, y = len(texts), labels.astype(bool)
    names, rows, columns, total = [], [], [], 0
    for parts in kinds:
        values, index = np.unique(np.concatenate(parts), return_inverse=True)
        pairs = np.unique(index * np.int64(n) + word_doc)  # in how many documents of either kind each feature is
        feature, positive = pairs // n, y[pairs % n]
        good = np.bincount(feature, positive, len(values))
        bad = np.bincount(feature, ~positive, len(values))
        expected = (good + bad) * y.mean()
        use = np.abs(good - expected) > 4 * np.sqrt(expected * (1 - y.mean()) + 1e-9)  # far from chance
        number = np.full(len(values), -1)
        number[use] = total + np.arange(use.sum())
        hit = number[index] >= 0
        names.append(values[use])
        rows.append(word_sentence[hit])
        columns.append(number[index[hit]])
        total += int(use.sum())
    row, column, hashes = np.concatenate(rows), np.concatenate(columns), np.concatenate(names)
    weights, speed = np.zeros(total), np.full(total, 1e-3)
    for _ in range(rounds):
        z = _BIAS + np.bincount(row, weights[column], len(owner))
        s = 1 / (1 + np.exp(-z))
        p = np.clip(noisy_or(z, owner, n), 1e-9, 1 - 1e-9)
        pull = (np.where(y, -(1 - p) / p, 1.0) / n)[owner] * s
        gradient = np.bincount(column, pull[row], total) + decay * weights / max(total, 1)
        speed += gradient**2
        weights -= rate * gradient / np.sqrt(speed + 1e-12)
    use = np.abs(weights) > 0.05
    order = np.argsort(hashes[use])
    return Model(hashes[use][order], weights[use][order], _BIAS)


def train(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_TRAINING_DOCS) -> Model:
    """Fit on at most ``max_docs`` labelled documents, at most a third of them toxic, least hashes of doc_id first. Of
    the rows with one doc_id the one with the least hash of its text counts.

    ``labels`` has doc_id and toxic; rows with nulls are left out. Without both labels a document's score is the share
    of toxic labels.
    """
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")) \
        .where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    some = marked.where("toxic = 1").orderBy(*order).limit(max_docs // 3).unionByName(
        marked.where("toxic = 0").orderBy(*order).limit(max_docs - max_docs // 3))
    # One row for each of the sample's ids, so max_docs rows at most.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(
        f"octet_length(text) <= {MAX_TRAINING_BYTES}").join(F.broadcast(some), "doc_id").groupBy("doc_id").agg(
            F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"), F.first("toxic").alias("toxic")) \
        .select("text", "toxic").toArrow()
    y = rows.column("toxic").to_numpy()
    if not len(y) or y.min() == y.max():
        share = float(np.clip(y.mean() if len(y) else 0.0, 1e-6, 1 - 1e-6))
        return Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log(share / (1 - share))))
    return fit(rows.column("text").combine_chunks(), y)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Every row with score, predicted and offending (start and stop in bytes and probability of each sentence of at
    least ``threshold``) added. Null and empty texts have the score of a sentence without words. Columns of the same
    names are replaced."""
    added = T.StructType([
        T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()),
        T.StructField("offending", T.ArrayType(T.StructType([
            T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType()),
            T.StructField("probability", T.DoubleType())])))])
    kept = [c for c in docs.columns if c not in added.names]
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("probability", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(batch.schema.get_field_index("text"))):
                found = sentences(part)
                z = model.log_odds(found)
                p = noisy_or(z, found.owner, part.n)
                bad: list[list[dict]] = [[] for _ in range(part.n)]
                s = 1 / (1 + np.exp(-z))
                for k in np.flatnonzero(s >= threshold).tolist():
                    o = found.owner[k]
                    bad[o].append({"start": int(found.starts[k] - part.offsets[o]),
                                   "stop": int(found.ends[k] - part.offsets[o]), "probability": float(s[k])})
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(part.lo, part.n) for c in batch.columns), pa.array(p),
                     pa.array((p >= threshold).astype(np.int32)), pa.array(bad, kind)], [*kept, *added.names])

    return docs.select(kept).mapInArrow(run, T.StructType([docs.schema[c] for c in kept] + added.fields))


def held_out(doc_id: str = "doc_id"):
    """Whether crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out())
    model = train(docs, labels)
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted",
                                     F.size("offending").cast("long").alias("n_offending"))
