"""Language-model scores by masked pseudo-likelihood: every word is predicted from the words on both sides of it.

Lower-cased words fall into hashed bins. The bins with most words in the whole corpus are tokens of their own, the rest
share some. The network adds up learned vectors of the neighbours, one table for each place in the window, and predicts
a token's number digit by digit from them, so its probabilities add up to one.

A token is a class of words. A word's probability is that of its token times its share of the token's words, from a
table that counts every distinct word of the corpus. A token with N running words gives n / (N + 1) to a word seen n
times and the rest to words not seen. A document's score is the sum of the log-probabilities of all its words. The few
words frequent enough to be hot keys travel with the network, all others are joined with the table.

All documents take part in the training, in rounds: each task follows the gradient over its documents of the round,
starting from the common weights, and the new common weights are the mean over tasks, weighted by words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .staging import stage_lean
from .text import LOWER, Slice, prefix_sums, slices, span_hashes, words

BINS = 1 << 16
DIGIT = 32
TOKENS = DIGIT * DIGIT  # the last number, TOKENS, stands for a place outside the text
SHARED = 64
REACH = 2
WIDTH = 16
ROUNDS = 2
BATCH = 8192
RATE = 0.01
FREQUENT = 4096  # words that make up a larger part of all than one in so many are not joined: fewer than this number

_SHAPES = {"near": (2 * REACH, TOKENS + 1, WIDTH), "bias": (WIDTH,), "high": (WIDTH, DIGIT), "high_bias": (DIGIT,),
           "low": (WIDTH, DIGIT), "low_bias": (DIGIT, DIGIT)}


def _hashed(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The lower-cased bytes; start, end, text and hash of each word."""
    starts, ends, owner = words(part)
    low = LOWER[part.buf]
    return low, starts, ends, owner, span_hashes(prefix_sums(low), starts, ends)


def _strings(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes of each span as a string."""
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    at = np.repeat(starts - offsets[:-1], ends - starts) + np.arange(offsets[-1])
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(low[at])).cast(pa.string())


def word_counts(docs: DataFrame) -> DataFrame:
    """word, hash, n: every distinct lower-cased word of all documents and how often it occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(0)):
                low, starts, ends, _, hashes = _hashed(part)
                found, first, n = np.unique(hashes, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [_strings(low, starts[first], ends[first]), pa.array(found.view(np.int64)), pa.array(n)],
                    ["word", "hash", "n"])

    return docs.select("text").mapInArrow(run, "word string, hash long, n long").groupBy("word", "hash").agg(
        F.sum("n").alias("n"))


def _bin_counts(counts: DataFrame) -> DataFrame:
    return counts.groupBy(F.col("hash").bitwiseAND(BINS - 1).alias("bin")).agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame) -> np.ndarray:
    """The token of every bin: words of all documents are counted, so the largest bins are the corpus's frequent words."""
    top = [r[0] for r in _bin_counts(counts).orderBy(F.desc("n"), "bin").limit(TOKENS - SHARED).collect()]
    token = np.arange(BINS) % SHARED
    token[top] = SHARED + np.arange(len(top))
    return token


class Network:
    def __init__(self, token: np.ndarray, weights: dict[str, np.ndarray]):
        self.token, self.weights = token, weights

    @classmethod
    def fresh(cls, token: np.ndarray, seed: int = 11) -> Network:
        rng = np.random.default_rng(seed)
        return cls(token, {k: (rng.normal(size=s) * (0 if "bias" in k else 0.1)).astype(np.float32) for k, s in _SHAPES.items()})

    @classmethod
    def from_flat(cls, token: np.ndarray, flat: np.ndarray) -> Network:
        sizes = [int(np.prod(s)) for s in _SHAPES.values()]
        parts = np.split(flat.astype(np.float32), np.cumsum(sizes)[:-1])
        return cls(token, {k: p.reshape(s) for (k, s), p in zip(_SHAPES.items(), parts)})

    def flat(self) -> np.ndarray:
        return np.concatenate([self.weights[k].ravel() for k in _SHAPES])

    def examples(self, hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each word's token and the tokens around it (one row for each place)."""
        y = self.token[(hashes % np.uint64(BINS)).astype(np.int64)]
        around = np.full((2 * REACH, len(y)), TOKENS, np.int64)
        for row, step in enumerate([*range(-REACH, 0), *range(1, REACH + 1)]):
            here, there = (slice(-step, None), slice(None, step)) if step < 0 else (slice(None, -step), slice(step, None))
            same = owner[here] == owner[there]
            around[row, here] = np.where(same, y[there], TOKENS)
        return y, around

    def _forward(self, y: np.ndarray, around: np.ndarray):
        """A column for each word, so that maxima and sums over a digit's values run along the words."""
        w = self.weights
        h = (w["near"][0] + w["bias"]).take(around[0], axis=0)
        for k in range(1, 2 * REACH):
            h += w["near"][k].take(around[k], axis=0)
        h = np.tanh(h, out=h).T
        high, low = y // DIGIT, y % DIGIT
        columns = np.arange(len(y))
        logs = np.zeros(len(y))
        powers = []
        for z, bias, digit in ((w["high"].T @ h, w["high_bias"][:, None], high),
                               (w["low"].T @ h, w["low_bias"].T.take(high, axis=1), low)):
            z += bias
            z -= z.max(axis=0)
            logs += z[digit, columns]
            e = np.exp(z, out=z)
            total = e.sum(axis=0)
            logs -= np.log(total)
            powers.append((e, total))
        return h, high, low, powers, logs

    def log_probabilities(self, y: np.ndarray, around: np.ndarray) -> np.ndarray:
        out = np.empty(len(y))
        for lo in range(0, len(y), BATCH):
            out[lo : lo + BATCH] = self._forward(y[lo : lo + BATCH], around[:, lo : lo + BATCH])[4]
        return out

    def gradient(self, y: np.ndarray, around: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean negative log-probability."""
        w = self.weights
        h, high, low, ((p, of_p), (q, of_q)), _ = self._forward(y, around)
        columns = np.arange(len(y))
        for shares, total, digit in ((p, of_p, high), (q, of_q, low)):
            shares *= 1 / (total * len(y))
            shares[digit, columns] -= 1 / len(y)
        is_high = np.zeros((len(y), DIGIT), h.dtype)
        is_high[columns, high] = 1
        dh = np.multiply(w["high"] @ p + w["low"] @ q, 1 - h * h, dtype=np.float64)
        near = np.stack([_sum_columns(dh, around[k], TOKENS + 1) for k in range(2 * REACH)])
        return {"near": near, "bias": dh.sum(axis=1), "high": h @ p.T, "high_bias": p.sum(axis=1), "low": h @ q.T,
                "low_bias": (q @ is_high).T}


def _sum_columns(columns: np.ndarray, index: np.ndarray, n: int) -> np.ndarray:
    """Sums of the columns with each index, as rows."""
    return np.stack([np.bincount(index, row, n) for row in columns], axis=1).astype(np.float32)


class Adam:
    def __init__(self, network: Network):
        self._network = network
        self._mean = {k: np.zeros(s, np.float32) for k, s in _SHAPES.items()}
        self._square = {k: np.zeros(s, np.float32) for k, s in _SHAPES.items()}
        self._steps = 0

    def step(self, y: np.ndarray, around: np.ndarray, rate: float) -> None:
        self._steps += 1
        for k, g in self._network.gradient(y, around).items():
            m, v = self._mean[k], self._square[k]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            unbiased = rate * (1 - 0.99**self._steps) ** 0.5 / (1 - 0.9**self._steps)
            self._network.weights[k] -= (unbiased * m / (np.sqrt(v) + 1e-7)).astype(np.float32, copy=False)


def train(docs: DataFrame, rounds: int = ROUNDS, counts: DataFrame | None = None) -> Network:
    """A network of all documents: each takes part in one of the rounds, by hash of its text.

    ``counts`` are the documents' :func:`word_counts`, if they are staged already.
    """
    token = vocabulary(word_counts(docs) if counts is None else counts)
    network = Network.fresh(token)
    for turn in range(rounds):
        start = network.flat()

        def run(batches: Iterator[pa.RecordBatch], start=start, rate=RATE / (1 + turn)) -> Iterator[pa.RecordBatch]:
            mine = Network.from_flat(token, start.copy())
            adam, seen = Adam(mine), 0
            for batch in batches:
                for part in slices(batch.column(0)):
                    _, _, _, owner, hashes = _hashed(part)
                    y, around = mine.examples(hashes, owner)
                    for lo in range(0, len(y), BATCH):
                        adam.step(y[lo : lo + BATCH], around[:, lo : lo + BATCH], rate)
                    seen += len(y)
            if seen:
                flat = mine.flat().astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(flat))), pa.array(flat * seen), pa.array(np.full(len(flat), float(seen)))],
                    ["place", "total", "words"])

        part = docs.select("text").where(F.pmod(F.xxhash64("text"), F.lit(rounds)) == turn)
        mean = part.mapInArrow(run, "place long, total double, words double").groupBy("place").agg(
            (F.sum("total") / F.sum("words")).alias("value"))
        rows = stage_lean(mean, "weights").orderBy("place").toArrow()  # as many rows as the network has weights
        if rows.num_rows:
            network = Network.from_flat(token, rows.column("value").to_numpy())
    return network


def score(docs: DataFrame, network: Network, counts: DataFrame | None = None) -> DataFrame:
    """Every row with n_words, log_likelihood (sum over all words) and mean_log_likelihood added.

    ``counts`` are the staged :func:`word_counts` of the corpus, by default of ``docs``. Null and empty texts have no
    words, the sum 0 and no mean. Columns of the same names are replaced.
    """
    return _scored(docs, network, stage_lean(word_counts(docs), "word-counts") if counts is None else counts,
                   [c for c in docs.columns if c not in _ADDED])


_ADDED = ("n_words", "log_likelihood", "mean_log_likelihood")
_RARE = pa.struct([("word", pa.string()), ("times", pa.int32())])


def _scored(docs: DataFrame, network: Network, counts: DataFrame, kept: list[str]) -> DataFrame:
    """The columns ``kept`` and the three added ones."""
    bins = _bin_counts(counts).toArrow()  # at most BINS rows
    n = bins.column("n").to_numpy()
    sizes = np.bincount(network.token[bins.column("bin").to_numpy()], n, TOKENS)
    frequent = counts.where(F.col("n") * FREQUENT > int(n.sum())).select("hash", "n").toArrow()
    known = frequent.column("hash").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(known)
    known, known_log = np.append(known[order], np.uint64(0)), np.append(np.log(frequent.column("n").to_numpy()[order]), 0.0)
    names = [*kept, "__row", "__n", "__sum", "__rare"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(batch.num_columns - 1)):
                low, starts, ends, owner, hashes = _hashed(part)
                y, around = network.examples(hashes, owner)
                at = np.searchsorted(known[:-1], hashes)
                is_known = (known[at] == hashes) & (at < len(known) - 1)
                logs = network.log_probabilities(y, around) - np.log1p(sizes[y]) + np.where(is_known, known_log[at], 0.0)
                total = np.bincount(owner, logs, part.n).astype(float)  # also without words
                # The others once for each text; their counts are joined.
                rare = np.flatnonzero(~is_known)
                rare = rare[np.argsort(hashes[rare])]
                rare = rare[np.argsort(owner[rare].astype(np.min_scalar_type(part.n)), kind="stable")]
                new = np.ones(len(rare), bool)
                new[1:] = (hashes[rare[1:]] != hashes[rare[:-1]]) | (owner[rare[1:]] != owner[rare[:-1]])
                first = np.flatnonzero(new)
                times = np.diff(np.append(first, len(rare))).astype(np.int32)
                first = rare[first]
                offsets = np.searchsorted(owner[first], np.arange(part.n + 1)).astype(np.int32)
                found = pa.StructArray.from_arrays(
                    [_strings(low, starts[first], ends[first]), pa.array(times)], fields=list(_RARE))
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(part.lo, part.n) for c in batch.columns[:-1]), pa.array(np.bincount(owner, minlength=part.n)),
                     pa.array(total), pa.ListArray.from_arrays(pa.array(offsets), found)], names)

    schema = T.StructType([docs.schema[c] for c in kept] + [
        T.StructField("__row", T.LongType()), T.StructField("__n", T.LongType()), T.StructField("__sum", T.DoubleType()),
        T.StructField("__rare", T.ArrayType(T.StructType([
            T.StructField("word", T.StringType()), T.StructField("times", T.IntegerType())])))])
    source = docs.select(*kept, F.monotonically_increasing_id().alias("__row"), F.col("text").alias("__text"))
    scored = stage_lean(source.mapInArrow(run, schema), "scored")
    rare = scored.select("__row", F.inline("__rare")).join(counts.select("word", F.ln("n").alias("__log")), "word") \
        .groupBy("__row").agg(F.sum(F.col("times") * F.col("__log")).alias("__more"))
    total = F.col("__sum") + F.coalesce("__more", F.lit(0.0))
    return scored.drop("__rare").join(rare, "__row", "left").select(
        *kept, F.col("__n").alias("n_words"), total.alias("log_likelihood"),
        F.when(F.col("__n") > 0, total / F.col("__n")).alias("mean_log_likelihood"))


def op8_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pseudo-likelihood of every document under a network trained on all of them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    counts = stage_lean(word_counts(docs), "word-counts")
    return _scored(docs, train(docs, counts=counts), counts, ["doc_id"])
