"""Quality by hierarchical empirical Bayes: a document's own evidence with the posteriors of its host and path.

A logistic model of counts over the whole text gives each document a probability of good quality. Paths and hosts sum
these by grouped aggregation. A host's mean shrinks towards the mean of all documents and a path's towards its host's,
by strengths fitted to how much hosts, and paths within hosts, really differ: sites with few documents say little. The
document's log-odds then move by what its path, without the document itself, says beyond the mean of all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .doc_stats import CHARACTER_CLASSES, Words
from .staging import stage_lean
from .text import Slice, slices, tidy

MAX_TRAINING_DOCS = 6000  # labelled documents the model is fitted on
KEEP_FROM = 0.5
_STRENGTHS = (1.0, 10_000.0)


def features(part: Slice) -> np.ndarray:
    """One row of logarithmic shares for each text of a slice."""
    words = Words(part)
    n, classes = words.count(), words.classes().astype(float)
    letters, lines = classes.sum(axis=1), words.duplicate_lines()
    share = lambda some, all_: np.log((some + 0.5) / (all_ + 1.0))
    columns = [np.log1p(n), share(words.repeated(), n), share(words.distinct(), n), share(words.characters(), n),
               share(lines, classes[:, 5] + 1)]
    columns += [share(classes[:, k], letters) for k in range(len(CHARACTER_CLASSES))]
    # A plain share beside the logarithm tells "some" from "most".
    columns += [words.repeated() / np.maximum(n, 1), classes[:, 2] / np.maximum(letters, 1), classes[:, 7] / np.maximum(letters, 1),
                classes[:, 8] / np.maximum(letters, 1)]
    return np.stack(columns, axis=1)


class Model:
    """Logistic regression on standardised features, by Newton's method with a ridge."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0):
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
        z = self._standard(x)
        w = np.zeros(z.shape[1])
        penalty = np.full(z.shape[1], ridge)
        penalty[0] = 1e-6
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            gradient = z.T @ (p - y) + penalty * w
            hessian = (z * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ z + np.diag(penalty)
            step = np.linalg.solve(hessian, gradient)
            w -= np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-6:
                break
        self.weights = w

    def _standard(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.concatenate([np.ones((len(z), 1)), z], axis=1)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self._standard(x) @ self.weights, -12, 12)


def train(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_TRAINING_DOCS) -> Model:
    """Fit on at most ``max_docs`` documents with a quality label, least hashes of doc_id first; features come from
    the executors. Of the rows with one doc_id the one with the least hash of its text counts. Without labels of both
    kinds every document counts as good."""
    some = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
            .where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(0)):
                rows = features(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(rows), pa.list_(pa.float64())), batch.column(1).slice(part.lo, part.n)], ["x", "quality"])

    # One row for each of the sample's ids, so max_docs rows at most.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(some), "doc_id").groupBy("doc_id").agg(
        F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"), F.first("quality").alias("quality")) \
        .select("text", "quality").mapInArrow(tidy(run), "x array<double>, quality int").toArrow()
    y = rows.column("quality").to_numpy().astype(float)
    if not len(y) or y.min() == y.max():
        x = np.zeros((2, len(CHARACTER_CLASSES) + 9))
        return Model(x, np.array([y.mean() if len(y) else 1.0] * 2))
    return Model(np.array(rows.column("x").to_pylist()), y)


def score(docs: DataFrame, model: Model, log_odds: str = "log_odds") -> DataFrame:
    """Every row with the model's log-odds of good quality from the text alone (null counts as empty)."""
    kept = [c for c in docs.columns if c != log_odds]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(batch.schema.get_field_index("text"))):
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(part.lo, part.n) for c in batch.columns), pa.array(model.log_odds(features(part)))],
                    [*kept, log_odds])

    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(log_odds, T.DoubleType())])
    return docs.select(kept).mapInArrow(tidy(run), schema)


def _strength(differences: float | None, mean: float) -> float:
    """How many documents a prior weighs, if means of groups vary by ``differences`` around it."""
    if not differences or differences <= 0:
        return _STRENGTHS[1]
    return min(max(mean * (1 - mean) / differences - 1, _STRENGTHS[0]), _STRENGTHS[1])


def sites(evidence: DataFrame) -> tuple[DataFrame, float, float]:
    """Of rows (host, path, p): host, path, n and total of each path with the host's shrunken mean; the mean of all and
    the strength of a host's mean as the prior of its paths."""
    paths = stage_lean(evidence.groupBy("host", "path").agg(
        F.count("*").alias("n"), F.sum("p").alias("total"), F.sum(F.col("p") * F.col("p")).alias("squares")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("total").alias("htotal"))
    whole = paths.agg(F.sum("n"), F.sum("total"), F.sum("squares")).first()
    n, mean = whole[0] or 0, (whole[1] or 0.0) / max(whole[0] or 0, 1)
    spread = max((whole[2] or 0.0) / max(n, 1) - mean**2, 0.0)

    def between(groups: DataFrame, size: str, total: str, around) -> float | None:
        """Variance of group means beyond what their documents make by chance, weighted by size."""
        n_ = F.col(size)
        return groups.agg(F.sum(n_ * F.pow(F.col(total) / n_ - around, 2) - spread) / F.sum(n_)).first()[0]

    mean = min(max(mean, 1e-6), 1 - 1e-6)
    host_strength = _strength(between(hosts, "hn", "htotal", F.lit(mean)), mean)
    joined = paths.join(hosts, "host")
    path_strength = _strength(between(joined, "n", "total", F.col("htotal") / F.col("hn")), mean)
    shrunk = (F.col("htotal") + host_strength * mean) / (F.col("hn") + host_strength)
    return joined.select("host", "path", "n", "total", shrunk.alias("host_mean")), mean, path_strength


def judge(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", keep_from: float = KEEP_FROM,
          max_docs: int = MAX_TRAINING_DOCS) -> DataFrame:
    """Every row with text_probability, site_probability, probability and kept added (same names are replaced).

    ``path`` is taken within ``host``. Null hosts and paths are sites of their own; null texts count as empty.
    """
    model = train(docs, labels, max_docs)
    site = [F.coalesce(F.col(host).cast("string"), F.lit("")).alias("__host"),
            F.coalesce(F.col(path).cast("string"), F.lit("")).alias("__path")]
    p = 1 / (1 + F.exp(-F.col("__log_odds")))
    evidence = score(docs.select(*site, "text"), model, "__log_odds").select(
        F.col("__host").alias("host"), F.col("__path").alias("path"), p.alias("p"))
    found, mean, strength = sites(evidence)
    found = stage_lean(found, "sites").select(
        F.col("host").alias("__host"), F.col("path").alias("__path"), F.col("n").alias("__n"), F.col("total").alias("__total"),
        F.col("host_mean").alias("__mean"))
    added = ["text_probability", "site_probability", "probability", "kept"]
    own = docs.drop(*added)
    scored = score(own.select(*own.columns, *site), model, "__log_odds").join(found, ["__host", "__path"])
    # What the path says without this document.
    others = (F.col("__total") - p + strength * F.col("__mean")) / (F.col("__n") - 1 + strength)
    others = F.greatest(F.least(others, F.lit(1 - 1e-6)), F.lit(1e-6))
    shifted = F.col("__log_odds") + F.ln(others / (1 - others)) - math.log(mean / (1 - mean))
    return scored.select(*own.columns, p.alias("text_probability"), others.alias("site_probability"),
                         (1 / (1 + F.exp(-shifted))).alias("probability"),
                         (1 / (1 + F.exp(-shifted)) >= keep_from).alias("kept"))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; sources are hosts, and a source's languages its paths."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source", "lang")
    return judge(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).drop("text", "source", "lang")
