"""Mixing sources to target weights by iterative proportional fitting, then sampling by calibrated probabilities.

Tokens are summed into cells of source, language and topic. Raking scales the cells until every margin has its target
share of the budget, and no cell gives more than it holds: a cell at its limit stays there, and the others are raked to
what is left. A document's chance is the part of its cell that is given. Where a value of a margin holds less than its
target it gives all, the rest of its margin shares the difference, and a warning names it.

Raking ends when every margin is met, or when the margins no longer come nearer: then their targets cannot be met
together, and the table of margins shows by how much. Several rounds are one query over the cells, each margin's sums a
window over its values. A value's cells meet in one task, which spills: those are triples of values, not documents. Only
sums of all come to the driver.
"""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from .staging import discard, stage_lean

MARGINS = ("source", "lang", "topic")
TEMPERATURES = {"source": 0.6, "lang": 0.6, "topic": 0.8}  # 1: as found, 0: all values alike
KEEP_TOKENS = 0.6
SEED = 20240229
TOLERANCE = 1e-6  # of all that is given, what a margin's values may be off together
STALLED = 0.95  # of the margins' error, what is left after rounds that bring them no nearer
_ROUNDS = 4  # in one query
SHORT = 0.001  # part of a target that may be missing without a warning

log = logging.getLogger(__name__)


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def form_topic(text: str = "text") -> Column:
    """A topic by the form of the text: tables, contact data, numbers, long and short prose."""
    t = F.coalesce(F.col(text), F.lit(""))
    return (F.when(F.contains(t, F.lit(" | ")), "table").when(F.contains(t, F.lit("@")), "contact")
            .when(t.rlike(r"[0-9]{4}"), "numbers").when(F.length(t) >= 4000, "long prose").otherwise("short prose"))


def _shares(cells: DataFrame, temperatures: dict[str, float], margins: tuple[str, ...],
            targets: dict[str, DataFrame] | None) -> dict[str, DataFrame]:
    """For each margin its values' shares (margin, share), of any sum.

    Shares are tokens to the power of the margin's temperature, or those of ``targets`` (margin, target), where values
    that are missing get none.
    """
    shares = {}
    for margin in margins:
        if targets and margin in targets:
            found = targets[margin].groupBy(margin).agg(F.sum("target").alias("share"))
        else:
            found = cells.groupBy(margin).agg(F.sum("tokens").cast("double").alias("share")).where("share > 0").select(
                margin, F.pow("share", F.lit(float(temperatures[margin]))).alias("share"))
        shares[margin] = stage_lean(found, "targets")
    return shares


def _with_targets(cells: DataFrame, wanted: dict[str, DataFrame]) -> DataFrame:
    """The cells with ``__t_<margin>``: the target of their value of each margin, 0 without one."""
    for margin, target in wanted.items():
        named = target.select(F.col(margin).alias("__value"), F.col("target").alias(f"__t_{margin}"))
        cells = cells.join(named, F.col(margin).eqNullSafe(F.col("__value")), "left").drop("__value") \
            .withColumn(f"__t_{margin}", F.coalesce(f"__t_{margin}", F.lit(0.0)))
    return cells


def _rake(cells: DataFrame, wanted: dict[str, DataFrame], limit: Column) -> DataFrame:
    """The cells, weights scaled until the smaller of weight and ``limit`` has the sums ``wanted`` (margin, target).

    Weights past the limit count as the limit. What the cells below it add up to is scaled to the rest of the target.
    """
    own = cells.columns
    now = stage_lean(_with_targets(cells, wanted), "raked")
    cut, before = F.col("weight") >= limit, float("inf")
    while True:
        moved = now
        for _ in range(_ROUNDS):
            for margin in wanted:
                values, goal = Window.partitionBy(margin), F.col(f"__t_{margin}")
                given = F.col("__fixed") + F.col("__free")
                rest = goal - F.col("__fixed")
                factor = F.when((rest > 0) & (F.col("__free") > 0), rest / F.col("__free")) \
                    .when(given > goal, goal / given).otherwise(1.0)
                moved = moved.withColumns({
                    "__fixed": F.sum(F.when(cut, limit).otherwise(0.0)).over(values),
                    "__free": F.sum(F.when(cut, 0.0).otherwise(F.col("weight"))).over(values),
                    "__size": F.count("*").over(values)}).withColumns({
                        "weight": F.col("weight") * factor,
                        f"__off_{margin}": F.abs(given - goal) / F.col("__size")}).drop("__fixed", "__free", "__size")
        seen = Observation()
        moved = moved.observe(seen, *(F.sum(f"__off_{m}").alias(m) for m in wanted),
                              F.sum(F.least("weight", limit)).alias("__given"))
        raked = stage_lean(moved.drop(*(f"__off_{m}" for m in wanted)), "raked")
        discard(now)
        now = raked
        # What each margin was off in the last round, before it was scaled.
        error = max((seen.get[m] or 0.0 for m in wanted), default=0.0)
        if error <= TOLERANCE * max(seen.get["__given"] or 0.0, 1.0):
            break
        if error > STALLED * before:
            log.warning("the targets cannot be met together: %.3g of %.3g tokens are off", error, seen.get["__given"])
            break
        before = error
    return now.select(*own)


def cell_weights(cells: DataFrame, temperatures: dict[str, float] = TEMPERATURES, margins: tuple[str, ...] = MARGINS,
                 targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """``cells`` (margins, tokens) with weight: the raked tokens, of the same sum and without limits.

    Targets are those of :func:`_shares`. Cells without tokens have weight 0.
    """
    cells = stage_lean(cells.withColumn("weight", F.col("tokens").cast("double")), "cells")
    total = cells.agg(F.sum("weight")).first()[0] or 0.0
    wanted = {}
    for margin, shares in _shares(cells, temperatures, margins, targets).items():
        scale = total / (shares.agg(F.sum("share")).first()[0] or 1.0)
        wanted[margin] = shares.select(margin, (F.col("share") * scale).alias("target"))
    return _rake(cells, wanted, F.lit(float("inf")))


def cell_tokens(cells: DataFrame, keep_tokens: float, temperatures: dict[str, float] = TEMPERATURES,
                margins: tuple[str, ...] = MARGINS, targets: dict[str, DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """``cells`` (margins, tokens) with given: how many tokens each gives, at most those it has; and the margins.

    The margins are rows of margin, value, asked (its share of the budget), target (as much of it as the value and its
    margin can give) and given: where that is off the target, the margins could not be met together. The budget is the
    part ``keep_tokens`` of all tokens, or what the values with a target hold if that is less.
    """
    cells = stage_lean(cells.withColumn("weight", F.col("tokens").cast("double")), "cells")
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    shares = _shares(cells, temperatures, margins, targets)
    held = {margin: stage_lean(cells.groupBy(margin).agg(F.sum("tokens").alias("tokens")).join(share, margin).select(
        margin, "tokens", F.col("share").alias("weight")), "held") for margin, share in shares.items()}
    budget = min([keep_tokens * total, *((t.where("weight > 0").agg(F.sum("tokens")).first()[0] or 0.0) for t in held.values())])
    wanted, asked = {}, {}
    for margin, table in held.items():
        mine, weights = table.agg(F.sum("tokens"), F.sum("weight")).first()
        factor = factor_for(table, budget / mine) if mine else 0.0
        reach = F.least(F.col("tokens").cast("double"), F.col("weight") * factor)
        wanted[margin] = table.select(margin, reach.alias("target"))
        asked[margin] = table.select(margin, (F.col("weight") * (keep_tokens * total / (weights or 1.0))).alias("asked"),
                                     reach.alias("target"))
    start = cells.withColumn("weight", F.col("weight") * keep_tokens)
    tokens = F.col("tokens").cast("double")
    raked = stage_lean(_rake(start, wanted, tokens).withColumn("given", F.least("weight", tokens)).drop("weight"), "given")
    reached = [raked.groupBy(margin).agg(F.sum("given").alias("given")).join(asked[margin], margin, "left").select(
        F.lit(margin).alias("margin"), F.col(margin).cast("string").alias("value"), F.coalesce("asked", F.lit(0.0)).alias("asked"),
        F.coalesce("target", F.lit(0.0)).alias("target"), "given") for margin in margins]
    reached = stage_lean(reduce(DataFrame.unionByName, reached), "margins")
    discard(cells, *shares.values(), *held.values())
    return raked, reached


def factor_for(cells: DataFrame, keep_tokens: float) -> float:
    """c with sum(min(tokens, c * weight)) = keep_tokens * sum(tokens).

    The sum is concave in c and made of straight pieces: following the present piece to the goal never goes past it, and
    each look fixes what is full by then.
    """
    total, top = cells.where("weight > 0").agg(F.sum("tokens"), F.max(F.col("tokens") / F.col("weight"))).first()
    if not total:
        return 0.0
    goal, c = keep_tokens * (cells.agg(F.sum("tokens")).first()[0] or 0), 0.0
    if goal >= total:
        return float(top)
    tokens = F.col("tokens").cast("double")
    while True:
        full = F.col("weight") * c >= tokens
        fixed, free = cells.where("weight > 0").agg(
            F.sum(F.when(full, tokens).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        reached = (goal - fixed) / free if free > 0 else c
        if reached <= c * (1 + 1e-12):
            return c
        c = reached


def _keyed(docs: DataFrame, topic: Column, seed: int) -> DataFrame:
    """The rows with their cell, tokens and a number in [0, 1) that depends on doc_id, text and seed alone."""
    u = F.shiftrightunsigned(F.xxhash64("doc_id", "text", F.lit(seed)), 11) / float(1 << 53)
    return docs.select(
        *docs.columns, F.coalesce(F.col("source").cast("string"), F.lit("")).alias("__source"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("__lang"), topic.alias("__topic"),
        n_words().alias("__tokens"), u.alias("__u"))


def sample(docs: DataFrame, topic: Column | None = None, keep_tokens: float = KEEP_TOKENS, seed: int = SEED,
           temperatures: dict[str, float] = TEMPERATURES, targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """The sampled rows with topic, n_tokens, probability and weight (1 / probability) added.

    Null sources and languages are values of their own (empty). Documents without words have no tokens to mix and are
    kept with probability 1. Equal doc_ids with equal texts share their fate. Columns of the added names are replaced.
    """
    names = {"topic", "n_tokens", "probability", "weight"}
    topic = form_topic() if topic is None else topic
    own = [c for c in docs.columns if c not in names]
    rows = _keyed(docs, topic, seed)
    cells = rows.groupBy(F.col("__source").alias("source"), F.col("__lang").alias("lang"), F.col("__topic").alias("topic")) \
        .agg(F.sum("__tokens").alias("tokens"))
    raked, reached = cell_tokens(cells, keep_tokens, temperatures, targets=targets)
    short = reached.where(F.col("given") < (1 - SHORT) * F.col("asked"))
    for r in short.orderBy(F.desc(F.col("asked") - F.col("given")), "margin", "value").limit(20).collect():
        log.warning("%s %r gives %.0f of the %.0f tokens of its target", r.margin, r.value, r.given, r.asked)
    chances = stage_lean(raked.select(
        F.col("source").alias("__source"), F.col("lang").alias("__lang"), F.col("topic").alias("__topic"),
        F.when(F.col("tokens") > 0, F.col("given") / F.col("tokens")).otherwise(1.0).alias("__chance")), "chances")
    discard(raked, reached)
    p = F.when(F.col("__tokens") > 0, F.col("__chance")).otherwise(1.0)
    return rows.join(chances, ["__source", "__lang", "__topic"]).where(F.col("__u") < p).select(
        *own, F.col("__topic").alias("topic"), F.col("__tokens").alias("n_tokens"), p.alias("probability"),
        (1 / p).alias("weight"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sampled documents with their probabilities."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source", "lang")
    return sample(docs).drop("text")
