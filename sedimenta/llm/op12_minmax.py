"""Near duplicates by min-max hashing: each permutation of the shingles gives its smallest and its largest value.

A signature keeps both ends of every permutation, so ``2 * permutations`` values cost half the hash evaluations. Each end
agrees between two sets with the probability of their Jaccard similarity, and as the two ends of one permutation rather
disagree together than apart, their mean is unbiased with less variance than that of as many independent minima.

Bands of ``2 * _PER_BAND`` values (both ends of a few permutations) bring sets together; a pair at the threshold is missed
with a chance of 3e-7. Groups of a band are never paired all with all. Every set meets the typical members of its groups
first, and linked sets merge into components. In groups with several components after that, sets are told apart by
their differences from the group's leader (see :func:`_across`) and by their signatures, and what is left is verified.
Links are decided on the full sets of shingles.

Equal sets are one node. Shingles are 64-bit hashes of words, sets are told apart by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .components import connected_components
from .staging import discard, stage_lean
from .text import LOWER, Slice, mix, slices, span_digests, windows, words

WIDTH = 5
SHARE = 85  # percent of the union that linked sets have in common
_BANDS = 32
_PER_BAND = 3  # permutations
_LEADERS = 3  # that a set is verified against in a round
_ROUNDS = 2
_LEAST_LIKENESS = 0.70  # of signatures, six standard errors below the threshold

_KEYS = np.random.default_rng(20250711).integers(1, 1 << 63, (_BANDS * _PER_BAND, 2), dtype=np.uint64)
_ROWS = "row long, doc_id long, version long, n int, digest binary, bands array<long>, ends binary"


def shingle_sets(part: Slice, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of all texts of a slice end to end, and how many each text has."""
    starts, ends, owner = words(part)
    hashes = span_digests(LOWER[part.buf], starts, ends)
    found, at = windows(hashes, owner, width)
    at = owner[at]
    count = np.bincount(owner, minlength=part.n)
    short = np.flatnonzero((count > 0) & (count < width))
    if len(short):  # the whole sequence is one shingle
        first = (np.cumsum(count) - count)[short]
        whole = mix(count[short].astype(np.uint64))
        for k in range(width - 1):
            more = count[short] > k
            whole[more] = mix(whole[more] * np.uint64(3) + hashes[first[more] + k])
        found, at = np.concatenate([found, whole]), np.concatenate([at, short])
    order = np.lexsort((found, at))
    found, at = found[order], at[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (at[1:] != at[:-1])
    return found[new], np.bincount(at[new], minlength=part.n)


def set_digests(items: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """16 bytes for each set; sets without items have none."""
    full = np.flatnonzero(sizes)
    begins = (np.cumsum(sizes) - sizes)[full]
    out = [b""] * len(sizes)
    if len(full):
        n = sizes[full].astype(np.uint64)
        halves = [mix(np.add.reduceat(mix(items ^ np.uint64(key)), begins) + n)
                  for key in (0x51ED270B9A3C4E17, 0xC2B2AE3D27D4EB4F)]
        for k, digest in zip(full.tolist(), np.stack(halves, 1)):
            out[k] = digest.tobytes()
    return out


def minmax(items: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Both ends of every permutation (2, permutations, sets) of sets that all have items."""
    begins = np.cumsum(sizes) - sizes
    out = np.empty((2, len(_KEYS), len(sizes)), np.uint64)
    for k, (factor, add) in enumerate(_KEYS):
        h = items * (factor | np.uint64(1)) + add
        np.minimum.reduceat(h, begins, out=out[0, k])
        np.maximum.reduceat(h, begins, out=out[1, k])
    return out


def band_keys(ends: np.ndarray) -> np.ndarray:
    """(bands, sets): a hash of the values of each band."""
    values = ends.transpose(1, 0, 2).reshape(_BANDS, 2 * _PER_BAND, -1)
    keys = np.repeat(mix(np.arange(1, _BANDS + 1, dtype=np.uint64))[:, None], values.shape[2], 1)
    for k in range(values.shape[1]):
        keys = mix(keys * np.uint64(3) + values[:, k])
    return keys.view(np.int64)


def signatures(docs: DataFrame) -> DataFrame:
    """row (of its own), doc_id, version (hash of the text), set size and digest, band keys, a byte of each end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(3)):
                items, sizes = shingle_sets(part)
                full = np.flatnonzero(sizes)
                bands: list = [None] * part.n
                low: list = [None] * part.n
                if len(full):
                    found = minmax(items, sizes[full])
                    keys = np.ascontiguousarray(band_keys(found).T)
                    bytes_of = np.ascontiguousarray((mix(found) & np.uint64(255)).astype(np.uint8).reshape(-1, len(full)).T)
                    for at, key, ends in zip(full.tolist(), keys, bytes_of):
                        bands[at], low[at] = key, ends.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(part.lo, part.n) for k in range(3)), pa.array(sizes, pa.int32()),
                     pa.array(set_digests(items, sizes), pa.binary()), pa.array(bands, pa.list_(pa.int64())),
                     pa.array(low, pa.binary())],
                    ["row", "doc_id", "version", "n", "digest", "bands", "ends"])

    return docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64("text").alias("version"), "text").mapInArrow(run, _ROWS)


def _whole_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """id and sorted shingles of the ``wanted`` sets (id, doc_id, version), from one document of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(1)):
                items, sizes = shingle_sets(part)
                cuts = np.cumsum(sizes)
                sets = [items[b - n : b].tobytes() for b, n in zip(cuts.tolist(), sizes.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.lo, part.n), pa.array(sets, pa.binary())], ["id", "items"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("version"), "text")
    of = wanted.select("id", F.col("doc_id").alias("of"), F.col("version").alias("as"))
    return texts.join(of, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("version") == F.col("as"))) \
        .select("id", "text").mapInArrow(run, "id long, items binary").dropDuplicates(["id"])


def _verified(pairs: DataFrame, whole: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column(2), batch.column(3)
            keep = []
            for k in range(batch.num_rows):
                both = np.concatenate([np.frombuffer(c[k].as_buffer(), np.uint64) for c in (x, y)])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= SHARE * (len(both) - common))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = whole.select(F.col("id").alias("a"), F.col("items").alias("x"))
    right = whole.select(F.col("id").alias("b"), F.col("items").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _alike(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose signatures agree in the mean of both ends' share at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(c.to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in batch.columns[2:])
            share = (x == y).mean(1) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(share >= _LEAST_LIKENESS))

    one, two = (sets.select(F.col("id").alias(name), F.col("ends").alias(as_)) for name, as_ in (("a", "x"), ("b", "y")))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _fits(n, m):
    """Whether sets of these sizes can be similar enough."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * SHARE


def _component(of: str, parts: DataFrame, name: str) -> DataFrame:
    return parts.select(F.col("node").alias(of), F.col("component").alias(name))


def _merged(parts: DataFrame | None, links: DataFrame) -> DataFrame:
    """node, component after more links."""
    if parts is None:
        return stage_lean(connected_components(links), "components")
    kept = parts.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    return stage_lean(connected_components(links.unionByName(kept)), "components")


def _led(shared: DataFrame, turn: int) -> DataFrame:
    """key, lead, m: the typical member of each group, the one with most company in all its groups, or just any."""
    order = F.xxhash64("id", "key") if turn % 2 else F.struct("company", "id")
    leader = shared.groupBy("key").agg(F.max_by(F.struct(F.col("id").alias("lead"), F.col("n").alias("m")), order).alias("l"))
    return leader.select("key", "l.lead", "l.m")


def _met_leaders(shared: DataFrame, turn: int, parts: DataFrame | None) -> DataFrame:
    """Pairs (a, b): each set with the leaders of its groups it shares most with, if not of its component already."""
    pairs = shared.join(_led(shared, turn), "key").select("id", "n", "lead", "m") \
        .where((F.col("id") != F.col("lead")) & _fits(F.col("n"), F.col("m")))
    if parts is not None:
        pairs = pairs.join(_component("id", parts, "ca"), "id", "left").join(_component("lead", parts, "cb"), "lead", "left") \
            .where(F.coalesce("ca", "id") != F.coalesce("cb", "lead"))
    common = pairs.groupBy("id", "lead").agg(F.count("*").alias("common"))
    best = Window.partitionBy("id").orderBy(F.desc("common"), "lead")
    near = common.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= _LEADERS)
    return near.select(F.least("id", "lead").alias("a"), F.greatest("id", "lead").alias("b")).distinct()


def _mixed(shared: DataFrame, parts: DataFrame) -> DataFrame:
    """The rows of groups with several components."""
    at = _in_parts(shared, parts)
    return at.join(at.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low <> high").select("key"), "key") \
        .drop("c")


def _in_parts(rows: DataFrame, parts: DataFrame, of: str = "id", name: str = "c") -> DataFrame:
    return rows.join(_component(of, parts, name), of, "left").withColumn(name, F.coalesce(name, of))


def _differences(met: DataFrame, whole: DataFrame) -> DataFrame:
    """lead, id, m, n and the shingles that one of both sets has alone, of each (lead, id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column(2), batch.column(3)
            sets = [(np.frombuffer(x[k].as_buffer(), np.uint64), np.frombuffer(y[k].as_buffer(), np.uint64)) for k in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array([len(pair[k]) for pair in sets], pa.int64()) for k in (0, 1)),
                 pa.array([np.setxor1d(*pair, assume_unique=True).view(np.int64) for pair in sets], pa.list_(pa.int64()))],
                ["lead", "id", "m", "n", "alone"])

    left = whole.select(F.col("id").alias("lead"), F.col("items").alias("x"))
    right = whole.select("id", F.col("items").alias("y"))
    return met.join(left, "lead").join(right, "id").select("lead", "id", "x", "y").mapInArrow(
        run, "lead long, id long, m long, n long, alone array<long>")


def _at_home(apart: DataFrame) -> DataFrame:
    """The rows with their set's home: of its leaders, itself if it is one, that with most sets. Leaders all of whose sets
    are together at another home are left out."""
    led = apart.groupBy("lead").agg(F.count("*").alias("size"))
    choices = apart.select("id", "lead").join(led, "lead").unionByName(led.select(F.col("lead").alias("id"), "lead", "size"))
    home = choices.groupBy("id").agg(F.max_by("lead", F.struct("size", "lead")).alias("home"))
    rows = apart.join(home, "id")
    needed = rows.groupBy("lead").agg(F.min("home").alias("low"), F.max("home").alias("high")).where("low <> high or low = lead")
    return rows.join(needed.select("lead"), "lead")


def _across(apart: DataFrame, parts: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets under one leader and of different components that may be linked.

    With d(x) shingles between a set and its leader, two sets have at least (d(x) + d(y) - limit) / 2 of these in common
    if they differ in no more than ``limit``. Of two components one is not the leader's, and its sets are farther from
    the leader than the limit; so the other set has more than about half its own shingles in common with them, and one
    among its rarest. Only these are indexed: what near copies have changed each for itself meets nothing.

    Sets that are together under several leaders meet under the one with most sets, their home, alone.
    """
    d = F.size("alone").cast("long")
    rows = _at_home(apart)
    rows = _in_parts(_in_parts(rows, parts), parts, "lead", "cl").withColumn("d", d).withColumn(
        "far", (100 + SHARE) * F.col("d") - (100 - SHARE) * F.col("n")).withColumn("other", F.col("c") != F.col("cl"))
    nearest = rows.where("other").groupBy("lead").agg(F.min("far").alias("nearest"))
    shared = F.greatest(F.lit(1), F.ceil((F.col("nearest") + F.col("far")) / (2 * (100 + SHARE))))
    each = stage_lean(rows.join(nearest, "lead").select(
        "lead", "id", "home", "n", "c", "other", "d", "far", (F.col("d") - shared + 1).alias("looked"), F.explode("alone").alias("x")), "alone")
    held = each.groupBy("lead", "x", "c").agg(F.count("*").alias("k")).groupBy("lead", "x").agg(
        F.sum("k").alias("holders"), F.count("*").alias("kinds"), F.max_by("c", F.struct("k", "c")).alias("main"))
    rarest = Window.partitionBy("lead", "id").orderBy("holders", "x")
    counted = each.join(held, ["lead", "x"]).withColumn("rank", F.row_number().over(rarest)).where("kinds > 1")

    def named(rows: DataFrame, side: str) -> DataFrame:
        return rows.select("lead", "x", "main", *(F.col(c).alias(f"{c}_{side}") for c in ("id", "home", "n", "c", "d", "far", "rank")))

    counted = stage_lean(counted.where("other or rank <= looked"), "counted")
    index, seek = named(counted.where("rank <= looked"), "b"), named(counted.where("other"), "a")
    # The first shingle in common, by rarity, leaves as many in both sets as they must share.
    in_common = F.greatest(F.lit(1), F.ceil((F.col("far_a") + F.col("far_b")) / (2 * (100 + SHARE)))) - 1
    close = (F.col("c_a") != F.col("c_b")) & ((F.col("home_a") != F.col("home_b")) | (F.col("home_a") == F.col("lead"))) \
        & _fits(F.col("n_a"), F.col("n_b")) & (F.col("d_a") - F.col("rank_a") >= in_common) & (F.col("d_b") - F.col("rank_b") >= in_common)

    def meet(one: DataFrame, other: DataFrame) -> DataFrame:
        return one.drop("main").join(other.drop("main"), ["lead", "x"]).where(close).select(
            F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b"))

    return meet(seek.where("c_a <> main"), index).unionByName(meet(seek.where("c_a = main"), index.where("c_b <> main"))).distinct()


def set_components(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """node, component of every set linked to another. ``sets``: id, n, doc_id, version, bands, ends."""
    keyed = sets.select("id", "n", F.explode("bands").alias("key"))
    several = keyed.groupBy("key").agg(F.count("*").alias("held")).where("held > 1")
    met = stage_lean(keyed.join(several, "key"), "met-in-bands")
    shared = stage_lean(met.join(met.groupBy("id").agg(F.sum("held").alias("company")), "id").drop("held"), "shared-bands")
    discard(met)
    wanted = sets.join(shared.select("id").distinct(), "id", "left_semi")
    whole = stage_lean(_whole_sets(docs, wanted.select("id", "doc_id", "version")), "whole-sets")
    parts = None
    for turn in range(_ROUNDS):
        links = stage_lean(_verified(_met_leaders(shared, turn, parts), whole), "leader-links")
        parts = _merged(parts, links)
        discard(links)
    # What is left are groups of several components: all their sets by their difference from the group's leader.
    mixed = stage_lean(_mixed(shared, parts), "mixed")
    met = mixed.join(_led(mixed, 0), "key").where("id <> lead").select("lead", "id").distinct()
    apart = stage_lean(_differences(met, whole), "differences")
    size, common = F.col("n") + F.col("m"), F.size("alone")
    linked = apart.where(100 * (size - common) >= SHARE * (size + common)).select(F.col("lead").alias("a"), F.col("id").alias("b"))
    parts = _merged(parts, linked)
    rest = stage_lean(_alike(_across(apart, parts), sets), "other-pairs")
    links = stage_lean(_verified(rest, whole), "other-links")
    merged = _merged(parts, links)
    discard(shared, whole, mixed, apart, rest, links, parts)
    return merged


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs`` (doc_id, text).

    Words are lower-cased in ASCII; a text with fewer than five is one shingle, one without words (empty, null) has none
    and links with nothing. Rows count one by one, also those that repeat a doc_id. component_id is the smallest doc_id
    reachable by links; a null doc_id is never the smallest unless it is alone. kept: the row's doc_id is component_id.
    """
    rows = stage_lean(signatures(docs), "minmax-rows")
    sets = stage_lean(
        rows.where("n > 0").groupBy("digest").agg(
            F.min("row").alias("id"), F.first("n").alias("n"), F.min_by(F.struct("doc_id", "version"), "row").alias("of"),
            F.min("doc_id").alias("first"), F.any_value("bands").alias("bands"), F.any_value("ends").alias("ends"))
        .select("digest", "id", "n", "of.doc_id", "of.version", "first", "bands", "ends"), "minmax-sets")
    parts = set_components(docs, sets)
    at = sets.select("digest", "id", "first").join(_component("id", parts, "c"), "id", "left").withColumn("c", F.coalesce("c", "id"))
    smallest = at.groupBy("c").agg(F.min("first").alias("component_id"))
    named = at.join(smallest, "c").select("digest", "component_id")
    found = rows.select("doc_id", "n", "digest").join(named, "digest", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op12_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all ``documents`` by min-max hashing, and which document of each stays."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
