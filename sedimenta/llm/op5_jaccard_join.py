"""Exact Jaccard self-join on word shingles by partitions of the universe and the pigeonhole principle.

Sets of n and m shingles with similarity of at least 0.8 differ in at most (n + m) / 9. Sizes fall into bands that
double. A band hashes the shingles into ``segments(band)`` segments, more than sets of the band may differ in: so two
similar sets agree on whole segments. A set is indexed by the hash of each of its segments in its own band; it looks
for sets of its size or smaller there and, if near the band's lower end, in the band below.

* Cost-based allocation: a set that looks for partners with difference H needs H + 1 of its segments. Segments nobody
  else has count and cost nothing, then those with fewest other holders are taken. Most sets without a near copy need
  nothing else, and frequent passages are never looked up while something rarer will do.
* One-deletion neighbourhoods: small sets have few segments, so there a segment may also count twice, when it is
  looked up with one shingle more or less.
* Candidates are verified on the whole sets.

Equal sets are one node. Groups that share a segment are never paired all with all: every set is first verified
against the typical sets it shares most with, and linked sets merge. After that only sets of different components are
compared, inside the join by sketches that bound the difference from below, and what passes is verified.

That is all components need. Where every pair is asked for, every two sets that meet at a segment are compared in that
way, also those of one component, so the comparisons grow with the links there are.

Where each set's links are only counted, sets that link to one leader with many others have their home there. Two sets
of one home differ in what only one of both differs from the leader in, so links at home are counted from these few
shingles: sets within half the limit of the leader link to each other without a comparison, sets that differ from it
alike, as far as others do so too, count as one, and the rest meet in blocks as matrix products, which give sums and
not pairs. Only pairs that are not of one home are compared by segments.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import connected_components
from .staging import discard, stage_lean
from .text import LOWER, Slice, mix, slices, span_digests, tidy, windows, words

WIDTH = 5
_SMALL = 4  # sets with fewer shingles differ from similar ones in nothing
_DELETIONS_TO = 32  # sets below have their one-deletion neighbourhoods indexed
_STAR_ROUNDS = 2
_LEADERS = 3  # that a set is verified against in each round
_HOT = 32  # sets that share a segment, or a home, from which on their links are not listed
_HOME_ROUNDS = 3
_BLOCK = 1024  # classes of sets in a matrix


def _flat_shingles(part: Slice, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of the texts of a slice end to end, and how many each text has."""
    starts, ends, owner = words(part)
    hashes = span_digests(LOWER[part.buf], starts, ends)
    found, at = windows(hashes, owner, width)
    at = owner[at]
    count = np.bincount(owner, minlength=part.n)
    short = np.flatnonzero((count > 0) & (count < width))
    if len(short):  # fewer words: the whole sequence is one shingle
        first = np.cumsum(count) - count
        whole = []
        for k in short.tolist():
            h = np.array([count[k]], np.uint64)
            for at_word in range(first[k], first[k] + count[k]):
                h = mix(h * np.uint64(3) + hashes[at_word : at_word + 1])
            whole.append(h[0])
        found, at = np.concatenate([found, np.array(whole, np.uint64)]), np.concatenate([at, short])
        order = np.argsort(at, kind="stable")
        found, at = found[order], at[order]
    for one in np.split(found, np.searchsorted(at, np.arange(1, part.n))):
        one.sort()  # a view, sorted in place
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (at[1:] != at[:-1])
    return found[new], np.bincount(at[new], minlength=part.n)


def shingles(part: Slice, width: int = WIDTH) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a slice."""
    found, sizes = _flat_shingles(part, width)
    return np.split(found, np.cumsum(sizes)[:-1])


def set_id(items: np.ndarray) -> int:
    """A 64-bit name of a set."""
    with np.errstate(over="ignore"):
        total = np.add.reduce(mix(items + np.uint64(0x51ED270B)), dtype=np.uint64) + np.uint64(len(items))
    return int(mix(np.array([total], np.uint64)).view(np.int64)[0])


def _set_ids(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """:func:`set_id` of sets that lie end to end, 0 for an empty one."""
    ids, some = np.zeros(len(sizes), np.int64), np.flatnonzero(sizes)
    if len(some):
        sums = np.add.reduceat(mix(flat + np.uint64(0x51ED270B)), (np.cumsum(sizes) - sizes)[some])
        ids[some] = mix(sums + sizes[some].astype(np.uint64)).view(np.int64)
    return ids


def band(n: int) -> int:
    return n.bit_length() - 1


def segments(b: int) -> int:
    """Segments of a band: what two of its sets may differ in and one, an eighth more, and two."""
    most = 2 * ((2 << b) - 1) // 9 + 1
    return most + -(-most * 3 // 20) + 2


def segment_sums(items: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """The segment of each shingle, and the sum over each segment."""
    m = segments(b)
    spread = mix(items ^ np.uint64(0xA0761D6478BD642F))
    at = (((spread >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)).astype(np.int64)
    sums = np.zeros(m, np.uint64)
    np.add.at(sums, at, mix(spread))
    return at, sums


def _key(sums: np.ndarray, at: np.ndarray, b: int, kind: int) -> np.ndarray:
    salt = at.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1 + 2 * b + 1024 * kind)
    return mix(sums ^ mix(salt)).view(np.int64)


def _segment_keys(flat: np.ndarray, sizes: np.ndarray, bands: np.ndarray, wanted: np.ndarray) -> pa.Array:
    """The keys of all segments of each wanted set in the band given for it, null for other sets; sets lie end to end."""
    counts = np.where(wanted, np.array([segments(b) for b in range(64)])[bands], 0)
    first = np.cumsum(counts) - counts
    kept = np.repeat(wanted, sizes)
    spread = mix(flat[kept] ^ np.uint64(0xA0761D6478BD642F))
    inside, some = np.where(wanted, sizes, 0), np.repeat(counts, counts)
    at = ((spread >> np.uint64(32)) * np.repeat(counts, inside).astype(np.uint64)) >> np.uint64(32)
    sums = np.zeros(len(some), np.uint64)
    np.add.at(sums, np.repeat(first, inside) + at.astype(np.int64), mix(spread))
    segment = np.arange(len(some)) - np.repeat(first, counts)
    salt = segment.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.repeat(1 + 2 * bands, counts).astype(np.uint64)
    keys = mix(sums ^ mix(salt)).view(np.int64)
    return pa.ListArray.from_arrays(
        pa.array(np.append(first, len(some)), pa.int32()), pa.array(keys, pa.int64()), mask=pa.array(~wanted))


_NEAR = pa.list_(pa.struct([("key", pa.int64()), ("seg", pa.int32()), ("role", pa.int32())]))
_SETS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("version", T.LongType()), T.StructField("id", T.LongType()),
    T.StructField("n", T.IntegerType()),
    T.StructField("own", T.ArrayType(T.LongType())), T.StructField("lower", T.ArrayType(T.LongType())),
    T.StructField("near", T.ArrayType(T.StructType([
        T.StructField("key", T.LongType()), T.StructField("seg", T.IntegerType()), T.StructField("role", T.IntegerType())])))])
#: Roles of one-deletion rows: indexed with one shingle less; looked up with one less; looked up among those with one less.
_INDEXED, _ONE_LESS, _ONE_MORE = 0, 1, 2


def _neighbourhood(items: np.ndarray, b: int, role_indexed: bool) -> list[dict]:
    at, sums = segment_sums(items, b)
    less = sums[at] - mix(mix(items ^ np.uint64(0xA0761D6478BD642F)))
    rows = []
    if role_indexed:
        rows += [(k, s, _INDEXED) for k, s in zip(_key(less, at, b, 1).tolist(), at.tolist())]
    rows += [(k, s, _ONE_LESS) for k, s in zip(_key(less, at, b, 0).tolist(), at.tolist())]
    every = np.arange(len(sums))
    rows += [(k, s, _ONE_MORE) for k, s in zip(_key(sums, every, b, 1).tolist(), every.tolist())]
    return [{"key": k, "seg": s, "role": r} for k, s, r in rows]


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, hash of the text (version), id and size of the set, and its segment keys (null where the task has given
    them for an equal set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[int] = set()
        for batch in batches:
            for part in slices(batch.column(2)):
                flat, sizes = _flat_shingles(part)
                ids = _set_ids(flat, sizes)
                wanted = np.zeros(part.n, bool)
                for k in np.flatnonzero(sizes >= _SMALL).tolist():
                    name = int(ids[k])
                    wanted[k] = name not in given
                    given.add(name)
                bands = np.array([band(n) if n else 0 for n in sizes.tolist()], np.int64)
                lower = wanted & (bands > band(_SMALL)) & (4 * sizes < 5 << bands)
                near, first = [None] * part.n, np.cumsum(sizes) - sizes
                for k in np.flatnonzero(wanted & ((sizes < _DELETIONS_TO) | lower & (1 << bands <= _DELETIONS_TO))).tolist():
                    items, b = flat[first[k] : first[k] + sizes[k]], int(bands[k])
                    rows = _neighbourhood(items, b, True) if sizes[k] < _DELETIONS_TO else []
                    if lower[k]:
                        # Segments of the band below carry negative numbers.
                        rows += [r | {"seg": -1 - r["seg"]} for r in _neighbourhood(items, b - 1, False)]
                    near[k] = rows
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.lo, part.n), batch.column(1).slice(part.lo, part.n), pa.array(ids, pa.int64()),
                     pa.array(sizes, pa.int32()), _segment_keys(flat, sizes, bands, wanted),
                     _segment_keys(flat, sizes, np.maximum(bands - 1, 0), lower), pa.array(near, _NEAR)],
                    _SETS.names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("version"), "text") \
        .mapInArrow(tidy(run), _SETS)


def _rows(sets: DataFrame) -> DataFrame:
    """id, key and info: how large the set is, of which segment the key is and what it is for, packed (see _unpack)."""

    def packed(seg, low, step, indexed):
        return (F.shiftleft(F.col("n").cast("long"), 32) + F.shiftleft(seg.cast("long"), 4)
                + 8 * low.cast("long") + 2 * step.cast("long") + indexed.cast("long")).alias("info")

    def whole(column: str, low: bool):
        return sets.where(f"{column} is not null").select("id", "n", F.posexplode(column).alias("seg", "key")).select(
            "id", "key", packed(F.col("seg"), F.lit(low), F.lit(0), F.lit(not low)))

    role = F.col("x.role")
    near = sets.where("near is not null").select("id", "n", F.explode("near").alias("x")).select(
        "id", F.col("x.key").alias("key"),
        packed(F.when(F.col("x.seg") < 0, -1 - F.col("x.seg")).otherwise(F.col("x.seg")), F.col("x.seg") < 0,
               F.when(role == _INDEXED, 2).otherwise(1), role == _INDEXED))
    return whole("own", False).unionByName(whole("lower", True)).unionByName(near)


def _unpack(rows: DataFrame) -> DataFrame:
    """id, key, holders, n, seg, low (looked up in the band below), step, indexed.

    Step 0 is a whole segment, 1 a look-up with one deletion, 2 an indexed deletion.
    """
    info = F.col("info")
    return rows.select(
        "id", "key", "holders", F.shiftright(info, 32).cast("int").alias("n"),
        F.shiftright(info.bitwiseAND(0xFFFFFFFF), 4).cast("int").alias("seg"), (info.bitwiseAND(8) > 0).alias("low"),
        F.shiftright(info.bitwiseAND(6), 1).cast("int").alias("step"), (info.bitwiseAND(1) > 0).alias("indexed"))


def _band():
    return F.floor(F.log2(F.col("n") + 0.5)).cast("int")


def _allocate(shared: DataFrame) -> DataFrame:
    """id, n, low, key: the segments each set looks up. ``shared`` are its rows whose key others have too."""
    end = F.call_function("shiftleft", F.lit(1), _band()) - 1
    in_band = F.when(F.col("low"), _band() - 1).otherwise(_band())
    most = F.floor((2 * F.call_function("shiftleft", F.lit(2), in_band) - 2) / 9).cast("int") + 1
    m = most + F.ceil(most * 3 / 20).cast("int") + 2
    needed = F.floor((F.col("n") + F.when(F.col("low"), end).otherwise(F.col("n"))) / 9).cast("int") + 1
    near = F.call_function("shiftleft", F.lit(2), in_band) <= _DELETIONS_TO
    by_set = Window.partitionBy("id", "low")
    # In larger bands a segment has one key, which costs its holders. A set that several tasks gave has equal rows.
    ranked = shared.where((F.col("step") == 0) & ~near).withColumn("rank", F.dense_rank().over(by_set.orderBy("holders", "seg"))) \
        .withColumn("dear", F.max("rank").over(by_set))
    large = ranked.where(F.col("rank") <= needed - (m - F.col("dear"))).select("id", "n", "low", "key").distinct()
    looked = shared.where((F.col("step") < 2) & near)
    cost = looked.groupBy("id", "n", "low", "seg").agg(
        F.coalesce(F.sum(F.when(F.col("step") == 0, F.col("holders"))), F.lit(0)).alias("c0"),
        F.coalesce(F.sum(F.when(F.col("step") == 1, F.col("holders"))), F.lit(0)).alias("c1"))
    # A segment counts twice only if it is looked up whole as well, so the second time costs no less than the first.
    steps = cost.select("id", "n", "low", "seg", F.explode(F.array(
        F.struct(F.lit(0).alias("step"), F.col("c0").alias("cost")),
        F.struct(F.lit(1).alias("step"), F.greatest("c0", "c1").alias("cost")))).alias("x")) \
        .select("id", "n", "low", "seg", "x.*").where("cost > 0")
    ranked = steps.select("*", F.row_number().over(by_set.orderBy("cost", "step", "seg")).alias("rank"),
                          F.count("*").over(by_set).alias("dear"))
    chosen = ranked.where(F.col("rank") <= needed - (2 * m - F.col("dear"))).select("id", "low", "step", "seg")
    return large.unionByName(looked.join(chosen, ["id", "low", "step", "seg"]).select("id", "n", "low", "key").distinct())


def _fits(n, m):
    """Whether a set of ``m`` shingles, no more than ``n``, can be similar to one of ``n``."""
    return (m <= n) & (5 * m >= 4 * n)


def odd_sketch(items: np.ndarray, b: int) -> np.ndarray:
    """Bits of a set, each the parity of the shingles that fall on it: 4 to 8 bits a shingle of the band, 4096 at most.

    The bits in which two sketches differ are no more than the shingles in which the sets differ.
    """
    power = min(max(b + 3, 6), 12)
    at = (mix(items ^ np.uint64(0x8EBC6AF09C88C6E3)) >> np.uint64(64 - power)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=1 << power) & 1).astype(np.uint8)).view(np.int64)


def _whole_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """id, its sorted shingle hashes and odd sketches, for one document (doc_id, version) of each wanted set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(1)):
                found = shingles(part)
                odd = [odd_sketch(x, band(max(len(x), 1))) for x in found]
                lower = [odd_sketch(x, band(max(len(x), 2)) - 1) for x in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([set_id(x) for x in found], pa.int64()), pa.array([x.tobytes() for x in found], pa.binary()),
                     pa.array(odd, pa.list_(pa.int64())), pa.array(lower, pa.list_(pa.int64()))],
                    ["id", "items", "odd", "odd_lower"])

    wanted = wanted.select(F.col("doc_id").alias("of"), F.col("version").alias("as"))
    some = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("version"), "text").join(
        wanted, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("version") == F.col("as")), "left_semi")
    return some.select("doc_id", "text").mapInArrow(
        tidy(run), "id long, items binary, odd array<long>, odd_lower array<long>").dropDuplicates(["id"])


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose sets are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column(2), batch.column(3)
            keep = []
            for k in range(batch.num_rows):
                one, two = (np.frombuffer(c[k].as_buffer(), np.uint64) for c in (x, y))
                both = np.concatenate([one, two])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= 80 * (len(both) - common))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("id").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("items").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(tidy(run), "a long, b long")


def _merge(parts: DataFrame | None, links: DataFrame) -> DataFrame:
    """id, component after the links; ids without a link are left out."""
    if parts is None:
        return connected_components(links).withColumnRenamed("node", "id")
    at = parts.select(F.col("id").alias("a"), F.col("component").alias("ca"))
    bt = parts.select(F.col("id").alias("b"), F.col("component").alias("cb"))
    joined = links.join(at, "a", "left").join(bt, "b", "left").select(
        F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    new = stage_lean(connected_components(joined), "merged")
    moved = parts.join(new.select(F.col("node").alias("component"), F.col("component").alias("to")), "component", "left") \
        .select("id", F.coalesce("to", "component").alias("component"))
    added = new.select(F.col("node").alias("id"), "component").join(parts, "id", "left_anti")
    return moved.unionByName(added)


def _indexed(docs: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The segments looked up, those held, and the whole sets of both. ``sets`` is staged, and gone afterwards."""
    # Counted where they meet: rows are dealt by key once, and most keys have one.
    holders = F.count("*").over(Window.partitionBy("key"))
    packed = stage_lean(_rows(sets).withColumn("holders", holders).where("holders > 1"), "shared-segments")
    text = F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "version")).alias("x")
    names = stage_lean(sets.groupBy("id").agg(text).select("id", "x.doc_id", "x.version"), "set-names")
    discard(sets)
    shared = _unpack(packed)
    looked = stage_lean(_allocate(shared), "looked-up")
    # Copies with few changes have the segments that most others have.
    typical = shared.where("step = 0 and indexed").groupBy(F.col("id").alias("b")).agg(F.sum("holders").alias("typical"))
    index = stage_lean(
        shared.where("indexed").select("key", F.col("id").alias("b"), F.col("n").alias("m")).join(
            looked.select("key").distinct(), "key", "left_semi").distinct().join(typical, "b", "left")
        .select("key", "b", "m", F.coalesce("typical", F.lit(0)).alias("typical")), "index")
    discard(packed)
    wanted = looked.select("id").union(index.select(F.col("b").alias("id"))).distinct()
    first = names.join(wanted, "id", "left_semi").select("doc_id", "version")
    return looked, index, stage_lean(_whole_sets(docs, first), "whole-sets")


def set_links(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b (a < b) of every two similar sets. ``sets`` is staged, and gone afterwards."""
    looked, index, whole = _indexed(docs, sets)
    seek, held = _sketched(looked, index.drop("typical"), whole)
    pairs = _meet(stage_lean(seek, "seekers"), stage_lean(held, "held"), _close())
    return stage_lean(_verified(stage_lean(_unordered(pairs), "pairs"), whole), "links")


def set_components(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """id, component for every set linked to another one. ``sets`` is staged, and gone afterwards."""
    looked, index, whole = _indexed(docs, sets)
    done, parts = [], None
    for turn in range(_STAR_ROUNDS):
        # A group's leader is its most typical set, or any. Of all its leaders a set takes those it shares most with.
        order = F.xxhash64("b", "key", F.lit(turn)) if turn % 2 else F.struct("typical", "b")
        leader = index.groupBy("key").agg(F.max_by(F.struct("b", "m"), order).alias("leader"))
        pairs = looked.join(leader, "key").select("id", "n", "leader.b", "leader.m").where("id <> b") \
            .where(_fits(F.col("n"), F.col("m")) | _fits(F.col("m"), F.col("n")))
        if parts is not None:
            pairs = _apart(pairs, parts)
        common = pairs.groupBy("id", "b").agg(F.count("*").alias("common"))
        best = common.withColumn("rank", F.row_number().over(Window.partitionBy("id").orderBy(F.desc("common"), "b"))) \
            .where(F.col("rank") <= _LEADERS)
        pairs = stage_lean(best.select(F.least("id", "b").alias("a"), F.greatest("id", "b").alias("b")).distinct(), "star-pairs")
        done.append(pairs)
        parts = stage_lean(_merge(parts, stage_lean(_verified(pairs, whole), "star-links")), "components")
    pairs = _remaining(looked, index, parts, whole)
    for before in done:
        pairs = pairs.join(before, ["a", "b"], "left_anti")
    links = stage_lean(_verified(stage_lean(pairs, "other-pairs"), whole), "other-links")
    return stage_lean(_merge(parts, links), "components")


def _apart(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """Pairs (id, b) that are not in one component yet."""
    one = parts.select("id", F.col("component").alias("ca"))
    two = parts.select(F.col("id").alias("b"), F.col("component").alias("cb"))
    return pairs.join(one, "id", "left").join(two, "b", "left") \
        .where(F.coalesce("ca", "id") != F.coalesce("cb", "b")).drop("ca", "cb")


def _with_component(rows: DataFrame, parts: DataFrame, column: str) -> DataFrame:
    return rows.join(parts.select(F.col("id").alias(column), F.col("component").alias("c")), column, "left") \
        .withColumn("c", F.coalesce("c", column))


def _mixed(looked: DataFrame, index: DataFrame, parts: DataFrame) -> DataFrame:
    """key, main: groups with more than one component, and the one with most sets there."""
    each = _with_component(looked.select("key", "id"), parts, "id").select("key", "c").union(
        _with_component(index.select("key", "b"), parts, "b").select("key", "c")).groupBy("key", "c").agg(F.count("*").alias("n"))
    return each.groupBy("key").agg(F.count("*").alias("kinds"), F.max_by("c", F.struct("n", "c")).alias("main")) \
        .where("kinds > 1").select("key", "main")


def _sketched(looked: DataFrame, index: DataFrame, whole: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with their odd sketches x and y."""
    own, lower = whole.select("id", F.col("odd").alias("x")), whole.select("id", F.col("odd_lower").alias("z"))
    seek = looked.join(own, "id").join(lower, "id").withColumn("x", F.when(F.col("low"), F.col("z")).otherwise(F.col("x"))).drop("z")
    return seek, index.join(own.withColumnsRenamed({"id": "b", "x": "y"}), "b")


def _close():
    """Whether two sets may be similar: their sizes fit, and no more bits of their sketches differ than shingles may."""
    bits = F.aggregate(F.zip_with("x", "y", lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda p, q: p + q)
    return (F.col("id") != F.col("b")) & _fits(F.col("n"), F.col("m")) & (bits <= F.floor((F.col("n") + F.col("m")) / 9))


def _meet(seek: DataFrame, held: DataFrame, close) -> DataFrame:
    held = held.withColumnRenamed("key", "held_key")
    return seek.join(held, (F.col("key") == F.col("held_key")) & close).select("id", "b")


def _unordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("id", "b").alias("a"), F.greatest("id", "b").alias("b")).distinct()


def _remaining(looked: DataFrame, index: DataFrame, parts: DataFrame, whole: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components where one looks up a segment of the other.

    In each group most sets are of one component by now: only the others meet everyone, and inside the join the odd
    sketches of two sets tell at once that they differ in too much: as many bits differ as shingles at most.
    """
    main = stage_lean(_mixed(looked, index, parts), "mixed")
    seek = _with_component(looked, parts, "id").withColumnRenamed("c", "ca").join(main, "key")
    held = _with_component(index.drop("typical"), parts, "b").withColumnRenamed("c", "cb").join(main, "key")
    seek, held = _sketched(seek, held, whole)
    seek, held = stage_lean(seek, "seekers"), stage_lean(held, "held")
    close = (F.col("ca") != F.col("cb")) & _close()

    def meet(one: DataFrame, other: DataFrame) -> DataFrame:
        return _meet(one.drop("main"), other.drop("main"), close)

    return _unordered(meet(seek.where("ca <> main"), held).unionByName(
        meet(seek.where("ca = main"), held.where("cb <> main"))))


def _linked_to(met: DataFrame, whole: DataFrame) -> DataFrame:
    """Those of (lead, id) that are similar: with margin, how far the set is from half the limit (n less nine times the
    number of differences), and the shingles that one of both has alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lead, ids, margins, alone = [], [], [], []
            for k in range(batch.num_rows):
                one, two = (np.frombuffer(batch.column(c)[k].as_buffer(), np.uint64) for c in (2, 3))
                differ = np.setxor1d(one, two, assume_unique=True)
                if 9 * len(differ) <= len(one) + len(two):
                    lead.append(batch.column(0)[k].as_py())
                    ids.append(batch.column(1)[k].as_py())
                    margins.append(len(two) - 9 * len(differ))
                    alone.append(differ.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(lead, pa.int64()), pa.array(ids, pa.int64()), pa.array(margins, pa.int64()),
                 pa.array(alone, pa.list_(pa.int64()))], ["lead", "id", "margin", "alone"])

    left = whole.select(F.col("id").alias("lead"), F.col("items").alias("x"))
    right = whole.select("id", F.col("items").alias("y"))
    return met.join(left, "lead").join(right, "id").select("lead", "id", "x", "y").mapInArrow(
        tidy(run), "lead long, id long, margin long, alone array<long>")


def _homes(looked: DataFrame, index: DataFrame, whole: DataFrame) -> DataFrame:
    """id, home, margin and alone (see :func:`_linked_to`) of the sets that link to one leader, their home, with at least
    ``_HOT`` others. Only groups with more sets than that are looked at; of its leaders a set takes that with most sets."""
    rows = index.select("key", F.col("b").alias("id"), F.col("m").alias("n"), "typical").unionByName(
        looked.select("key", "id", "n", F.lit(-1).cast("long").alias("typical")))
    many = index.groupBy("key").agg(F.count("*").alias("held")).where(F.col("held") > _HOT).select("key")
    hot = stage_lean(rows.join(many, "key").groupBy("key", "id", "n").agg(F.max("typical").alias("typical")), "hot-rows")
    homes = None
    for turn in range(_HOME_ROUNDS):
        left = hot if homes is None else hot.join(homes.select("id"), "id", "left_anti")
        order = F.xxhash64("id", "key", F.lit(turn)) if turn else F.struct("typical", "id")
        leader = stage_lean(
            left.groupBy("key").agg(F.max_by(F.struct("id", "n"), order).alias("x"), F.count("*").alias("held"))
            .where(F.col("held") > _HOT).select("key", F.col("x.id").alias("lead"), F.col("x.n").alias("m")), "leaders")
        if turn and not leader.limit(1).count():
            return homes
        common = left.join(leader, "key").where((F.col("id") != F.col("lead")) & (_fits(F.col("n"), F.col("m")) | _fits(F.col("m"), F.col("n")))) \
            .groupBy("id", "lead").agg(F.count("*").alias("common"))
        best = common.withColumn("rank", F.row_number().over(Window.partitionBy("id").orderBy(F.desc("common"), "lead"))) \
            .where(F.col("rank") <= _LEADERS)
        led = _linked_to(best.select("lead", "id"), whole).unionByName(leader.select(
            "lead", F.col("lead").alias("id"), F.col("m").cast("long").alias("margin"),
            F.array().cast("array<bigint>").alias("alone")).distinct())
        led = stage_lean(led, "led")
        size = led.groupBy("lead").agg(F.count("*").alias("size"))
        home = led.select("id", "lead").join(size, "lead").groupBy("id").agg(F.max_by("lead", F.struct("size", "lead")).alias("lead"))
        large = home.groupBy("lead").agg(F.count("*").alias("size")).where(F.col("size") > _HOT).select("lead")
        found = led.join(home, ["id", "lead"]).join(large, "lead").select("id", F.col("lead").alias("home"), "margin", "alone")
        found = stage_lean(found if homes is None else homes.unionByName(found), "homes")
        if homes is not None and found.count() == homes.count():
            return homes
        homes = found
    return homes


def _linked_weights(table: pa.Table) -> pa.Table:
    """Of the classes of two blocks (or of one with itself), the weight of those in the other that each links to."""
    second = table.column("second").to_numpy()
    same = table.column("p")[0] == table.column("q")[0]
    sides = []
    for rows in (np.flatnonzero(~second), np.flatnonzero(~second if same else second)):
        part = table.take(pa.array(rows))
        lists = part.column("shared").combine_chunks()
        owner = np.repeat(np.arange(len(rows)), np.diff(lists.offsets.to_numpy()))
        sides.append((part.column("class").to_numpy(), part.column("margin").to_numpy(), part.column("weight").to_numpy(),
                      lists.flatten().to_numpy(), owner))
    (one, margin, weight, items, owner), (two, other_margin, other_weight, other_items, other_owner) = sides
    both = np.intersect1d(items, other_items)
    common = np.zeros((len(one), len(two)), np.float32)
    for start in range(0, len(both), 4096):
        some = both[start : start + 4096]

        def held(values: np.ndarray, by: np.ndarray, n: int) -> np.ndarray:
            at = np.minimum(np.searchsorted(some, values), len(some) - 1)
            here = some[at] == values
            out = np.zeros((n, len(some)), np.float32)
            out[by[here], at[here]] = 1
            return out

        common += held(items, owner, len(one)) @ held(other_items, other_owner, len(two)).T
    linked = margin[:, None] + other_margin[None, :] + 18 * common.astype(np.int64) >= 0
    names, sums = [one], [linked @ other_weight]
    if not same:
        names.append(two), sums.append(linked.T @ weight)
    return pa.table({"class": np.concatenate(names), "linked": np.concatenate(sums).astype(np.int64)})


def _links_at_home(homes: DataFrame, copies: DataFrame) -> DataFrame:
    """id, others: the copies of all other sets of its home that a set is similar to.

    Two sets that differ from the leader in D and E differ in |D| + |E| - 2 |D and E| shingles. With margins n - 9 |D| and
    m - 9 |E| they are similar if the margins and 18 |D and E| make no less than 0: always, if no margin is below 0. Shingles
    in which one set alone differs from the leader are in no such intersection; without these, sets of one margin and the
    same differences link alike, and form a class.
    """
    each = homes.select("home", "id", F.explode("alone").alias("x"))
    several = each.groupBy("home", "x").agg(F.count("*").alias("held")).where("held > 1").select("home", "x")
    shared = each.join(several, ["home", "x"]).groupBy("id").agg(F.array_sort(F.collect_list("x")).alias("shared"))
    rows = stage_lean(homes.select("id", "home", "margin").join(copies, "id").join(shared, "id", "left").withColumn(
        "shared", F.coalesce("shared", F.array().cast("array<bigint>"))), "at-home")
    classes = stage_lean(rows.groupBy("home", "margin", "shared").agg(
        F.min("id").alias("class"), F.sum("copies").alias("weight")), "classes")
    far = F.col("margin") < 0
    blocks = classes.groupBy("home").agg(
        F.ceil(F.count_if(far) / _BLOCK).alias("far"), F.ceil(F.count_if(~far) / _BLOCK).alias("near"),
        F.coalesce(F.sum(F.when(~far, F.col("weight"))), F.lit(0)).alias("near_weight"))
    dealt = classes.join(blocks, "home")
    at = dealt.where("far > 0").withColumn("at", F.pmod(F.xxhash64("class"), F.when(far, F.col("far")).otherwise(F.col("near"))))
    # Blocks of near sets are -1, -2 and so on; they never meet each other.
    meet = F.when(far, F.expr("""concat(
        transform(sequence(0L, far - 1), j -> struct(least(at, j) AS p, greatest(at, j) AS q, at > j AS second)),
        transform(filter(sequence(0L, near), j -> j > 0), j -> struct(-j AS p, at AS q, true AS second)))""")).otherwise(F.expr(
        "transform(sequence(0L, far - 1), j -> struct(-1 - at AS p, j AS q, false AS second))"))
    met = at.select("home", "class", "margin", "weight", "shared", F.explode(meet).alias("x"))
    # Dealt anew, as rows dealt by home would leave all blocks of a home to one task.
    met = met.select("home", "x.*", "class", "margin", "weight", "shared").repartition("home", "p", "q")
    counted = met.groupBy("home", "p", "q").applyInArrow(
        _linked_weights, "class long, linked long")
    near = dealt.where(~far).select("class", F.col("near_weight").alias("linked"))
    total = counted.unionByName(near).groupBy("class").agg(F.sum("linked").alias("linked"))
    itself = F.when(2 * F.col("margin") + 18 * F.size("shared") >= 0, F.col("copies")).otherwise(0)
    return rows.join(classes.drop("weight"), ["home", "margin", "shared"]).join(total, "class").select(
        "id", (F.col("linked") - itself).alias("others"))


def _between_homes(looked: DataFrame, index: DataFrame, homes: DataFrame, whole: DataFrame) -> DataFrame:
    """Pairs (a, b), not of one home, where one looks up a segment of the other and their sketches are close.

    In each group the sets of the home with most sets there, its main, meet only the others."""
    mine = homes.select("id", "home")
    seek, held = looked.join(mine, "id", "left"), index.drop("typical").join(
        mine.select(F.col("id").alias("b"), F.col("home").alias("home_b")), "b", "left")
    main = stage_lean(
        held.where("home_b is not null").groupBy("key", "home_b").agg(F.count("*").alias("n"))
        .groupBy("key").agg(F.max_by("home_b", F.struct("n", "home_b")).alias("main")), "mains")
    seek, held = _sketched(seek.join(main, "key", "left"), held.join(main, "key", "left"), whole)
    seek, held = stage_lean(seek, "seekers"), stage_lean(held, "held")
    close = F.coalesce(F.col("home") != F.col("home_b"), F.lit(True)) & _close()
    others = F.coalesce(F.col("home") != F.col("main"), F.lit(True))
    other_holders = F.col("main").isNotNull() & F.coalesce(F.col("home_b") != F.col("main"), F.lit(True))
    return _unordered(_meet(seek.where(others).drop("main"), held.drop("main"), close).unionByName(
        _meet(seek.where("home = main").drop("main"), held.where(other_holders).drop("main"), close)))


def _grouped(docs: DataFrame) -> DataFrame:
    """doc_id, version, n, group: each row's component; rows without shingles are groups of their own."""
    sets = stage_lean(signatures(docs), "shingle-sets")
    members = stage_lean(sets.select("doc_id", "version", "id", "n"), "members")
    linked = set_components(docs, sets)
    return members.join(linked, "id", "left").select(
        "doc_id", "version", "n", F.when(F.col("n") > 0, F.coalesce("component", "id")).alias("group"))


def components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs`` (doc_id, text).

    Words are lower-cased in ASCII; a text with fewer than five is one shingle, one without words (empty, null) has
    none and links with nothing. Rows count one by one, also those that repeat a doc_id. component_id is the smallest
    doc_id reachable by links; a null doc_id is never the smallest unless it is alone.
    """
    rows = _grouped(docs)
    first = rows.where("n > 0").groupBy("group").agg(F.min("doc_id").alias("first"))
    return rows.join(first, "group", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("first")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """doc_id and version (xxhash64 of the text) of the document of each component that stays.

    It has the smallest doc_id, of rows with one doc_id the smallest version; a null doc_id comes last. Rows without
    shingles all stay.
    """
    rows = _grouped(docs)
    first = rows.where("n > 0").groupBy("group").agg(
        F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "version")).alias("x"))
    return first.select("x.doc_id", "x.version").unionByName(rows.where("n = 0").select("doc_id", "version")).distinct()


def links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b; a < b) of all similar sets, and the sets of the rows: doc_id, version, id, n.

    Rows of one id have equal sets. Those with n = 0 have no shingles and are in no link.
    """
    sets = stage_lean(signatures(docs), "shingle-sets")
    members = stage_lean(sets.select("doc_id", "version", "id", "n"), "members")
    return set_links(docs, sets), members


def components_with_links(docs: DataFrame) -> DataFrame:
    """As :func:`components`, with n_links: how many other rows are similar to the row, those of equal sets included."""
    sets = stage_lean(signatures(docs), "shingle-sets")
    members = stage_lean(sets.select("doc_id", "version", "id", "n"), "members")
    looked, index, whole = _indexed(docs, sets)
    homes = _homes(looked, index, whole)
    pairs = stage_lean(_verified(stage_lean(_between_homes(looked, index, homes, whole), "pairs"), whole), "links")
    sets = members.where("n > 0").groupBy("id").agg(F.count("*").alias("copies"), F.min("doc_id").alias("first"))
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = both.join(sets.select(F.col("id").alias("b"), "copies"), "b").select(F.col("a").alias("id"), F.col("copies").alias("others")) \
        .unionByName(_links_at_home(homes, sets.select("id", "copies"))).groupBy("id").agg(F.sum("others").alias("others"))
    linked = connected_components(pairs.unionByName(homes.select(F.col("id").alias("a"), F.col("home").alias("b")))) \
        .withColumnRenamed("node", "id")
    at = stage_lean(
        sets.join(linked, "id", "left").join(others, "id", "left").select(
            "id", "first", F.coalesce("component", "id").alias("group"),
            (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")), "sets-with-links")
    first = at.groupBy("group").agg(F.min("first").alias("component_id"))
    rows = members.join(at.join(first, "group").select("id", "component_id", "n_links"), "id", "left")
    return rows.select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("n") > 0, F.col("n_links")).otherwise(0).alias("n_links"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all ``documents`` and each document's number of links."""
    return components_with_links(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
