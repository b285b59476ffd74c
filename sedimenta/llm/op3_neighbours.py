"""Approximate nearest neighbours by inner product: NN-descent builds a neighbour graph, queries search it greedily.

Equal vectors are one node. The graph begins with each node's best in a few random blocks (hyperplanes between sampled
vectors). Then, round after round, every node's neighbours and those that have it as neighbour meet: the node is a hub
where they are compared with each other, and each keeps the best it was shown. A query starts at its own node and widens
what it knows by the neighbours of the best it has found, several rounds of joins for all queries at once.

Blocks, lists of neighbours, hubs and what a query remembers are bounded by parameters. Comparisons use vectors in
eight bits a component; the last ones found are scored exactly on the original vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .staging import stage_lean


@dataclass(frozen=True)
class Settings:
    neighbours: int = 40
    block: int = 1600  # nodes compared with each other at the start
    blocks: int = 6  # how often
    from_block: int = 16
    rounds: int = 4
    from_hub: int = 8
    beam: int = 150
    width: int = 40
    steps: int = 5
    exact: int = 80  # nodes scored exactly in the end
    seed: int = 7


def nodes(vectors: DataFrame, members: int) -> tuple[DataFrame, DataFrame]:
    """Distinct usable vectors (node: their smallest id, vec), and for each the ids that have it, ``members`` at most.

    Only so many of the smallest ids of equal vectors can be among a query's nearest. Vectors that are null, zero or
    hold null or non-finite components are left out; of rows with one id the smallest vector counts.
    """
    usable = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec")) \
        .where("vec_id is not null and vec is not null") \
        .where(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))) \
        .where(F.exists("vec", lambda x: x != 0))
    usable = usable.groupBy("vec_id").agg(F.min("vec").alias("vec"))
    named = stage_lean(usable.select("vec_id", "vec", F.xxhash64("vec").alias("h1"), F.hash("vec").alias("h2")), "vectors")
    distinct = stage_lean(named.groupBy("h1", "h2").agg(F.min("vec_id").alias("node"), F.min_by("vec", "vec_id").alias("vec")), "nodes")
    ranked = named.select("h1", "h2", "vec_id", F.row_number().over(
        Window.partitionBy("h1", "h2").orderBy("vec_id")).alias("rank")).where(F.col("rank") <= members)
    holders = stage_lean(ranked.join(distinct.select("h1", "h2", "node"), ["h1", "h2"]).select("node", "vec_id"), "members")
    return distinct.select("node", "vec"), holders


def _packed(vec: np.ndarray) -> list[bytes]:
    """A scale and a byte for each component."""
    scale = np.abs(vec).max(axis=1, keepdims=True) / 127
    small = np.rint(vec / scale).astype(np.int8)
    return [s.tobytes() + v.tobytes() for s, v in zip(scale.astype(np.float32), small)]


def _unpacked(column: pa.Array) -> np.ndarray:
    size = len(column[0].as_py()) if len(column) else 4
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, size)
    return raw[:, 4:].copy().view(np.int8).astype(np.float32) * raw[:, :4].copy().view(np.float32)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _small_nodes(distinct: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_packed(_matrix(batch.column(1))), pa.binary())],
                                                 ["node", "small"])

    return distinct.mapInArrow(run, "node long, small binary")


def _top(similar: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``k`` largest entries of each row, without the diagonal."""
    n = len(similar)
    np.fill_diagonal(similar, -np.inf)
    k = min(k, n - 1)
    best = np.argpartition(-similar, k - 1, axis=1)[:, :k] if k < n - 1 else np.argsort(-similar, axis=1)[:, :k]
    return np.repeat(np.arange(n), k), best.ravel()


def _first_edges(small: DataFrame, count: int, s: Settings) -> DataFrame:
    """u, v, near: the best of each node in each of its blocks."""
    bits = max(0, math.ceil(math.log2(max(count, 1) / s.block)))
    need = 2 * bits * s.blocks  # vectors that come to the driver
    pivots = small.orderBy(F.xxhash64("node", F.lit(s.seed)), "node").limit(max(need, 1)).toArrow().column(1).combine_chunks()
    pivots = _unpacked(pivots)
    pivots = pivots[np.arange(need) % max(len(pivots), 1)].reshape(s.blocks, bits, 2, -1) if need else None

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _unpacked(batch.column(1))
            for turn in range(s.blocks if bits else 1):
                code = np.zeros(len(x), np.int64)
                for b in range(bits):
                    one, two = pivots[turn, b]
                    code = code * 2 + ((x - (one + two) / 2) @ (one - two) > 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(code * s.blocks + turn), *batch.columns], ["block", "node", "small"])

    def compare(table: pa.Table) -> pa.Table:
        x = _unpacked(table.column("small").combine_chunks())
        ids = table.column("node").to_numpy()
        if len(ids) < 2:
            return pa.table({"u": pa.array([], pa.int64()), "v": pa.array([], pa.int64()), "near": pa.array([], pa.float32())})
        near = x @ x.T
        row, column = _top(near, s.from_block if bits else s.neighbours)
        return pa.table({"u": ids[row], "v": ids[column], "near": near[row, column]})

    dealt = stage_lean(small.mapInArrow(blocks, "block long, node long, small binary"), "blocks")
    # A block beyond its size is dealt into parts by hash, so that none is compared in one task as a whole.
    sizes = dealt.groupBy("block").agg(F.ceil(F.count("*") / (2 * s.block)).alias("parts"))
    parted = dealt.join(sizes, "block").withColumn("part", F.pmod(F.xxhash64("node", "block"), "parts"))
    return parted.select("block", "part", "node", "small").groupBy("block", "part").applyInArrow(
        lambda table: compare(table), "u long, v long, near float")


def _best(edges: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest of every node, each once."""
    once = edges.groupBy("u", "v").agg(F.max("near").alias("near"))
    rank = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("near"), "v"))
    return once.withColumn("rank", rank).where(F.col("rank") <= k).drop("rank")


def _shown_at_hubs(edges: DataFrame, small: DataFrame, s: Settings) -> DataFrame:
    """u, v, near: what members of a hub see there that is nearer than the farthest they have."""
    # Of many nodes that have the hub as neighbour, a random choice comes each round.
    chance = F.row_number().over(Window.partitionBy("hub").orderBy(F.xxhash64("member", "near"), "member"))
    back = edges.select(F.col("v").alias("hub"), F.col("u").alias("member"), "near") \
        .withColumn("rank", chance).where(F.col("rank") <= s.neighbours).select("hub", "member")
    meet = edges.select(F.col("u").alias("hub"), F.col("v").alias("member")).union(back).distinct()
    far = edges.groupBy(F.col("u").alias("member")).agg(F.min("near").alias("far"), F.count("*").alias("n")) \
        .select("member", F.when(F.col("n") < s.neighbours, -float("inf")).otherwise(F.col("far")).cast("float").alias("far"))
    about = small.withColumnRenamed("node", "member").join(far, "member")
    hubs = meet.join(about, "member").groupBy("hub").agg(F.collect_list(F.struct("member", "far", "small")).alias("m"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            for lo in range(0, len(lists), 200):
                some = lists.slice(lo, 200)
                flat, size = some.flatten(), np.array([len(x) for x in some])
                ids, far = flat.field(0).to_numpy(), flat.field(1).to_numpy()
                x, ends = _unpacked(flat.field(2)), np.cumsum(size)
                out: list[list[np.ndarray]] = [[], [], []]
                for a, b in zip((ends - size).tolist(), ends.tolist()):
                    if b - a < 2:
                        continue
                    near = x[a:b] @ x[a:b].T
                    row, column = _top(near, s.from_hub)
                    value = near[row, column]
                    better = value > far[a + row]
                    for part, what in zip(out, (ids[a + row[better]], ids[a + column[better]], value[better])):
                        part.append(what)
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(p)) for p in out], ["u", "v", "near"])

    return hubs.select("m").mapInArrow(run, "u long, v long, near float")


def neighbour_graph(small: DataFrame, s: Settings = Settings()) -> DataFrame:
    """u, v, near: up to ``neighbours`` near nodes of every node, by rounds of NN-descent."""
    edges = stage_lean(_best(_first_edges(small, small.count(), s), s.neighbours), "edges")
    for _ in range(s.rounds):
        edges = stage_lean(_best(edges.unionByName(_shown_at_hubs(edges, small, s)), s.neighbours), "edges")
    return edges


def search(queries: DataFrame, edges: DataFrame, small: DataFrame, s: Settings = Settings()) -> DataFrame:
    """node, found: of each query node (node) the nodes that greedy search finds, nearest first by eight bits."""
    around = stage_lean(
        edges.join(small.select(F.col("node").alias("v"), "small"), "v").groupBy(F.col("u").alias("at")).agg(
            F.collect_list(F.struct("v", "small")).alias("near")), "graph")
    own = queries.join(small, "node")
    start = edges.join(queries.withColumnRenamed("node", "u"), "u", "left_semi").groupBy(F.col("u").alias("node")).agg(
        F.collect_list(F.struct(F.col("v").alias("id"), F.col("near").alias("value"))).alias("fresh"))
    known = "node long, small binary, ids array<long>, near array<float>, done array<boolean>"

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds what is fresh to what a query remembers; the nearest ``width`` not yet visited count as visited next."""
        for batch in batches:
            ids_, near_, done_, next_ = [], [], [], []
            for k in range(batch.num_rows):
                old, fresh = batch.column(2)[k], batch.column(5)[k]
                ids = old.values.to_numpy() if old.is_valid else np.zeros(0, np.int64)
                near = batch.column(3)[k].values.to_numpy() if old.is_valid else np.zeros(0, np.float32)
                done = batch.column(4)[k].values.to_numpy(zero_copy_only=False) if old.is_valid else np.zeros(0, bool)
                if fresh.is_valid:
                    more = fresh.values
                    ids = np.concatenate([ids, more.field(0).to_numpy()])
                    near = np.concatenate([near, more.field(1).to_numpy()])
                    done = np.concatenate([done, np.zeros(len(ids) - len(done), bool)])
                _, first = np.unique(ids, return_index=True)  # what is known comes first, with its mark
                first = first[ids[first] != batch.column(0)[k].as_py()]
                first = first[np.lexsort((ids[first], -near[first]))][: s.beam]
                ids, near, done = ids[first], near[first], done[first].astype(bool)
                go = np.flatnonzero(~done)[: s.width]
                done[go] = True
                ids_.append(ids), near_.append(near), done_.append(done), next_.append(ids[go])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(ids_, pa.list_(pa.int64())), pa.array(near_, pa.list_(pa.float32())),
                 pa.array(done_, pa.list_(pa.bool_())), pa.array(next_, pa.list_(pa.int64()))],
                ["node", "small", "ids", "near", "done", "next"])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """From the nodes visited, their neighbours that are nearer to the query than the last it remembers."""
        for batch in batches:
            if not batch.num_rows:
                continue
            asked, last = _unpacked(batch.column(1)), batch.column(2).to_numpy()
            for lo in range(0, batch.num_rows, 500):
                lists = batch.column(3).slice(lo, 500)
                size = np.array([len(x) for x in lists])
                flat = lists.flatten()
                owner = lo + np.repeat(np.arange(len(size)), size)
                value = np.einsum("ij,ij->i", _unpacked(flat.field(1)), asked[owner])
                keep = value > last[owner]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(owner[keep])), flat.field(0).filter(pa.array(keep)), pa.array(value[keep])],
                    ["node", "id", "value"])

    empty = [F.lit(None).cast(t).alias(c) for c, t in (("ids", "array<long>"), ("near", "array<float>"), ("done", "array<boolean>"))]
    state = stage_lean(own.join(start, "node", "left").select("node", "small", *empty, "fresh").mapInArrow(
        merge, known + ", next array<long>"), "search")
    for _ in range(s.steps):
        last = F.when(F.size("near") < s.beam, F.lit(-float("inf"))).otherwise(F.element_at("near", -1)).cast("float")
        visit = state.select("node", "small", last.alias("last"), F.explode("next").alias("at"))
        seen = visit.join(around, "at").select("node", "small", "last", "near").mapInArrow(look, "node long, id long, value float")
        fresh = seen.groupBy("node", "id").agg(F.max("value").alias("value")).groupBy("node").agg(
            F.collect_list(F.struct("id", "value")).alias("fresh"))
        state = stage_lean(state.drop("next").join(fresh, "node", "left").mapInArrow(merge, known + ", next array<long>"), "search")
    return state.select("node", F.slice("ids", 1, s.exact).alias("found"))


def nearest(vectors: DataFrame, is_query, k: int = 20, s: Settings = Settings()) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows found for each row where ``is_query`` holds.

    ``vectors`` has vec_id and embedding (of one length). Nearness is the inner product in double precision, ties go to
    the smaller vec_id, and a row is not its own neighbour. Unusable vectors (see :func:`nodes`) take no part.
    """
    distinct, members = nodes(vectors, k + 1)
    small = stage_lean(_small_nodes(distinct), "small-vectors")
    # Of many rows with one vector that are queries, all ask; members has only those that can be answers.
    every = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec")) \
        .where(is_query).groupBy("vec_id").agg(F.min("vec").alias("vec"))
    keyed = distinct.select("node", F.xxhash64("vec").alias("h1"), F.hash("vec").alias("h2"))
    asking = stage_lean(every.select("vec_id", F.xxhash64("vec").alias("h1"), F.hash("vec").alias("h2")).join(
        keyed, ["h1", "h2"]).select(F.col("vec_id").alias("query_id"), "node"), "queries")
    edges = neighbour_graph(small, s)
    found = search(asking.select("node").distinct(), edges, small, s)
    pairs = found.select("node", F.explode("found").alias("other")).union(found.select("node", F.col("node").alias("other")))
    product = F.aggregate(F.zip_with("x", "y", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    scored = pairs.join(distinct.select("node", F.col("vec").alias("x")), "node") \
        .join(distinct.select(F.col("node").alias("other"), F.col("vec").alias("y")), "other") \
        .select("node", "other", product.alias("score"))
    answers = scored.join(members.withColumnRenamed("node", "other"), "other")
    rank = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("score"), "vec_id"))
    answers = stage_lean(answers.withColumn("rank", rank).where(F.col("rank") <= k + 1).drop("rank"), "answers")
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return asking.join(answers, "node").where("query_id <> vec_id").withColumn("rank", F.row_number().over(own)) \
        .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every embedding whose vec_id is divisible by 20."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return nearest(vectors, F.col("vec_id") % 20 == 0)
