"""Removal of bytes covered by long strings that also start earlier, within or across documents.

Every window of ``min_bytes`` bytes belongs to the anchor with the least hash among its ``anchor_bytes``-grams, so equal
windows always share an anchor. Neighbouring windows with one anchor make a piece of text.

1. Anchors are counted over all documents; pieces whose anchor is found once cannot repeat.
2. Equal pieces (by anchor and piece hash) fold into their earliest occurrence, with combining before the shuffle. All
   other occurrences are covered. A passage in a third of all documents is a few keys with counts.
3. Different pieces of one anchor go, each once, to a bin of about ``BIN_BYTES``. There the windows that repeat come
   from interval expansion on the Burrows-Wheeler transform of the bin (:mod:`bwt_repeats`).
4. An anchor with too many different pieces for one bin is dealt by window instead: the hash of a whole window is a
   finer key of the same kind, and windows that are equal under it fold as pieces do in step 2.

Covered runs join back to their documents. No group is collected whole but a bin and one document's runs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bwt_repeats import covered_windows
from .staging import stage_lean
from .text import _power_tables, mix, prefix_sums, slices, span_hashes, strings, tidy

MIN_BYTES = 100
ANCHOR_BYTES = 32
BIN_BYTES = 1 << 19
HOT_PIECES = 4096
_LONGEST_PIECE = 512  # windows

_PIECES = "anchor long, piece long, doc long, version int, start int, windows int, again boolean"


def _anchors(part, min_bytes: int, anchor_bytes: int):
    """Pieces of a slice: text, start in it, windows, anchor hash, whether the anchor occurs twice, piece hash."""
    buf, offsets = part.buf, part.offsets
    none = np.zeros(0, np.int64)
    last = offsets[1:] - min_bytes  # the last window of each text
    if not (last >= offsets[:-1]).any():
        return none, none, none, none.astype(np.uint64), none.astype(bool), none.astype(np.uint64)
    prefix = prefix_sums(buf)
    _, inverses = _power_tables(len(prefix))
    n = len(buf) - anchor_bytes + 1
    least = (prefix[anchor_bytes:] - prefix[:n]) * inverses[:n]
    shift = np.zeros(n, np.uint8)  # of the leftmost least gram
    covered, width = 1, min_bytes - anchor_bytes + 1
    while covered < width:
        step = min(covered, width - covered)
        right = least[step:]
        better = right < least[: len(right)]
        shift = np.where(better, shift[step:] + np.uint8(step), shift[: len(right)])
        least = np.where(better, right, least[: len(right)])
        covered += step
    # least[i]: over the window that starts at i; windows that leave their text do not count.
    owner = np.repeat(np.arange(part.n), np.maximum(last - offsets[:-1] + 1, 0))
    at = np.arange(len(owner)) + np.repeat(
        offsets[:-1] - np.concatenate([[0], np.cumsum(np.maximum(last - offsets[:-1] + 1, 0))[:-1]]),
        np.maximum(last - offsets[:-1] + 1, 0))
    least, gram = least[at], at + shift[at]
    fresh = np.ones(len(at), bool)
    fresh[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
    run = np.flatnonzero(fresh)
    length = np.diff(np.append(run, len(at)))
    parts = -(-length // _LONGEST_PIECE)
    first = np.repeat(run, parts) + _LONGEST_PIECE * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
    count = np.diff(np.append(first, len(at)))
    moves = np.zeros(len(at), np.int64)
    moves[1:] = gram[1:] != gram[:-1]
    moves[fresh] = 0
    again = (np.add.reduceat(moves, run) > 0)[np.repeat(np.arange(len(run)), parts)]
    start = at[first]
    whole = span_hashes(prefix, start, start + count - 1 + min_bytes)
    return owner[first], start - offsets[owner[first]], count, mix(least[first]), again, whole


def _keyed(docs: DataFrame) -> DataFrame:
    """doc, version and text: rows with one doc_id and different texts count as different documents, by hash of text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc"),
                       F.hash(text).alias("version"), text.alias("text"))


def _anchor_counts(docs: DataFrame, min_bytes: int, anchor_bytes: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(0)):
                _, _, _, anchor, again, _ = _anchors(part, min_bytes, anchor_bytes)
                values, inverse = np.unique(anchor, return_inverse=True)
                n = np.bincount(inverse, weights=1 + again, minlength=len(values)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n)], ["anchor", "n"])

    return (docs.select("text").mapInArrow(tidy(run), "anchor long, n long")
            .groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor"))


def _pieces(docs: DataFrame, min_bytes: int, anchor_bytes: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(2)):
                owner, start, count, anchor, again, whole = _anchors(part, min_bytes, anchor_bytes)
                rows = pa.array(part.lo + owner)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(whole.view(np.int64)), batch.column(0).take(rows),
                     batch.column(1).take(rows), pa.array(start.astype(np.int32)), pa.array(count.astype(np.int32)),
                     pa.array(again)],
                    ["anchor", "piece", "doc", "version", "start", "windows", "again"])

    return docs.select("doc", "version", "text").mapInArrow(tidy(run), _PIECES)


def covered_runs(docs: DataFrame, min_bytes: int = MIN_BYTES, anchor_bytes: int = ANCHOR_BYTES) -> DataFrame:
    """doc, version, start, stop: byte runs (they may overlap) covered by strings that also start earlier.

    ``docs`` has doc, version and text; the order of documents is that of (doc, version).
    """
    repeated = _anchor_counts(docs, min_bytes, anchor_bytes)
    pieces = stage_lean(_pieces(docs, min_bytes, anchor_bytes).join(repeated, "anchor", "left_semi"), "repeated-pieces")
    here = F.struct("doc", "version", "start")
    kinds = stage_lean(
        pieces.groupBy("anchor", "piece").agg(
            F.min(here).alias("first"), F.count("*").alias("n"), F.max("windows").alias("windows"),
            F.bool_or("again").alias("again")), "piece-kinds")

    copies = pieces.join(kinds.where("n > 1").select("anchor", "piece", "first"), ["anchor", "piece"]).where(here != F.col("first"))
    runs = copies.select("doc", "version", "start", (F.col("start") + F.col("windows") + (min_bytes - 1)).alias("stop"))

    sizes = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.bool_or("again").alias("inner"))
    several = (kinds.join(sizes.where("kinds > 1 or inner"), "anchor")
               .select("anchor", "first.*", "windows", (F.col("kinds") > HOT_PIECES).alias("hot")))
    several = stage_lean(several, "pieces-to-compare")
    total = several.where("not hot").agg(F.sum(F.col("windows") + min_bytes)).first()[0] or 0
    bins = max(1, math.ceil(total / BIN_BYTES))

    cut = stage_lean(_cut(docs, several, bins, min_bytes), "compared-pieces")
    binned = cut.where("bin is not null").groupBy("bin").applyInArrow(
        lambda table: _expand(table, min_bytes), "doc long, version int, start int, stop int")
    hot = cut.where("bin is null")
    firsts = hot.groupBy("low", "high").agg(F.min(here).alias("first"), F.count("*").alias("n")).where("n > 1")
    dealt = (hot.join(firsts, ["low", "high"]).where(here != F.col("first"))
             .select("doc", "version", "start", (F.col("start") + min_bytes).alias("stop")))
    return runs.unionByName(binned).unionByName(dealt)


def _cut(docs: DataFrame, several: DataFrame, bins: int, min_bytes: int) -> DataFrame:
    """The text of each piece, with its bin; of hot anchors each window's hash instead."""
    wanted = several.groupBy("doc", "version").agg(F.collect_list(F.struct(
        F.pmod(F.col("anchor"), F.lit(bins)).cast("int").alias("bin"), "start", "windows", "hot")).alias("pieces"))
    joined = docs.join(wanted, ["doc", "version"]).select("doc", "version", "text", "pieces")
    schema = T.StructType.fromDDL(
        "doc long, version int, start int, bin int, content binary, low long, high long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = strings(batch.column(2))
            lists = batch.column(3)
            where = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            flat = lists.flatten()
            bin_, start, count, hot = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(4))
            row = np.repeat(np.arange(batch.num_rows), np.diff(where))
            begin = offsets[row] + start
            data = buf.tobytes()
            for lo in range(0, len(row), 20_000):
                some = slice(lo, lo + 20_000)
                cool = np.flatnonzero(~hot[some]) + lo
                if len(cool):
                    content = [data[b : b + c + min_bytes - 1] for b, c in zip(begin[cool].tolist(), count[cool].tolist())]
                    none = pa.nulls(len(cool), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(row[cool])), batch.column(1).take(pa.array(row[cool])),
                         pa.array(start[cool].astype(np.int32)), pa.array(bin_[cool].astype(np.int32)),
                         pa.array(content, pa.binary()), none, none], schema.names)
            warm = np.flatnonzero(hot)
            for lo in range(0, len(warm), 1000):
                some = warm[lo : lo + 1000]
                at = np.repeat(begin[some], count[some]) + _within(count[some])
                own = np.repeat(row[some], count[some])
                windows = [data[b : b + min_bytes] for b in at.tolist()]
                low, high = _wide_hashes(windows)
                none = pa.nulls(len(at), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(own)), batch.column(1).take(pa.array(own)),
                     pa.array((at - offsets[own]).astype(np.int32)), none, pa.nulls(len(at), pa.binary()),
                     pa.array(low), pa.array(high)], schema.names)

    return joined.mapInArrow(tidy(run), schema)


def _within(count: np.ndarray) -> np.ndarray:
    ends = np.cumsum(count)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - count, count)


def _wide_hashes(windows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    import xxhash

    both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, windows)), np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _expand(table: pa.Table, min_bytes: int) -> pa.Table:
    table = table.sort_by([("doc", "ascending"), ("version", "ascending"), ("start", "ascending")])
    key = [table.column(c).to_numpy() for c in ("doc", "version", "start")]
    new = np.ones(table.num_rows, bool)  # a document given twice has its pieces twice
    new[1:] = np.any([k[1:] != k[:-1] for k in key], axis=0)
    table = table.filter(pa.array(new))
    covered = covered_windows(table.column("content").to_pylist(), np.arange(table.num_rows), min_bytes)
    row, lo, hi = [], [], []
    for k, mask in enumerate(covered):
        edges = np.flatnonzero(np.diff(mask, prepend=False, append=False))
        row += [k] * (len(edges) // 2)
        lo += edges[::2].tolist()
        hi += edges[1::2].tolist()
    start = table.column("start").to_numpy()[row] if row else np.zeros(0, np.int32)
    rows = pa.array(row, pa.int64())
    return pa.table({
        "doc": table.column("doc").take(rows), "version": table.column("version").take(rows),
        "start": pa.array((start + np.array(lo, np.int64)).astype(np.int32)),
        "stop": pa.array((start + np.array(hi, np.int64) + min_bytes - 1).astype(np.int32))})


def remove_repeats(docs: DataFrame, min_bytes: int = MIN_BYTES, anchor_bytes: int = ANCHOR_BYTES) -> DataFrame:
    """Every row of ``docs`` with n_bytes, n_removed, n_spans, kept (binary) and spans (array of start, stop) added.

    Removed is each byte covered by a string of ``min_bytes`` bytes that also starts earlier: in a document with a
    smaller doc_id, or before in the same one. Strings are those of the input. A null text counts as empty; empty and
    short texts lose nothing. A null doc_id comes before all others. Rows with one doc_id and different texts count as
    different documents in the order of a hash of the text; rows that repeat a document whole share its result.
    Columns of the same names are replaced.
    """
    added = ["n_bytes", "n_removed", "n_spans", "kept", "spans"]
    kept = [c for c in docs.columns if c not in added]
    runs = covered_runs(_keyed(docs), min_bytes, anchor_bytes)
    by_doc = runs.groupBy("doc", "version").agg(F.collect_list(F.struct("start", "stop")).alias("runs")) \
        .withColumnsRenamed({"doc": "__doc", "version": "__version", "runs": "__runs"})
    own = docs.select(*kept, F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("__doc"),
                      F.hash(F.coalesce(F.col("text"), F.lit(""))).alias("__version"))
    joined = own.join(by_doc, ["__doc", "__version"], "left").select(*kept, "__runs")
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())]))
    schema = T.StructType([docs.schema[c] for c in kept] + [
        T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("n_spans", T.LongType()), T.StructField("kept", T.BinaryType()), T.StructField("spans", span)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = strings(batch.column(batch.schema.get_field_index("text")))
            runs = batch.column(len(kept))
            n_removed, n_spans, rest, spans = [], [], [], []
            for k in range(batch.num_rows):
                mine = buf[offsets[k] : offsets[k + 1]]
                found = runs[k]
                if not found.is_valid:
                    n_removed.append(0), n_spans.append(0), rest.append(mine.tobytes()), spans.append([])
                    continue
                flat = found.values
                change = np.zeros(len(mine) + 1, np.int64)
                np.add.at(change, flat.field(0).to_numpy(), 1)
                np.add.at(change, flat.field(1).to_numpy(), -1)
                gone = np.cumsum(change)[:-1] > 0
                edges = np.flatnonzero(np.diff(gone, prepend=False, append=False)).tolist()
                n_removed.append(int(gone.sum())), n_spans.append(len(edges) // 2)
                rest.append(mine[~gone].tobytes())
                spans.append([{"start": a, "stop": b} for a, b in zip(edges[::2], edges[1::2])])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(kept)], pa.array(np.diff(offsets), pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(n_spans, pa.int64()), pa.array(rest, pa.binary()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))],
                [*kept, *added])

    return joined.mapInArrow(tidy(run), schema)


def op2_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of ``documents`` that a 100-byte string starting earlier covers, removed."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2(F.col("kept"), 256).alias("kept_sha256"))
