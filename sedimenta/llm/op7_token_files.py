"""Token ids in ORC files: integer run-length encoding, row indexes and Bloom filters on document ids.

``write_token_files`` orders documents by range of ``doc_id``, encodes each ordered part in one task and writes it as
one file of stripes. Each row holds the document's id, where its ids begin in the file, how many it has and the ids.
Files are read back in parallel by stripe; a search for some documents reads file footers, row indexes and Bloom
filters and skips the stripes and row groups that cannot hold them.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sedimenta.scratch import new_path

from .chunk_table import ChunkTable, joined, places
from .text import SLICE_BYTES, slices

END_ID = 2
ORC_OPTIONS = {
    "compression": "zstd",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(16 << 20),
}
_FILES = "doc_id long, start_in_file long, n_tokens int, ids array<int>"
_BESIDE_SPACE = re.compile(r"\s | \s|^ | $")
_RARE_WHITE = re.compile(r"[^\S \n]")
_WORD_AND_MARKS = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]++)([!-/:-@\[-`{-~]++)")
_BETWEEN_WORDS = re.compile(r"(?<=\S) (?=\S)")


def space_chunks(text: str) -> list[str]:
    """Parts of a text between single spaces that have other characters on both sides.

    A byte-level pre-tokenizer always begins a new word at such a space, so no token crosses it.
    """
    # Most texts have no white space but spaces and line breaks, none beside a space: that is told fast.
    edges = "  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " "
    if (edges or _RARE_WHITE.search(text)) and _BESIDE_SPACE.search(text):
        return _BETWEEN_WORDS.split(text)
    return text.split(" ")


def parts_again(chunk: str) -> bool:
    """Whether the chunk's ids can be told from those of other chunks when the library gets them parted by spaces.

    It holds no space, so its first token alone begins with one; other white space within makes no difference.
    """
    return chunk.isalpha() or chunk != "" and " " not in chunk and chunk == chunk.strip()


def word_and_marks(chunk: str) -> tuple[str, str] | None:
    """The letters of a chunk and the marks behind them, if it is no more than that."""
    found = None if chunk.isalpha() else _WORD_AND_MARKS.fullmatch(chunk)
    return found and found.groups()


def parts_marks(library) -> bool:
    """Whether the tokenizer parts letters from marks behind them before it looks for tokens."""
    described = json.loads(library.to_str())
    before = described["pre_tokenizer"] or {}
    return before.get("type") == "ByteLevel" and before.get("use_regex", True) and described["normalizer"] is None \
        and not any(_WORD_AND_MARKS.fullmatch(token["content"]) for token in described["added_tokens"])


_tables: dict[str, tuple[ChunkTable, ChunkTable]] = {}


def _worker_tables(tokenizer: str) -> tuple[ChunkTable, ChunkTable]:
    """The worker's tables of chunks after a space, and of chunks that begin a text."""
    if tokenizer not in _tables:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on every core already
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(tokenizer)

        def encode(texts: list[str], before: str = "") -> list[list[int]]:
            return [e.ids for e in library.encode_batch_fast([before + t for t in texts], add_special_tokens=False)]

        begins = np.zeros(library.get_vocab_size(), bool)
        begins[[i for token, i in library.get_vocab().items() if token.startswith("Ġ")]] = True  # the byte of a space
        cut, ends = (word_and_marks, ChunkTable(joined(encode, begins, lambda c: False), max_chunks=50_000)) \
            if parts_marks(library) else (None, None)
        _tables[tokenizer] = (
            ChunkTable(joined(lambda texts: encode(texts, " "), begins, parts_again),
                       700_000, cut, ends),
            ChunkTable(joined(encode, begins, lambda c: False), max_chunks=50_000))
    return _tables[tokenizer]


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = END_ID) -> None:
    """Write the ids of every whole text under ``path``, in ascending ``doc_id`` (null first; equal ids together).

    Null texts count as empty; they and empty texts have the end id alone.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spaced, first = _worker_tables(tokenizer)
        start = 0
        for batch in batches:
            column = batch.column(1)
            for part in slices(column, 2 * SLICE_BYTES):
                heads, rest, counts = [], [], []
                for value in column.slice(part.lo, part.n).to_pylist():
                    chunks = space_chunks(value or "")
                    heads.append(chunks[0])
                    rest += spaced.rows(chunks[1:])
                    counts.append(len(chunks) - 1)
                head_ids, head_length = first.ids(heads)
                rest_ids, rest_length = spaced.ids_of(rest)
                ends = np.concatenate([[0], np.cumsum(rest_length)])[np.cumsum(counts)]
                rest_length = np.diff(ends, prepend=0)
                tail = 0 if end_id is None else 1
                length = head_length + rest_length + tail
                begin = np.cumsum(length) - length
                flat = np.full(int(length.sum()), end_id or 0, np.int32)
                flat[places(begin, head_length)] = head_ids
                flat[places(begin + head_length, rest_length)] = rest_ids
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(part.lo, part.n), pa.array(start + begin, pa.int64()),
                    pa.array(length, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(np.append(begin, len(flat)), pa.int32()), pa.array(flat))],
                    ["doc_id", "start_in_file", "n_tokens", "ids"])
                start += len(flat)

    # Rows of one doc_id are in order of their texts, and may lie in several files.
    tie = F.xxhash64("text").alias("__tie")
    (docs.select(F.col("doc_id").cast("long"), "text", tie).repartitionByRange("doc_id", "__tie")
     .sortWithinPartitions("doc_id", "__tie", "text").drop("__tie").mapInArrow(encode, _FILES).write.mode("error").options(**ORC_OPTIONS).orc(path))


def file_offsets(spark: SparkSession, path: str) -> DataFrame:
    """file, before: how many ids the files before it hold. One row per file, from the two short columns."""
    rows = spark.read.schema(_FILES).orc(path)
    part = F.regexp_extract("file", r"part-(\d+)", 1).cast("long")
    files = rows.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.max(F.col("start_in_file") + F.col("n_tokens")).alias("total"))
    return files.select("file", (F.sum("total").over(Window.orderBy(part)) - F.col("total")).alias("before"))


def read_token_files(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """doc_id, start_in_file, n_tokens, ids and file; ``doc_ids`` prunes stripes and row groups by the files' metadata.

    With :func:`file_offsets` joined on file, before + start_in_file is the number of ids of all documents before.
    """
    rows = spark.read.schema(_FILES).orc(path).select("*", F.col("_metadata.file_name").alias("file"))
    return rows if doc_ids is None else rows.where(F.col("doc_id").isin(doc_ids))


def with_crc32(tokens: DataFrame) -> DataFrame:
    """Adds ids_crc32: of the ids as little-endian unsigned 32-bit integers, in place of the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("ids"))
            values = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            offsets = lists.offsets.to_numpy()
            crc = [zlib.crc32(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(crc, pa.int64())],
                                             ["doc_id", "start_in_file", "n_tokens", "file", "ids_crc32"])

    return tokens.select("doc_id", "start_in_file", "n_tokens", "file", "ids").mapInArrow(
        run, "doc_id long, start_in_file long, n_tokens int, file string, ids_crc32 long")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token files of all ``documents``, read back: position, length and checksum of each document's ids."""
    import public_tokenizers

    path = new_path(spark, "token-files")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    write_token_files(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    sums = with_crc32(read_token_files(spark, path)).join(file_offsets(spark, path), "file")
    return sums.select("doc_id", (F.col("before") + F.col("start_in_file")).alias("start"),
                       F.col("n_tokens").cast("long").alias("n_tokens"), "ids_crc32")
