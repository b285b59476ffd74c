"""SentencePiece encoding and decoding by a table of distinct chunks.

A model whose pieces never hold a white space marker after another character cannot join characters across the start
of a marked word. Its texts are then cut before each run of markers, each distinct marked word is segmented once by
the library, and the ids join back to the texts by position. A task keeps one table for all its batches: most distinct
words of a corpus occur once or twice, so shuffling every position to a global table would move several times the
input to save little (README).
A model whose pieces do cross markers gets every text as a chunk of its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .chunk_table import ChunkTable, joined
from .text import slices, tidy

MARK = "▁"
_MARKED = re.compile(f"{MARK}+[^{MARK}]*")


def _processor(model: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model)


def _table(model: str):
    """A table for the model, and how texts are cut."""
    processor = _processor(model)
    pieces = [processor.id_to_piece(i) for i in range(processor.get_piece_size())]
    begins = np.array([p.startswith(MARK) for p in pieces])
    splits = splits_at_markers(processor)
    segment = joined(lambda texts: processor.encode(texts, num_threads=1), begins,
                     lambda c: splits and c != "" and MARK not in c and " " not in c)
    return ChunkTable(segment, max_chunks=250_000), marked_words if splits else lambda s: [s]


def splits_at_markers(processor) -> bool:
    """Whether no piece crosses into the next marked word and texts are normalised only by adding markers."""
    crossing = re.compile(f"[^{MARK}]{MARK}")
    if any(crossing.search(processor.id_to_piece(i)) for i in range(processor.get_piece_size())):
        return False
    probe = " a  b\tc\n d "  # a marker in front, one for each space, and nothing else
    return "".join(processor.encode(probe, out_type=str)).replace("<0x09>", "\t").replace("<0x0A>", "\n") \
        == (MARK + probe).replace(" ", MARK)


def marked_words(text: str) -> list[str]:
    """Marked words without their first marker, which encoding adds again.

    A single marker at the end stays with the word before: alone it would be an empty text, which gets no marker.
    """
    marked = text.replace(" ", MARK)
    if MARK * 2 in marked or marked.startswith(MARK):
        found = [word[1:] for word in _MARKED.findall(MARK + marked)]
    else:
        found = marked.split(MARK)
    if found[-1] == "" and len(found) > 1:
        found[-2:] = [found[-2] + MARK]
    return found


def encode(docs: DataFrame, model: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds ``ids`` array<int>, as the library encodes each whole text (no begin or end ids, no sampling).

    Null texts count as empty, and empty texts have no ids. Other columns stay as they are; a column that already
    has the name ``ids`` is replaced.
    """
    kept = [c for c in docs.columns if c != ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, cut = _table(model)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            for part in slices(column):
                chunks, counts = [], []
                for value in column.slice(part.lo, part.n).to_pylist():
                    found = cut(value) if value else []
                    chunks += found
                    counts.append(len(found))
                flat, length = table.ids(chunks)
                per_text = np.concatenate([[0], np.cumsum(length)])[np.concatenate([[0], np.cumsum(counts)])]
                lists = pa.ListArray.from_arrays(pa.array(per_text, pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(batch.schema.get_field_index(c)).slice(part.lo, part.n) for c in kept), lists],
                    [*kept, ids])

    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(ids, T.ArrayType(T.IntegerType()))])
    return docs.select(kept).mapInArrow(tidy(run), schema)


def decode(tokens: DataFrame, model: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds the text that the library's decode gives for each row's ids; null ids give an empty text."""
    kept = [c for c in tokens.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        processor = _processor(model)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids))
            for lo in range(0, batch.num_rows, 500):
                some = lists.slice(lo, 500).to_pylist()
                decoded = [processor.decode(x) if x else "" for x in some]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(batch.schema.get_field_index(c)).slice(lo, 500) for c in kept),
                     pa.array(decoded, pa.string())], [*kept, text])

    schema = T.StructType([tokens.schema[c] for c in kept] + [T.StructField(text, T.StringType())])
    return tokens.mapInArrow(tidy(run), schema)


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents``, encoded and decoded: lengths and digests."""
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    done = decode(encode(docs, model).drop("text"), model)
    return done.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
