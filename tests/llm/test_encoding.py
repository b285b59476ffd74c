from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from sedimenta.llm.chunk_table import ChunkTable, joined
from sedimenta.llm import op7_token_files as op7
from sedimenta.llm.op7_token_files import file_offsets, read_token_files, space_chunks, with_crc32, write_token_files
from sedimenta.llm.op9_sentencepiece import decode, encode, marked_words
from sedimenta.scratch import new_path

from .cases import DOCS, clashing, frame, odd_rows

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def test_pieces_equal_the_library(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = decode(encode(clashing(frame(spark), "ids", "decoded", "begin"), PIECES), PIECES).collect()
    assert len(rows) == len(odd_rows())
    for row in rows:
        ids = library.encode(row.text or "")
        assert row.ids == ids and row.decoded == library.decode(ids) and row.begin == "x"


def test_pieces_of_an_empty_table(spark):
    assert encode(frame(spark, []), PIECES).count() == 0
    assert decode(encode(frame(spark, []), PIECES), PIECES).columns[-1] == "decoded"


@pytest.mark.parametrize("text", ["", " ", "a", " a", "a  b", "▁a b▁", "a\nb c", "  "])
def test_marked_words_join_again(text):
    words = marked_words(text)
    assert "".join("▁" + w for w in words) == "▁" + text.replace(" ", "▁")


@pytest.mark.parametrize("text", ["", " ", "a", " a", "a  b c", "a \nb c d", "x y\t z"])
def test_space_chunks_join_again(text):
    assert " ".join(space_chunks(text)) == text


def test_table_keeps_ids_right_beyond_its_size():
    calls = []

    def segment(chunks):
        calls.append(len(chunks))
        return np.array([ord(x) for c in chunks for x in c], np.int32), np.array([len(c) for c in chunks])

    table = ChunkTable(segment, max_chunks=4)
    for chunks in (["a", "b", "a"], ["c", "dd", "a"], ["eee", "f", "a", "b", "g", "h"], [], ["a", "eee"]):
        ids, length = table.ids(chunks)
        assert ids.tolist() == [ord(x) for c in chunks for x in c] and length.tolist() == [len(c) for c in chunks]
    assert len(calls) >= 3


def test_each_word_goes_to_the_library_once_whatever_marks_follow_it(monkeypatch):
    monkeypatch.setattr(op7, "_tables", {})
    calls = []

    def counted(encode, *more):
        return joined(lambda texts, *rest: calls.append(texts) or encode(texts, *rest), *more)

    monkeypatch.setattr(op7, "joined", counted)
    spaced, _ = op7._worker_tables(BYTES)
    spaced.ids(["word", "word.", "word,", "other.\nline", "two\nlines", "word!!", "more", "more."])
    asked = [x for texts in calls for t in texts for x in t.split(" ")]
    assert sorted(asked) == sorted(["word", "other.\nline", "two\nlines", "more", ".", ",", "!!"])
    assert len(calls[0]) == 1  # all chunks after a space in one text, those with line breaks too


def test_chunks_have_the_ids_of_the_library():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTES)
    first, rng = op7._worker_tables(BYTES), random.Random(1)
    texts = ["".join(rng.choice("ab é.,'s't$_²5\n\t  ñ-\u2003x\u0301!") for _ in range(rng.randrange(60))) for _ in range(3000)]
    for text in [*texts, "x<|endoftext|>y, a<|endoftext|> b.", "don't we'll, I'm. it's's l'été' 'tis rock'n'roll", "a.\nb c \n d"]:
        head, *rest = space_chunks(text)
        ids = [*first[1].ids([head])[0].tolist(), *first[0].ids(rest)[0].tolist()]
        assert ids == library.encode(text, add_special_tokens=False).ids, text


def test_token_files_round_trip(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTES)
    path = new_path(spark, "tokens")
    rows = [(None, "no id", "en", "s", 1), *odd_rows()]
    write_token_files(clashing(frame(spark, rows), "ids", "start"), path, BYTES)
    found = with_crc32(read_token_files(spark, path)).join(file_offsets(spark, path), "file")
    got = {(r.doc_id, r.n_tokens, r.ids_crc32): r.before + r.start_in_file for r in found.collect()}
    start, want = 0, {}
    for doc_id, text, *_ in sorted(rows, key=lambda r: -1 if r[0] is None else r[0]):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        want[doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] = start
        start += len(ids)
    repeated = [k for k in want if k[0] == 16]
    assert {k: v for k, v in got.items() if k not in repeated} == {k: v for k, v in want.items() if k not in repeated}
    assert got.keys() == want.keys()
    one = read_token_files(spark, path, [7])
    assert [r.ids for r in one.collect()] == [library.encode("two words").ids + [2]]
    assert "PushedFilters: [In(doc_id" in one._jdf.queryExecution().toString() or "EqualTo(doc_id,7)" in \
        one._jdf.queryExecution().toString()


def test_token_files_of_an_empty_table(spark):
    path = new_path(spark, "tokens")
    write_token_files(frame(spark, []), path, BYTES)
    assert read_token_files(spark, path).count() == 0


def test_digest_is_of_decimal_ids(spark):
    from sedimenta.llm.queries import QUERIES

    row = QUERIES["op9_sentencepiece"](spark, "/root/testdata/sf0.001").orderBy("doc_id").first()
    import sentencepiece

    text = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").first().text
    ids = sentencepiece.SentencePieceProcessor(model_file=PIECES).encode(text)
    assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert DOCS
