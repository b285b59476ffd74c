"""Op 11: the alignment of two tokenizers against a plain two-pointer walk over whole texts."""

from __future__ import annotations

import random
from collections import Counter
from functools import reduce

import numpy as np
import public_tokenizers
import pytest

from sedimenta.llm import op11_alignment as op
from .cases import clashing, frame, odd_rows

BYTE_LEVEL, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain(texts):
    """n_a, n_b, groups and links of each text, by whole-text calls of the libraries."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_side = Tokenizer.from_file(BYTE_LEVEL)
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    byte_of = op._byte_values()
    out = []
    for text in texts:
        groups, links = [], []
        if text:
            found = a_side.encode(" " + text, add_special_tokens=False)
            a, b = found.ids, b_side.encode(text)
            a_bytes = [bytes(byte_of[c] for c in a_side.id_to_token(i)) for i in a]
            b_bytes = [bytes([int(b_side.id_to_piece(i)[3:5], 16)]) if b_side.is_byte(i)
                       else b_side.id_to_piece(i).replace("▁", " ").encode() for i in b]
            if b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
                ends_a, ends_b = np.cumsum([len(x) for x in a_bytes]).tolist(), np.cumsum([len(x) for x in b_bytes]).tolist()
                i = k = 0
                group = ([], [])
                while i < len(a):
                    links.append((a[i] << 32) | b[k])
                    step_a, step_b = ends_a[i] <= ends_b[k], ends_b[k] <= ends_a[i]
                    if step_a:
                        group[0].append(a[i])
                    if step_b:
                        group[1].append(b[k])
                    i, k = i + step_a, k + step_b
                    if step_a and step_b:
                        groups.append(op.group_text(*group))
                        group = ([], [])
        out.append((groups, links))
    return out


def expected(rows):
    found = plain([r[1] for r in rows])
    count = Counter(x for _, links in found for x in links)
    highest = Counter()
    for pair, n in count.items():
        highest[pair & 0xFFFFFFFF] = max(highest[pair & 0xFFFFFFFF], n)
    out = []
    for row, (groups, links) in zip(rows, found):
        ids = [g.split("|") for g in groups]
        out.append((row[0], sum(a.count(",") + 1 for a, _ in ids), sum(b.count(",") + 1 for _, b in ids), len(groups),
                    ";".join(groups), len(links), sum(count[x] == highest[x & 0xFFFFFFFF] for x in links), sum(count[x] for x in links)))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "groups", "n_links", "n_best", "count_sum"]


def aligned(docs, **sizes):
    return sorted((tuple(r) for r in op.align_with_counts(docs, BYTE_LEVEL, PIECES, **sizes).select(COLUMNS).collect()), key=repr)


def test_odd_rows_match_a_plain_walk(spark):
    """Nulls, empty and very long texts, ties and repeated rows, special tokens' strings, text with the marker itself."""
    rows = odd_rows() + [(None, "no id here", None, None, None), (20, "it's  2024 -- x\u001cy\n\nz don't", "en", "s", 1),
                         (21, "<|endoftext|> <s> [UNK] <0x41>", "en", "s", 1), (22, "\U0001f600 é​ " * 3, "en", "s", 1)]
    assert len([r for r in rows if r[1] and len(r[1]) > op.PART_BYTES]) == 1
    assert aligned(clashing(frame(spark, rows), "row", "part", "pairs", "groups")) == expected(rows)


def test_long_texts_fold_over_tasks(spark):
    """With small parts, ranges and joins most texts pass several rounds; the results are the same."""
    rows = [r for r in odd_rows() if r[0] != 9] + [(23, "word " * 300 + "▁", "en", "s", 1), (24, "x" * 3000, "en", "s", 1)]
    assert aligned(frame(spark, rows), part_bytes=60, range_bytes=16, fan=3) == expected(rows)


def test_tables(spark):
    empty = frame(spark, [])
    assert aligned(empty) == []
    assert op.align_with_counts(empty, BYTE_LEVEL, PIECES).schema.simpleString().startswith("struct<row:bigint,doc_id:bigint")


def test_a_full_table_forgets(spark):
    words = op._Words(op.sides(BYTE_LEVEL, PIECES), most=3)
    texts = ["one two three four", "five six one two two", "", "a▁b seven two", "seven two " + "x" * 90, "two " + "x" * 90]
    for text in texts * 2:
        folded = words.fold([op.words_of(text) if text else []])
        groups, links = plain([text])[0]
        assert (folded[1][0], int(folded[0][0][2]), len(folded[2])) == (";".join(groups), len(groups), len(links))


@pytest.mark.parametrize("seed", range(20))
def test_join_is_associative(seed):
    """Any bracketing of any cuts gives the fragment of the whole, and the empty fragment changes nothing."""
    rng = random.Random(seed)
    lengths = (np.array([1, 2, 3, 4]), np.array([1, 2, 3, 5]))
    total = rng.randint(1, 60)

    def tokens(n):
        ids = []
        while total - sum(n[i] for i in ids):
            ids.append(rng.choice([i for i in range(4) if n[i] <= total - sum(n[i] for i in ids)]))
        return np.array(ids), np.cumsum(n[ids])

    (a, ends_a), (b, ends_b) = (tokens(n) for n in lengths)
    limits = sorted(rng.sample(range(total + 1), min(4, total + 1)))
    cuts = [[0, *np.searchsorted(e, limits, "right").tolist(), len(e)] for e in (ends_a, ends_b)]
    parts = [op.fragment(a[i:k], b[p:q], ends_a[i:k], ends_b[p:q])
             for i, k, p, q in zip(cuts[0], cuts[0][1:], cuts[1], cuts[1][1:])]

    def join(x, y):
        return op.join_fragments(x, y, lengths)

    def seen(f):
        return f.cut, f.prefix, ";".join(f.groups), f.counts, f.pairs.tolist(), f.suffix

    whole = seen(op.fragment(a, b, ends_a, ends_b))
    assert seen(reduce(join, parts)) == whole
    assert seen(reduce(lambda x, y: join(y, x), reversed(parts))) == whole
    while len(parts) > 1:
        k = rng.randrange(len(parts) - 1)
        parts[k : k + 2] = [join(join(op.EMPTY, parts[k]), join(parts[k + 1], op.EMPTY))]
    assert seen(parts[0]) == whole
    done = op.closed(parts[0], lengths)
    assert done.suffix == ([], []) and done.counts[:2] == (len(a), len(b))
    assert len(done.pairs) == len(a) + len(b) - done.counts[2]
