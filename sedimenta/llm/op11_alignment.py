"""Alignment of two tokenizers' ids, as a fold of fragments that can be joined in any grouping.

Both tokenizers cut the same bytes, a space and the text. A group is what lies between two neighbouring byte offsets at
which tokens of both end. A *fragment* says what is known of a range of bytes from the tokens that end in it: the tokens
up to its first common end (open prefix), the closed groups, and the tokens after its last common end (open suffix); a
range without a common end is all prefix. Two neighbouring fragments join by closing the left suffix with the right
prefix. That is associative, so fragments of one text may be joined in any bracketing, by a tree over Spark tasks.

Short texts are one fragment, folded in the task that reads them. Their words, cut where no token of either tokenizer
crosses, are segmented and grouped once for each task and joined by reference. Long texts are cut at such places into
parts that are encoded in tasks of their own; each part gives fragments of fixed ranges of bytes, which begin and end
anywhere in a token, and rounds of grouped joins over neighbouring fragments fold them to one.

Links are the pairs of tokens whose bytes overlap: a closed group of n and m tokens has n + m - 1. How often an id pair
is linked in the corpus, and which partner of an id is its most frequent, is counted over all documents' links; each
document's sums over its links come from there. Pairs that make up more than a 65,536th of all links are at most 65,536:
they are looked up in a broadcast, all others by a join.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .chunk_table import places
from .op7_token_files import space_chunks
from .op9_sentencepiece import MARK, splits_at_markers
from .staging import discard, stage_lean
from .text import slices

PART_BYTES = 1 << 16  # texts up to this are one fragment; longer ones are cut into parts of about so much
RANGE_BYTES = 1 << 14  # of a long text's fragments
FAN = 32  # neighbouring fragments that one join takes
HOT = 1 << 16
_MOST_WORDS = 200_000  # that a worker keeps segmented
_MOST_LETTERS = 4_000_000

_BETWEEN = re.compile(r"(?<=\S) (?=\S)")
_WHITE = re.compile(r"\s")

_PAIRS = "array<struct<pair: bigint, n: int>>"
_FIELDS = {"row": "long", "part": "long", "ok": "boolean", "cut": "boolean", "n_a": "long", "n_b": "long", "n_groups": "long",
           "groups": "string", "prefix_a": "array<int>", "prefix_b": "array<int>", "suffix_a": "array<int>",
           "suffix_b": "array<int>", "pairs": _PAIRS}
_FRAGMENT = ", ".join(f"{name} {kind}" for name, kind in _FIELDS.items())


def _byte_values() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones themselves, others in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


@dataclass(frozen=True)
class Sides:
    """Both tokenizers: how texts are encoded, the bytes of every id, and whether texts may be cut between words."""

    encode: tuple[Callable[[list[str]], list[list[int]]], Callable[[list[str]], list[list[int]]]]
    token_bytes: tuple[list[bytes], list[bytes]]
    begins: tuple[np.ndarray, np.ndarray]
    splits: bool


_loaded: dict[tuple[str, str], Sides] = {}


def sides(byte_level: str, pieces: str) -> Sides:
    """The tokenizers of two files, loaded once for each worker.

    A is byte-level and encodes a space and the text, with the strings of special tokens as plain text. B is a
    SentencePiece model, which adds the space itself.
    """
    if (byte_level, pieces) not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on every core already
        import sentencepiece
        from tokenizers import Tokenizer

        a = Tokenizer.from_file(byte_level)
        a.encode_special_tokens = True
        b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        values = _byte_values()
        of_a: list[bytes] = [b""] * a.get_vocab_size()
        begins_a = np.zeros(len(of_a), bool)
        for token, k in a.get_vocab().items():
            of_a[k] = bytes(values[c] for c in token) if all(c in values for c in token) else token.encode()
            begins_a[k] = of_a[k][:1] == b" "
        of_b, begins_b = [], np.zeros(b.get_piece_size(), bool)
        for k in range(b.get_piece_size()):
            piece = b.id_to_piece(k)
            of_b.append(bytes([int(piece[3:5], 16)]) if b.is_byte(k) else piece.replace(MARK, " ").encode())
            begins_b[k] = piece.startswith(MARK)
        _loaded[byte_level, pieces] = Sides(
            (lambda texts: [e.ids for e in a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)],
             lambda texts: b.encode(texts, num_threads=1)),
            (of_a, of_b), (begins_a, begins_b), splits_at_markers(b))
    return _loaded[byte_level, pieces]


def words_of(text: str, splits: bool = True) -> list[str]:
    """The text cut at each space between two other characters: no token of either tokenizer crosses the start of such a space."""
    return space_chunks(text) if splits else [text]


@dataclass
class Fragment:
    """What is known of a range of bytes: the open prefix and suffix as ids of A and of B, and the closed groups' text,
    number of ids of A, of B and of groups, and linked pairs (a << 32 | b), each occurrence."""

    cut: bool
    prefix: tuple[list[int], list[int]]
    groups: list[str]
    counts: tuple[int, int, int]
    pairs: np.ndarray
    suffix: tuple[list[int], list[int]]


_NONE = np.zeros(0, np.int64)
EMPTY = Fragment(False, ([], []), [], (0, 0, 0), _NONE, ([], []))
_BEGUN = Fragment(True, ([], []), [], (0, 0, 0), _NONE, ([], []))
Lengths = tuple[np.ndarray, np.ndarray]


def overlaps(a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """The linked pairs of tokens that cover the same bytes, in order."""
    last = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")  # two sorted runs
    last = last[np.append(last[1:] != last[:-1], True)] - 1 if len(last) else last  # the last byte of each overlap
    return (a[np.searchsorted(ends_a, last, "right")].astype(np.int64) << 32) | b[np.searchsorted(ends_b, last, "right")]


def group_text(a: list[int], b: list[int]) -> str:
    return ",".join(map(str, a)) + "|" + ",".join(map(str, b))


def join_fragments(left: Fragment, right: Fragment, lengths: Lengths) -> Fragment:
    """The fragment of both ranges. ``EMPTY`` changes nothing."""
    if not left.cut:
        prefix = (left.prefix[0] + right.prefix[0], left.prefix[1] + right.prefix[1])
        return Fragment(right.cut, prefix, right.groups, right.counts, right.pairs, right.suffix)
    a, b = left.suffix[0] + right.prefix[0], left.suffix[1] + right.prefix[1]
    if not right.cut:
        return Fragment(True, left.prefix, left.groups, left.counts, left.pairs, (a, b))
    ids = np.array(a, np.int64), np.array(b, np.int64)
    middle = overlaps(*ids, *(np.cumsum(n[x]) for n, x in zip(lengths, ids)))
    counts = tuple(x + y + z for x, y, z in zip(left.counts, (len(a), len(b), 1), right.counts))
    return Fragment(True, left.prefix, [*left.groups, group_text(a, b), *right.groups], counts,
                    np.concatenate([left.pairs, middle, right.pairs]), right.suffix)


def grouped(a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The common ends of two token sequences, and how many tokens of each end up to each of them."""
    every = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
    common = every[1:][every[1:] == every[:-1]]
    return common, np.searchsorted(ends_a, common, "right"), np.searchsorted(ends_b, common, "right")


def fragment(a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> Fragment:
    """The fragment of the tokens that end in one range, from their ids and byte ends."""
    common, at_a, at_b = grouped(a, b, ends_a, ends_b)
    la, lb = a.tolist(), b.tolist()
    if not len(common):
        return Fragment(False, (la, lb), [], (0, 0, 0), _NONE, ([], []))
    i, k, p, q = int(at_a[0]), int(at_a[-1]), int(at_b[0]), int(at_b[-1])
    texts = [group_text(la[w:x], lb[y:z]) for w, x, y, z in zip(at_a.tolist(), at_a[1:].tolist(), at_b.tolist(), at_b[1:].tolist())]
    pairs = overlaps(a[i:k], b[p:q], ends_a[i:k], ends_b[p:q])
    return Fragment(True, (la[:i], lb[:p]), texts, (k - i, q - p, len(texts)), pairs, (la[k:], lb[q:]))


def closed(found: Fragment, lengths: Lengths) -> Fragment:
    """The fragment of a whole text: it begins at a common end, so its prefix is a group."""
    return join_fragments(_BEGUN, found, lengths)


class _Vocabulary:
    """One side's ids for NumPy: the bytes of every id end to end, their number, and the id in decimal before a separator."""

    def __init__(self, token_bytes: list[bytes], last: str):
        self.size = np.array([len(x) for x in token_bytes], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(token_bytes), np.uint8)
        self.within = np.array([f"{k}," for k in range(len(token_bytes))], object)
        self.at_end = np.array([f"{k}{last}" for k in range(len(token_bytes))], object)

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        return self.flat[places(self.start[ids], self.size[ids])]

    def named(self, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Each id in decimal with a comma, at the (exclusive) ends of groups with the other separator."""
        out = self.within[ids]
        out[ends - 1] = self.at_end[ids[ends - 1]]
        return out


class _Words:
    """A worker's words with their ids and groups.

    Full, it keeps the words that came more than once, half its size at most; results do not depend on what it holds.
    """

    def __init__(self, both: Sides, most: int = _MOST_WORDS):
        self.both = both
        self._most = most
        self._vocabularies = [_Vocabulary(names, last) for names, last in zip(both.token_bytes, "|;")]
        self._width = len(both.token_bytes[1])
        self._row: dict[str, int] = {}
        self._texts: list[str] = []  # each with a separator at its end
        self._numbers = np.zeros((0, 4), np.int64)  # ids of A, of B, groups, and 1 if the bytes are the word's
        self._codes = self._start = self._size = self._uses = _NONE
        self._letters = 0

    def _shrink(self) -> None:
        often = np.flatnonzero(self._uses > 1)
        often = often[np.argsort(-self._uses[often], kind="stable")][: self._most // 2]
        names = list(self._row)
        keep = [k for k in often.tolist() if len(names[k]) <= 64]
        at = np.array(keep, np.int64)
        self._codes = self._codes[places(self._start[at], self._size[at])]
        self._numbers, self._size = self._numbers[at], self._size[at]
        self._start = np.cumsum(self._size) - self._size
        self._uses = np.zeros(len(at), np.int64)
        self._texts = [self._texts[k] for k in keep]
        self._row = {names[k]: row for row, k in enumerate(keep)}
        self._letters = sum(map(len, self._row))

    def _segmented(self, plain: list[str], others: list[str], side: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words end to end, and how many each has. Plain words go to the library side by side, parted by
        a space: their ids part where one begins with it."""
        encode, begins = self.both.encode[side], self.both.begins[side]
        lists = encode([" ".join(plain[k : k + 1000]) for k in range(0, len(plain), 1000)] + others)
        apart = len(lists) - len(others)
        flat = np.fromiter(chain.from_iterable(lists[:apart]), np.int64)
        cuts = np.flatnonzero(begins[flat])
        if len(cuts) != len(plain):  # the model isn't as described
            lists, apart, flat, cuts = encode(plain) + lists[apart:], 0, _NONE, _NONE
        sizes = np.concatenate([np.diff(np.append(cuts, len(flat))), np.array([len(x) for x in lists[apart:]], np.int64)])
        return np.concatenate([flat, np.fromiter(chain.from_iterable(lists[apart:]), np.int64)]), sizes

    def _spelled(self, words: list[str], flat: list[np.ndarray], sizes: list[np.ndarray]) -> np.ndarray:
        """Whether the joined bytes of both sides' tokens are a space and the word."""
        wanted = "".join([f" {w}" for w in words]).encode()
        spelled = [v.spelled(ids) for v, ids in zip(self._vocabularies, flat)]
        lengths = [np.diff(np.append(0, np.cumsum(v.size[ids]))[np.append(0, np.cumsum(n))])
                   for v, ids, n in zip(self._vocabularies, flat, sizes)]
        if np.array_equal(*lengths) and all(x.tobytes() == wanted for x in spelled):
            return np.ones(len(words), bool)
        cuts = [np.append(0, np.cumsum(n)).tolist() for n in lengths]
        return np.array([all(x[c[k] : c[k + 1]].tobytes() == b" " + w.encode() for x, c in zip(spelled, cuts))
                         for k, w in enumerate(words)])

    def _add(self, words: list[str]) -> None:
        alike = [self.both.splits and w != "" and MARK not in w and not _WHITE.search(w) for w in words]
        plain, others = [w for w, x in zip(words, alike) if x], [w for w, x in zip(words, alike) if not x]
        words = plain + others
        found = [self._segmented(plain, others, side) for side in (0, 1)]
        flat, sizes = [f[0] for f in found], [f[1] for f in found]
        ok = self._spelled(words, flat, sizes)
        # Of words whose bytes fit, one after the other, every word begins and ends at a common end.
        flat = [ids[np.repeat(ok, n)] for ids, n in zip(flat, sizes)]
        sizes = [np.where(ok, n, 0) for n in sizes]
        ends = [np.cumsum(v.size[ids]) for v, ids in zip(self._vocabularies, flat)]
        common, at_a, at_b = grouped(*flat, *ends)
        word_ends = np.append(0, ends[0])[np.cumsum(sizes[0])]
        groups = np.diff(np.searchsorted(common, word_ends, "right"), prepend=0)
        links = overlaps(*flat, *ends)
        n_links = sizes[0] + sizes[1] - groups
        self._texts += self._spell(flat, at_a, at_b, sizes)
        self._row.update(zip(words, range(len(self._row), len(self._row) + len(words))))
        self._letters += sum(map(len, words))
        self._numbers = np.concatenate([self._numbers, np.stack([*sizes, groups, ok.astype(np.int64)], 1)])
        self._start = np.concatenate([self._start, len(self._codes) + np.cumsum(n_links) - n_links])
        self._size = np.concatenate([self._size, n_links])
        self._uses = np.concatenate([self._uses, np.zeros(len(words), np.int64)])
        self._codes = np.concatenate([self._codes, (links >> 32) * self._width + (links & 0xFFFFFFFF)])

    def _spell(self, flat: list[np.ndarray], at_a: np.ndarray, at_b: np.ndarray, sizes: list[np.ndarray]) -> list[str]:
        """The text of each word's groups: of each group the ids of A, then those of B."""
        out = np.empty(len(flat[0]) + len(flat[1]), object)
        n_a, n_b = np.diff(at_a, prepend=0), np.diff(at_b, prepend=0)
        out[np.arange(len(flat[0])) + np.repeat(at_b - n_b, n_a)] = self._vocabularies[0].named(flat[0], at_a)
        out[np.arange(len(flat[1])) + np.repeat(at_a, n_b)] = self._vocabularies[1].named(flat[1], at_b)
        pieces, cuts = out.tolist(), [0, *np.cumsum(sizes[0] + sizes[1]).tolist()]
        return ["".join(pieces[i:k]) for i, k in zip(cuts, cuts[1:])]

    def fold(self, texts: list[list[str]]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """Of each text, given as its words: ok and the numbers of ids of A, of B and of groups; the groups' text; and the
        codes of all linked pairs with the text they are in. A text whose bytes differ has none."""
        words = list(chain.from_iterable(texts))
        if len(self._row) > self._most or self._letters > _MOST_LETTERS:
            self._shrink()
        new = list(set(words).difference(self._row))
        if new:
            self._add(new)
        at = list(map(self._row.__getitem__, words))
        rows = np.array(at, np.int64)
        self._uses += np.bincount(rows, minlength=len(self._uses))
        counts = np.array([len(of) for of in texts], np.int64)
        owner = np.repeat(np.arange(len(texts)), counts)
        numbers = np.diff(np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(self._numbers[rows], 0)])[
            np.append(0, np.cumsum(counts))], axis=0)
        ok = numbers[:, 3] == counts
        numbers[~ok] = 0
        spelled, named, lo = list(map(self._texts.__getitem__, at)), [], 0
        for n, fits in zip(counts.tolist(), ok.tolist()):
            named.append("".join(spelled[lo : lo + n])[:-1] if fits else "")
            lo += n
        if not ok.all():
            rows, owner = rows[ok[owner]], owner[ok[owner]]
        return numbers, named, self._codes[places(self._start[rows], self._size[rows])], np.repeat(owner, self._size[rows])


def _counted(codes: np.ndarray, owner: np.ndarray, n: int, width: int) -> pa.Array:
    """For each of n texts its distinct pairs and how often each occurs, from codes a * width + b."""
    bits = int(codes.max()).bit_length() if len(codes) else 0
    if bits + n.bit_length() < 63:
        keys = np.sort((owner << bits) | codes)
        owner, codes = keys >> bits, keys & ((1 << bits) - 1)
    else:
        order = np.lexsort((codes, owner))
        owner, codes = owner[order], codes[order]
    new = np.ones(len(codes), bool)
    new[1:] = (codes[1:] != codes[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(codes))).astype(np.int32)
    a, b = np.divmod(codes[first], width)
    values = pa.StructArray.from_arrays([pa.array((a << 32) | b), pa.array(times)], ["pair", "n"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner[first], np.arange(n + 1)), pa.int32()), values)


def _counted_lists(pairs: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate([_NONE, *pairs])
    width = 1 + int((flat & 0xFFFFFFFF).max()) if len(flat) else 1
    owner = np.repeat(np.arange(len(pairs)), [len(p) for p in pairs])
    return _counted((flat >> 32) * width + (flat & 0xFFFFFFFF), owner, len(pairs), width)


_tables: dict[tuple[str, str], _Words] = {}


def _short(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """row, doc_id and the folded fragment of each text, whose words are looked up in the worker's table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if (byte_level, pieces) not in _tables:
                _tables[byte_level, pieces] = _Words(sides(byte_level, pieces))
            table = _tables[byte_level, pieces]
            for part in slices(batch.column(2)):
                texts = [words_of(t, table.both.splits) if t else [] for t in batch.column(2).slice(part.lo, part.n).to_pylist()]
                numbers, named, codes, owner = table.fold(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.lo, part.n), batch.column(1).slice(part.lo, part.n),
                     *(pa.array(numbers[:, k]) for k in range(3)), pa.array(named, pa.string()),
                     _counted(codes, owner, part.n, len(table.both.token_bytes[1]))],
                    ["row", "doc_id", "n_a", "n_b", "n_groups", "groups", "pairs"])

    return docs.mapInArrow(run, f"row long, doc_id long, n_a long, n_b long, n_groups long, groups string, pairs {_PAIRS}")


def cut_text(text: str, limit: int = PART_BYTES) -> list[str]:
    """A text in parts of ``limit`` characters or more, cut at spaces between two other characters."""
    parts, begin = [], 0
    while found := _BETWEEN.search(text, begin + limit):
        parts.append(text[begin : found.start()])
        begin = found.end()
    return [*parts, text[begin:]]


def _long_parts(docs: DataFrame, byte_level: str, pieces: str, part_bytes: int) -> DataFrame:
    """row, part (0, 1, ...), begin (bytes before it, its space included) and text of the parts of long texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            splits = sides(byte_level, pieces).splits
            for k in range(batch.num_rows):
                text = batch.column(1)[k].as_py()
                parts = cut_text(text, part_bytes) if splits else [text]
                sizes = np.array([len(p.encode()) + 1 for p in parts], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column(0)[k].as_py()] * len(parts), pa.int64()), pa.array(range(len(parts)), pa.int64()),
                     pa.array(np.cumsum(sizes) - sizes), pa.array(parts, pa.string())], ["row", "part", "begin", "text"])

    return docs.select("row", "text").mapInArrow(run, "row long, part long, begin long, text string")


def _as_batch(row: int, parts: list[int], found: list[Fragment], ok: bool) -> pa.RecordBatch:
    ints = pa.list_(pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array([row] * len(found), pa.int64()), pa.array(parts, pa.int64()), pa.array([ok] * len(found)),
         pa.array([f.cut for f in found]), *(pa.array([f.counts[k] for f in found], pa.int64()) for k in range(3)),
         pa.array([";".join(f.groups) for f in found]), *(pa.array([f.prefix[k] for f in found], ints) for k in (0, 1)),
         *(pa.array([f.suffix[k] for f in found], ints) for k in (0, 1)), _counted_lists([f.pairs for f in found])],
        names=list(_FIELDS))


def _fragments(parts: DataFrame, byte_level: str, pieces: str, range_bytes: int) -> DataFrame:
    """The fragments of the parts of long texts, one for each range of ``range_bytes`` of the text that a part touches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = sides(byte_level, pieces)
            lengths = [np.array([len(x) for x in side], np.int64) for side in both.token_bytes]
            for row, part, begin, text in zip(*(c.to_pylist() for c in batch.columns)):
                ids = [np.array(encode([text])[0], np.int64) for encode in both.encode]
                if any(b"".join([names[i] for i in x.tolist()]) != b" " + text.encode() for names, x in zip(both.token_bytes, ids)):
                    yield _as_batch(row, [part << 32], [EMPTY], False)
                    continue
                ends = [begin + np.cumsum(n[x]) for n, x in zip(lengths, ids)]
                first, last = begin // range_bytes, (int(ends[0][-1]) - 1) // range_bytes
                limits = np.arange(first + 1, last + 1) * range_bytes
                cuts = [[0, *np.searchsorted(e, limits, "right").tolist(), len(e)] for e in ends]
                found = [fragment(ids[0][i:k], ids[1][p:q], ends[0][i:k], ends[1][p:q])
                         for i, k, p, q in zip(cuts[0], cuts[0][1:], cuts[1], cuts[1][1:])]
                yield _as_batch(row, [(part << 32) + k for k in range(len(found))], found, True)

    return parts.mapInArrow(run, _FRAGMENT)


def _read_back(table: pa.Table) -> list[tuple[bool, Fragment]]:
    """Fragments of table rows; the closed groups' text stays one string."""
    of = {name: table.column(name).to_pylist() for name in table.column_names if name != "pairs"}
    pairs = table.column("pairs").to_pylist()
    return [(of["ok"][k], Fragment(
        of["cut"][k], (of["prefix_a"][k], of["prefix_b"][k]), [of["groups"][k]] if of["n_groups"][k] else [],
        (of["n_a"][k], of["n_b"][k], of["n_groups"][k]),
        np.repeat(np.array([p["pair"] for p in pairs[k]], np.int64), np.array([p["n"] for p in pairs[k]], np.int64)),
        (of["suffix_a"][k], of["suffix_b"][k]))) for k in range(table.num_rows)]


def _lengths(byte_level: str, pieces: str) -> Lengths:
    return tuple(np.array([len(x) for x in side], np.int64) for side in sides(byte_level, pieces).token_bytes)


def _folded(fragments: DataFrame, byte_level: str, pieces: str, fan: int) -> DataFrame:
    """One fragment for each row: the ranges of a part are joined, then ``fan`` neighbours in each round."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("part")
        lengths = _lengths(byte_level, pieces)
        found = _read_back(group)
        ok = all(fits for fits, _ in found)
        whole = reduce(lambda x, y: join_fragments(x, y, lengths), (f for _, f in found)) if ok else EMPTY
        return pa.Table.from_batches([_as_batch(group.column("row")[0].as_py(), [group.column("place")[0].as_py()], [whole], ok)])

    def joined_by(level: DataFrame, place) -> DataFrame:
        return stage_lean(level.withColumn("place", place).groupBy("row", "place").applyInArrow(run, _FRAGMENT), "fragments")

    level = joined_by(fragments, F.shiftright("part", 32))
    while (level.agg(F.max("part")).first()[0] or 0) > 0:
        done = joined_by(level, F.floor(F.col("part") / fan).cast("long"))
        discard(level)
        level = done
    return level


def _closed(folded: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """The folded fragments of whole texts as rows like those of short ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, (ok, found) in zip(batch.column(0), _read_back(pa.Table.from_batches([batch]))):
                whole = closed(found, _lengths(byte_level, pieces)) if ok else EMPTY
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row.as_py()], pa.int64()), *(pa.array([n], pa.int64()) for n in whole.counts),
                     pa.array([";".join(whole.groups)]), _counted_lists([whole.pairs])],
                    ["row", "n_a", "n_b", "n_groups", "groups", "pairs"])

    return folded.mapInArrow(run, f"row long, n_a long, n_b long, n_groups long, groups string, pairs {_PAIRS}")


def align(docs: DataFrame, byte_level: str, pieces: str, part_bytes: int = PART_BYTES, range_bytes: int = RANGE_BYTES,
          fan: int = FAN) -> DataFrame:
    """row (of its own), doc_id, n_a, n_b, n_groups, groups (``a1,a2|b1;a3|b2,b3``) and linked pairs of every text.

    A pair is ``a << 32 | b`` with the number of its links in the text. Texts that are null, empty, or not spelled by the
    joined bytes of both tokenizers' tokens have no tokens: zeros and an empty text. Repeated rows are rows each. The
    result is a written table.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    is_long = F.coalesce(F.octet_length("text") > part_bytes, F.lit(False))
    short = stage_lean(_short(rows.where(~is_long), byte_level, pieces), "aligned", "zstd")
    texts = stage_lean(rows.where(is_long), "long-texts")
    parts = stage_lean(_long_parts(texts, byte_level, pieces, part_bytes), "long-parts")
    spread = parts.repartition(F.xxhash64("row", "part"))  # a long text's parts go to many tasks
    folded = _folded(_fragments(spread, byte_level, pieces, range_bytes), byte_level, pieces, fan)
    whole = _closed(folded, byte_level, pieces).join(texts.select("row", "doc_id"), "row")
    long = stage_lean(whole.select(*short.columns), "aligned-long")
    discard(texts, parts, folded)
    return short.unionByName(long)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, count (links of all documents that hold it) and whether that is the highest of its B id."""
    counts = stage_lean(aligned.select(F.inline("pairs")).groupBy("pair").agg(F.sum("n").alias("count")), "pair-counts")
    b = F.col("pair").bitwiseAND(0xFFFFFFFF)
    highest = counts.groupBy(b.alias("b")).agg(F.max("count").alias("highest"))
    return counts.withColumn("b", b).join(highest, "b").select(
        "pair", "count", (F.col("count") == F.col("highest")).cast("int").alias("best"))


def link_sums(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """row, n_best, count_sum: over the links of each row that has any. ``counts`` is a written table."""
    total = counts.agg(F.sum("count")).first()[0] or 0
    hot = counts.where(F.col("count") > total / HOT)  # fewer than HOT rows
    sums = [F.sum(F.col("n") * F.col("best")).alias("n_best"), F.sum(F.col("n") * F.col("count")).alias("count_sum")]
    linked = aligned.select("row", F.inline("pairs")).join(F.broadcast(hot), "pair", "left")
    frequent = linked.where("count is not null").groupBy("row").agg(*sums)
    rare = linked.where("count is null").select("row", "pair", "n").join(counts, "pair").groupBy("row").agg(*sums)
    return frequent.unionByName(rare).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align_with_counts(docs: DataFrame, byte_level: str, pieces: str, groups: Column | None = None, **sizes: int) -> DataFrame:
    """:func:`align` (and its ``sizes``) with n_links, n_best (links with their B id's most frequent partner) and count_sum.

    ``groups`` is what is kept of the groups' text, such as a digest, which need not be moved then.
    """
    aligned = align(docs, byte_level, pieces, **sizes)
    sums = link_sums(aligned, stage_lean(pair_counts(aligned), "pair-best"))
    kept = aligned.select("row", "doc_id", "n_a", "n_b", "n_groups", (F.col("groups") if groups is None else groups).alias("groups"))
    return kept.join(sums, "row", "left").select(
        *kept.columns, (F.col("n_a") + F.col("n_b") - F.col("n_groups")).alias("n_links"),
        F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"), F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tokenizers' ids of all ``documents``, aligned: counts, links and a digest of the groups."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    done = align_with_counts(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), digest)
    return done.drop("row").withColumnRenamed("groups", "groups_sha256")
