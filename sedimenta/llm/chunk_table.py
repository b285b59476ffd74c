"""A table of distinct chunks and their token ids, to which texts join back by position."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np

Segmented = tuple[np.ndarray, np.ndarray]


class _Rows(dict):
    """The row of each chunk. One that isn't there gets the next row as it is looked up, and is noted as new."""

    def __init__(self, *given):
        super().__init__(*given)
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        row = self[chunk] = len(self)
        self.new.append(chunk)
        return row


class ChunkTable:
    """Distinct chunks with their ids end to end. Each chunk is segmented once while it stays in the table.

    ``segment`` gives the ids of distinct chunks end to end, and how many each has. Of more than ``max_chunks``
    the table keeps, once their ids are given, those that were used more than once, at most half as many: memory stays
    bounded, and ids never depend on it.

    ``cut`` may part a chunk into one that has no further part, and an end with ids of its own in the table ``ends``.
    """

    def __init__(self, segment: Callable[[list[str]], Segmented], max_chunks: int = 500_000,
                 cut: Callable[[str], tuple[str, str] | None] | None = None, ends: ChunkTable | None = None):
        self._segment, self._cut, self._ends = segment, cut, ends
        self._max = max_chunks
        self._row = _Rows()
        self._start = self._length = self._uses = np.zeros(0, np.int64)
        self._ids = np.zeros(0, np.int32)

    def _shrink(self) -> None:
        often = np.flatnonzero(self._uses > 1)
        often = often[np.argsort(-self._uses[often], kind="stable")][: self._max // 2]
        names = list(self._row)
        at, length = places(self._start[often], self._length[often]), self._length[often]
        self._row = _Rows({names[k]: row for row, k in enumerate(often.tolist())})
        self._ids, self._length, self._start = self._ids[at], length, np.cumsum(length) - length
        self._uses = np.zeros(len(often), np.int64)

    def _add_new(self) -> None:
        new = self._row.new
        if not new:
            return
        parted, cores, ends = [], [], []
        if self._cut:
            for k, chunk in enumerate(new[:]):  # cores that are new come behind
                if parts := self._cut(chunk):
                    parted.append(k), cores.append(self._row[parts[0]]), ends.append(parts[1])
        self._row.new = []
        before = len(self._start)
        whole = np.delete(np.arange(len(new)), parted)
        flat, found = self._segment([new[k] for k in whole.tolist()])
        start, length = np.zeros((2, len(new)), np.int64)
        start[whole], length[whole] = len(self._ids) + np.cumsum(found) - found, found
        self._start, self._length = np.concatenate([self._start, start]), np.concatenate([self._length, length])
        self._uses = np.concatenate([self._uses, np.zeros(len(new), np.int64)])
        self._ids = np.concatenate([self._ids, flat])
        if parted:
            end_ids, end_length = self._ends.ids(ends)
            core_start, core_length = self._start[cores], self._length[cores]
            length = core_length + end_length
            begin = np.cumsum(length) - length
            flat = np.empty(int(length.sum()), np.int32)
            flat[places(begin, core_length)] = self._ids[places(core_start, core_length)]
            flat[places(begin + core_length, end_length)] = end_ids
            rows = before + np.array(parted)
            self._start[rows], self._length[rows] = len(self._ids) + begin, length
            self._ids = np.concatenate([self._ids, flat])

    def rows(self, chunks: list[str]) -> Iterator[int]:
        """The row of each chunk, good until :meth:`ids_of` has been called. Looked up text by text, chunks are still at
        hand for the processor."""
        return map(self._row.__getitem__, chunks)

    def ids_of(self, rows: list[int]) -> Segmented:
        """The ids of the chunks of these rows end to end, and how many each has."""
        at = np.fromiter(rows, np.int64, len(rows))
        self._add_new()
        self._uses += np.bincount(at, minlength=len(self._uses))
        found = self._ids[places(self._start[at], self._length[at])], self._length[at]
        if len(self._row) > self._max:
            self._shrink()
        return found

    def ids(self, chunks: list[str]) -> Segmented:
        """The ids of the chunks end to end, and how many each chunk has."""
        return self.ids_of(list(self.rows(chunks)))


def places(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for length[0] entries, then the same for the next."""
    ends = np.cumsum(length)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - (ends - length), length)


def joined(
    encode: Callable[[list[str]], list[list[int]]], begins: np.ndarray, plain: Callable[[str], bool], group: int = 100,
) -> Callable[[list[str]], Segmented]:
    """Segment many chunks by few calls: plain chunks go to the library side by side, parted by a space.

    ``begins`` marks the ids that only the first token of a chunk can have, so the ids part again at these; ``plain``
    says whether that holds of a chunk. The others go alone.
    """

    def segment(chunks: list[str]) -> Segmented:
        together = [k for k, c in enumerate(chunks) if plain(c)]
        apart = np.delete(np.arange(len(chunks)), together).tolist()
        texts = [" ".join(chunks[k] for k in together[i : i + group]) for i in range(0, len(together), group)]
        found = encode(texts + [chunks[k] for k in apart])
        flat = np.fromiter(chain.from_iterable(found[: len(texts)]), np.int32)
        cuts = np.flatnonzero(begins[flat])
        if len(cuts) != len(together):  # the model isn't as described: every chunk alone
            together, apart, flat, cuts = [], list(range(len(chunks))), flat[:0], cuts[:0]
            found = encode(chunks)
        rest = found[len(found) - len(apart) :]
        length = np.zeros(len(chunks), np.int64)
        start = np.zeros(len(chunks), np.int64)
        length[together] = np.diff(np.append(cuts, len(flat)))
        start[together] = cuts
        length[apart] = [len(x) for x in rest]
        start[apart] = len(flat) + np.cumsum(length[apart]) - length[apart]
        flat = np.concatenate([flat, np.fromiter(chain.from_iterable(rest), np.int32)])
        return flat[places(start, length)], length

    return segment
