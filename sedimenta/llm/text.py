"""Whole Arrow string columns as bytes: words, hashes and runs without one Python object per word.

Texts are handled in slices of about a megabyte, so what a task holds does not grow with its batch; a longer text
makes a slice of its own.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for mapInArrow, with a worker that gives back the memory it no longer uses when its task ends.

    Spark keeps idle workers for later tasks, and takes them in turn: what each retains of its batches would lie beside
    the executor's heap in stages that need no Python.
    """

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        _give_back()

    return tidied


_BASE = 0x9E3779B97F4A7C15 | 1
_TABLE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, SLICE_BYTES + SLICE_BYTES // 8)
        inverse = pow(_BASE, -1, 1 << 64)
        grown = []
        for base in (_BASE, inverse):
            out = np.ones(size, np.uint64)
            out[1:] = np.uint64(base)
            grown.append(np.multiply.accumulate(out))
        _powers, _inverses = grown
    return _powers, _inverses


def prefix_sums(buf: np.ndarray) -> np.ndarray:
    """Prefix sums of the rolling hash, one longer than the bytes."""
    powers, _ = _power_tables(len(buf) + 1)
    out = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_TABLE[buf] * powers[: len(buf)], out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes of each span [start, end)."""
    _, inverses = _power_tables(len(prefix))
    h = (prefix[ends] - prefix[starts]) * inverses[starts]
    return mix(h ^ ((ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


_HASHED_BY_8 = 256


def span_digests(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of the bytes of each span [start, end), eight bytes at a time through :func:`mix`.

    Spans of equal length up to 8 never collide, and no longer ones do by their construction, as they can where powers of
    one base are summed. What a span has beyond 256 bytes goes through BLAKE2.
    """
    padded = np.zeros(len(buf) + 8, np.uint8)
    padded[: len(buf)] = buf
    eight = np.ndarray((len(buf) + 1,), "<u8", padded, strides=(1,))
    size = ends - starts
    h = mix(size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(seed))
    left = np.flatnonzero(size > 0)
    for at in range(0, _HASHED_BY_8, 8):
        if not len(left):
            return h
        part = eight[starts[left] + at]
        rest = size[left] - at
        cut = rest < 8
        part[cut] &= (np.uint64(1) << (rest[cut].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        h[left] = mix(h[left] * np.uint64(3) + part)
        left = left[rest > 8]
    for k in left.tolist():
        tail = hashlib.blake2b(buf[starts[k] + _HASHED_BY_8 : ends[k]].tobytes(), digest_size=8).digest()
        h[k : k + 1] = mix(h[k : k + 1] * np.uint64(3) + np.frombuffer(tail, np.uint64))
    return h


def strings(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column end to end, and where each text begins (one more entry for the end)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class Slice:
    """Neighbouring texts of one batch: rows [lo, hi), their bytes and their offsets."""

    lo: int
    hi: int
    buf: np.ndarray
    offsets: np.ndarray

    @property
    def n(self) -> int:
        return self.hi - self.lo


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    buf, offsets = strings(column)
    lo = 0
    while lo < len(offsets) - 1:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield Slice(lo, hi, buf[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        lo = hi


def words(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each run of bytes that are not ASCII white space, and the text (0, 1, ...) it is in."""
    buf, offsets = part.buf, part.offsets
    if not len(buf):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~_SPACE[buf]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(buf))]
    begins[edge] = inside[edge]
    ends[edge - 1] = inside[edge - 1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return starts, stops, np.searchsorted(offsets, starts, "right") - 1


def windows(hashes: np.ndarray, owner: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``width`` words in a row that lie in one text, and the position of each window's first word."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(owner[:n] == owner[width - 1 :])
    out = np.zeros(len(at), np.uint64)
    for k in range(width):
        out = mix(out * np.uint64(_BASE) + hashes[at + k])
    return out, at
