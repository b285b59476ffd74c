"""Counts over whole texts, for all texts of a slice at once."""

from __future__ import annotations

import numpy as np

from .text import LOWER, Slice, mix, span_digests, windows, words

SYMBOLS = b"#*$%&|<>"
_SYMBOL = np.isin(np.arange(256), np.frombuffer(SYMBOLS, np.uint8))
_FIRST_OF_CHARACTER = (np.arange(256) & 0xC0) != 0x80

#: Character classes of the histograms, by byte; a character outside ASCII counts once, at its first byte.
CHARACTER_CLASSES = ("vowel", "other lower", "upper", "digit", "blank", "line end", "full stop or comma", "exclamation",
                     "symbol", "other ASCII", "Latin beyond ASCII", "other beyond ASCII")
_CLASS = np.full(256, 9, np.int64)
_CLASS[ord("a") : ord("z") + 1] = 1
_CLASS[list(b"aeiou")] = 0
_CLASS[ord("A") : ord("Z") + 1] = 2
_CLASS[ord("0") : ord("9") + 1] = 3
_CLASS[[0x20, 0x09]] = 4
_CLASS[[0x0A, 0x0D]] = 5
_CLASS[list(b".,")] = 6
_CLASS[list(b"!?")] = 7
_CLASS[list(SYMBOLS)] = 8
_CLASS[0x80:0xC0] = -1
_CLASS[0xC0:0xD0] = 10
_CLASS[0xD0:] = 11


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of a value per byte over each text."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


class Words:
    """Words of a slice with their hashes, kept for the counts below."""

    def __init__(self, part: Slice):
        self.part = part
        self.starts, self.ends, self.owner = words(part)
        self.hashes = span_digests(part.buf, self.starts, self.ends)

    def lower_hashes(self) -> np.ndarray:
        return span_digests(LOWER[self.part.buf], self.starts, self.ends)

    def count(self) -> np.ndarray:
        return np.bincount(self.owner, minlength=self.part.n)

    def characters(self) -> np.ndarray:
        """Code points in words."""
        first = np.concatenate([[0], np.cumsum(_FIRST_OF_CHARACTER[self.part.buf], dtype=np.int64)])
        return np.bincount(self.owner, first[self.ends] - first[self.starts], self.part.n).astype(np.int64)

    def symbols(self) -> np.ndarray:
        return per_text(_SYMBOL[self.part.buf], self.part.offsets)

    def repeated(self, width: int = 3) -> np.ndarray:
        """Words that lie in a window of ``width`` words found twice or more in the text."""
        hashes, at = windows(self.hashes, self.owner, width)
        _, inverse, counts = np.unique(_own(hashes, self.owner[at]), return_inverse=True, return_counts=True)
        inside = np.zeros(len(self.owner), bool)
        at = at[counts[inverse] > 1]
        for k in range(width):
            inside[at + k] = True
        return np.bincount(self.owner, inside, self.part.n).astype(np.int64)

    def distinct(self) -> np.ndarray:
        return _distinct(self.hashes, self.owner, self.part.n)

    def duplicate_lines(self) -> np.ndarray:
        """Lines with a word that equal an earlier line of the text."""
        buf, offsets = self.part.buf, self.part.offsets
        breaks = np.flatnonzero(buf == 0x0A)
        starts = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
        line = np.unique(np.searchsorted(starts, self.starts, "right") - 1)
        starts, after = starts[line], np.append(starts, len(buf) + 1)[line + 1]
        owner = np.searchsorted(offsets, starts, "right") - 1
        closing = np.minimum(after, offsets[owner + 1])
        closing -= (closing > starts) & (buf[np.maximum(closing - 1, 0)] == 0x0A)
        hashes = span_digests(buf, starts, closing)
        return np.bincount(owner, minlength=self.part.n) - _distinct(hashes, owner, self.part.n)

    def classes(self) -> np.ndarray:
        """Characters of each text by class: one row per text."""
        part, k = self.part, len(CHARACTER_CLASSES)
        kind = _CLASS[part.buf]
        owner = np.repeat(np.arange(part.n), np.diff(part.offsets))
        keep = kind >= 0
        return np.bincount(owner[keep] * k + kind[keep], minlength=part.n * k).reshape(part.n, k)


def _own(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Hashes told apart by their text."""
    return mix(hashes ^ (owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))


def _distinct(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    _, first = np.unique(_own(hashes, owner), return_index=True)
    return np.bincount(owner[first], minlength=n)
