"""Repeated substrings of a small collection by threshold-bounded interval expansion on its Burrows-Wheeler transform.

The intervals of the transform that share a prefix are widened to the left one symbol at a time, all intervals of a
length before those of the next: so common prefix lengths are found in increasing order, and the search stops at the
length asked for. Entries without a value by then have at least that common prefix with their predecessor.
"""

from __future__ import annotations

import numpy as np

_PACKED = 7  # symbols of 9 bits in one 64-bit number


def _suffix_order(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes sorted by at least ``depth`` symbols, and the rank of each by its first packed symbols."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(_PACKED, text.dtype)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for k in range(_PACKED):
        key = (key << np.uint64(9)) | padded[k : k + n]
    order = np.argsort(key, kind="stable")
    rank = _ranks(key[order], order)
    first, width = rank, _PACKED
    while width < depth and rank.max(initial=0) < n - 1:
        after = np.zeros(n, np.int64)
        after[: max(n - width, 0)] = rank[width:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        rank = _ranks(key[order], order)
        width *= 2
    return order, first


def _ranks(sorted_keys: np.ndarray, order: np.ndarray) -> np.ndarray:
    rank = np.empty(len(order), np.int64)
    rank[order] = np.concatenate([[0], np.cumsum(sorted_keys[1:] != sorted_keys[:-1])])
    return rank


def long_common_prefixes(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of ``text`` (positive symbols below 512), and which suffixes share ``length`` symbols with the one before."""
    n = len(text)
    order, first = _suffix_order(text, length + 1)
    transform = text[order - 1]  # the symbol before each suffix; the last one stands before the first suffix
    to_left = np.empty(n, np.int64)
    to_left[np.argsort(transform, kind="stable")] = np.arange(n)
    front = int(np.flatnonzero(order == 0)[0])

    found = np.zeros(n + 1, bool)  # entries whose common prefix is known to be shorter
    found[0] = found[n] = True
    width = min(_PACKED, length)
    starts_new = np.concatenate([[True], first[order][1:] != first[order][:-1]])
    if length <= _PACKED:
        width = 0
        starts_new[:] = False
        starts_new[0] = True
    found[:n] |= starts_new
    lo = np.flatnonzero(starts_new)
    hi = np.append(lo[1:], n)
    owner = np.zeros(n, np.int64)
    while width < length and len(lo):
        # All suffixes of the intervals, moved one symbol to the left: intervals again, one for each symbol.
        size = hi - lo
        ends = np.cumsum(size)
        at = np.arange(ends[-1]) + np.repeat(lo - (ends - size), size)
        inside = np.repeat(np.arange(len(lo)), size)
        moved = to_left[at]
        # Nothing stands before the front of the text; only single symbols include the text's last one.
        keep = at != front if width else np.ones(len(at), bool)
        moved, inside = moved[keep], inside[keep]
        symbol = transform[at[keep]]
        owner[moved] = inside
        turn = np.argsort(moved, kind="stable") if len(moved) < n // 8 else None
        if turn is None:
            touched = np.zeros(n, bool)
            touched[moved] = True
            moved = np.flatnonzero(touched)
            symbol_at = np.empty(n, transform.dtype)
            symbol_at[to_left[at[keep]]] = symbol
            symbol, inside = symbol_at[moved], owner[moved]
        else:
            moved, symbol, inside = moved[turn], symbol[turn], inside[turn]
        begins = np.ones(len(moved), bool)
        begins[1:] = (moved[1:] != moved[:-1] + 1) | (inside[1:] != inside[:-1]) | (symbol[1:] != symbol[:-1])
        lo = moved[begins]
        hi = moved[np.append(np.flatnonzero(begins)[1:], len(moved)) - 1] + 1 if len(moved) else lo
        width += 1
        # An interval whose right end is known already brings nothing new to its left either.
        new = ~found[hi]
        found[hi[new]] = True
        lo, hi = lo[new], hi[new]
    return order, ~found[:n]


def covered_windows(pieces: list[bytes], sort_keys: np.ndarray, length: int) -> list[np.ndarray]:
    """For each piece, which of its windows of ``length`` bytes have an earlier equal window in the collection.

    Windows are ordered by ``sort_keys`` of their pieces (distinct), then by position.
    """
    sizes = np.array([len(p) for p in pieces], np.int64)
    begin = np.concatenate([[0], np.cumsum(sizes + 1)])
    text = np.ones(int(begin[-1]), np.int16)  # 1 parts the pieces
    piece_of = np.repeat(np.arange(len(pieces)), sizes + 1)
    inner = np.arange(len(text)) - begin[piece_of]
    real = inner < sizes[piece_of]
    text[real] = np.frombuffer(b"".join(pieces), np.uint8).astype(np.int16) + 2
    order, same = long_common_prefixes(text, length)

    valid = inner + length <= sizes[piece_of]
    group = np.cumsum(~same)
    keep = valid[order]
    at, group = order[keep], group[keep]
    age = np.empty(len(pieces), np.int64)
    age[np.argsort(sort_keys, kind="stable")] = np.arange(len(pieces))
    when = age[piece_of[at]] * (int(sizes.max(initial=0)) + 1) + inner[at]
    by_group = np.lexsort((when, group))
    at, group = at[by_group], group[by_group]
    later = np.zeros(len(text), bool)
    later[at[1:][group[1:] == group[:-1]]] = True
    return [later[b : b + max(s - length + 1, 0)] for b, s in zip(begin[:-1], sizes)]
