"""Suffix arrays by two-stage sorting, and the adjacent common prefixes.

Suffixes smaller than their successor (type S) are sorted directly; the others (type L) are induced by
one scan over the buckets of first bytes, each sorted suffix placing its predecessor.
"""

from __future__ import annotations

import numpy as np


def _big_endian(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place as one number that compares as they do."""
    return np.ndarray((len(text) - 7,), ">u8", text, strides=(1,))


def _direct_sort(text: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """``at`` by the ``depth`` bytes from each place: ranks are refined eight bytes at a time where they tie."""
    key = _big_endian(text)
    order = np.argsort(key[at].astype(np.uint64), kind="stable")
    at = at[order]
    first = key[at].astype(np.uint64)
    head = np.ones(len(at), bool)
    head[1:] = first[1:] != first[:-1]
    for d in range(8, depth, 8):
        tied = ~head
        tied[:-1] |= ~head[1:]
        own = np.flatnonzero(tied)
        if not len(own):
            break
        group = np.cumsum(head)[own]
        word = key[at[own] + d].astype(np.uint64)
        order = np.lexsort((word, group))
        at[own] = at[own][order]
        word, group = word[order], group[order]
        new = np.ones(len(own), bool)
        new[1:] = (word[1:] != word[:-1]) | (group[1:] != group[:-1])
        head[own] |= new
    return at


def suffix_array(text: np.ndarray, used: np.ndarray, depth: int) -> np.ndarray:
    """The used places of ``text`` (bytes, padded by ``depth`` + 8 zeros at its end) by their next ``depth`` bytes.

    ``used`` must hold, with each type L place, the next place; a zero byte ends a string.
    """
    n = len(text)
    following = np.append(text[1:], np.uint8(0))
    # type S: the next different byte is larger
    differs = np.flatnonzero(np.append(text[:-1] != text[1:], True))
    nxt = differs[np.searchsorted(differs, np.arange(n))]
    small = text[nxt] < following[nxt]
    small[text == 0] = True  # string ends seed the scan
    seed = np.flatnonzero(used & small)
    seed = _direct_sort(text, seed, depth)
    first = text[seed]
    out: list[np.ndarray] = []
    pending: list[list[np.ndarray]] = [[] for _ in range(256)]

    def place(places: np.ndarray, c: int) -> np.ndarray:
        """Passes the predecessors of newly sorted places on to their buckets; returns those of this bucket."""
        p = places[places > 0] - 1
        p = p[used[p] & ~small[p]]
        b = text[p]
        order = np.argsort(b, kind="stable")
        p, b = p[order], b[order]
        for v in np.unique(b).tolist():
            if v > c:
                pending[v].append(p[np.searchsorted(b, v) : np.searchsorted(b, v, "right")])
        return p[b == c]

    borders = np.searchsorted(first, np.arange(257))
    for c in range(256):
        found = np.concatenate(pending[c]) if pending[c] else np.zeros(0, np.int64)
        while len(found):
            out.append(found)
            found = place(found, c)
        own = seed[borders[c] : borders[c + 1]]
        if len(own):
            out.append(own)
            place(own, c)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def needed(text: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """``wanted`` and what its type L places need: the places after them up to the next of type S."""
    n = len(text)
    following = np.append(text[1:], np.uint8(0))
    differs = np.flatnonzero(np.append(text[:-1] != text[1:], True))
    nxt = differs[np.searchsorted(differs, np.arange(n))]
    small = text[nxt] < following[nxt]
    small[text == 0] = True
    end = np.flatnonzero(small)
    upto = end[np.searchsorted(end, np.flatnonzero(wanted))]
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, np.flatnonzero(wanted), 1)
    np.add.at(cover, upto + 1, -1)
    return np.cumsum(cover[:-1]) > 0


def common_prefixes(text: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """For each place after the first, the bytes that it shares with the one before, up to ``depth``."""
    key = _big_endian(text)
    out = np.zeros(max(0, len(places) - 1), np.int64)
    going = np.ones(len(out), bool)
    for d in range(0, depth, 8):
        x = key[places[1:][going] + d].astype(np.uint64) ^ key[places[:-1][going] + d].astype(np.uint64)
        same = np.full(len(x), 8)
        for k in range(8):  # the first byte that differs
            hit = (same == 8) & ((x >> np.uint64(56 - 8 * k)) & np.uint64(255) != 0)
            same[hit] = k
        out[going] += same
        going[np.flatnonzero(going)[same < 8]] = False
        if not going.any():
            break
    return np.minimum(out, depth)
