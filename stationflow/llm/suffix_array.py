"""Suffix arrays by two-stage sorting, in array operations.

A suffix is of type S if it is smaller than its successor, else of type L. Only S suffixes
are sorted directly; a scan over the buckets of first bytes in ascending order then puts
every L suffix in its place: it follows from its successor, which is smaller and so has
been placed before. The scan takes a bucket at a time: first its L suffixes (in rounds, as
a run of one byte induces into its own bucket), then its S suffixes.

The order is right up to ``depth`` bytes, which is all that the search for repeats of
``depth`` bytes needs; ties beyond come in any order.
"""

from __future__ import annotations

import numpy as np


def smaller_than_next(t: np.ndarray) -> np.ndarray:
    """True for S suffixes. The end of the string is smaller than any byte."""
    if not len(t):
        return np.zeros(0, bool)
    last = np.flatnonzero(np.append(t[1:] != t[:-1], True))      # of each run of equal bytes
    s_run = np.append(t[last[1:]] > t[last[:-1]], False)
    return np.repeat(s_run, np.diff(last, prepend=-1))


def words_at(t: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on, as one big-endian integer (zeros after the end)."""
    w = np.zeros(len(t) + 8, np.uint64)
    w[: len(t)] = t
    for size in (1, 2, 4):
        w[:-size] = w[:-size] << np.uint64(8 * size) | w[size:]
        w[-size:] <<= np.uint64(8 * size)
    return w


def _sort_directly(at: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Positions ``at`` by their first ``depth`` bytes; only ties go on, by keys of their group
    and as many of the next bytes as fit beside it."""
    last = len(words) - 1
    key = words[at]
    order = np.argsort(key)
    at, key = at[order], key[order]
    rows, done = np.arange(len(at)), 8
    while done < depth:
        new = np.append(True, key[1:] != key[:-1])
        tied = ~new
        tied[:-1] |= ~new[1:]
        left = np.flatnonzero(tied)
        if not len(left):
            break
        rows, part = rows[left], at[rows[left]]
        group = np.cumsum(new[left]).astype(np.uint64)
        take = min(7, (64 - int(group[-1]).bit_length()) // 8)
        key = group << np.uint64(8 * take) | words[np.minimum(part + done, last)] >> np.uint64(64 - 8 * take)
        order = np.argsort(key)
        at[rows] = part[order]
        key = key[order]
        done += take
    return at


def suffix_array(t: np.ndarray, depth: int) -> np.ndarray:
    """All suffixes of the byte array ``t`` in ascending order."""
    n = len(t)
    if not n:
        return np.zeros(0, np.int64)
    s = np.flatnonzero(smaller_than_next(t))
    if len(s):
        s = _sort_directly(s, words_at(t), depth)
    s_bucket = np.searchsorted(t[s], np.arange(257)) if len(s) else np.zeros(257, np.int64)
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    induced[t[n - 1]].append(np.array([n - 1]))                   # the end of the string induces the last suffix
    out = []

    def put(before: np.ndarray, byte: np.ndarray) -> None:
        if not len(before):
            return
        order = np.argsort(byte, kind="stable")
        before, byte = before[order], byte[order]
        cut = np.flatnonzero(np.append(True, byte[1:] != byte[:-1]))
        for a, b in zip(cut, np.append(cut[1:], len(byte))):
            induced[byte[a]].append(before[a:b])

    for c in range(256):
        scan = np.concatenate(induced[c]) if induced[c] else np.zeros(0, np.int64)
        while len(scan):
            out.append(scan)
            before = scan[scan > 0] - 1
            byte = t[before]
            put(before[byte > c], byte[byte > c])
            scan = before[byte == c]
        own = s[s_bucket[c]: s_bucket[c + 1]]
        if len(own):
            out.append(own)
            before = own[own > 0] - 1
            byte = t[before]
            put(before[byte > c], byte[byte > c])
    return np.concatenate(out)


def shares_prefix(t: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether the common prefix of suffixes ``a`` and ``b`` (element by element) reaches
    ``length`` bytes. Both must have that many."""
    if length < 8:
        return np.logical_and.reduce([t[a + i] == t[b + i] for i in range(length)])
    words = words_at(t)
    same = words[a] == words[b]
    for i in [*range(8, length - 8, 8), length - 8]:
        same &= words[a + i] == words[b + i]
    return same
