"""Hashes of words and word shingles of whole Arrow batches, as numpy arrays.

A word is a run of bytes other than space and 0x09 to 0x0D, ASCII letters in lower case. Its 64-bit hash is a
polynomial over a fixed random table, taken from running sums, so that the cost is a few array operations a byte.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from tidemark.llm.grams import LOWER

PIECE_BYTES = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (a well-known finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n, _BASE, np.uint64)
    up[0] = 1
    down = np.full(n, np.uint64(pow(int(_BASE), -1, 1 << 64)), np.uint64)
    down[0] = 1
    return np.cumprod(up), np.cumprod(down)


_TABLE = mix(LOWER.astype(np.uint64) + np.uint64(0x1234567))


def word_hashes(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, counts)``: hashes of the words of all rows in order, and how many each row has."""
    first, last = int(offsets[0]), int(offsets[-1])
    found, rows = [], []
    at = first
    while at < last:
        end = min(last, at + PIECE_BYTES)
        while end < last:  # a piece ends at white space or at the end of a row
            back = np.flatnonzero(_SPACE[data[at:end]])
            edge = int(offsets[np.searchsorted(offsets, end, "right") - 1])
            cut = max(edge, at + int(back[-1]) + 1 if len(back) else at)
            if cut > at:
                end = cut
                break
            end = min(last, end + PIECE_BYTES)
        piece = data[at:end]
        blank = _SPACE[piece]
        edges = offsets[(offsets >= at) & (offsets <= end)] - at
        start = ~blank
        start[1:] &= blank[:-1]
        stop = ~blank
        stop[:-1] &= blank[1:]
        inner = edges[(edges > 0) & (edges < len(piece))]
        start[inner] = ~blank[inner]
        stop[inner - 1] = ~blank[inner - 1]
        s, e = np.flatnonzero(start), np.flatnonzero(stop) + 1
        up, down = _powers(1 << max(18, (len(piece)).bit_length()))
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(_TABLE[piece] * up[: len(piece)], out=sums[1:])
        found.append(mix((sums[e] - sums[s]) * down[s]))
        rows.append(s + at)
        at = end
    if not found:
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    starts = np.concatenate(rows)
    return np.concatenate(found), np.diff(np.searchsorted(starts, offsets))


def repeats(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Of each row, the share of words that equal the word before them."""
    hashes, counts = word_hashes(offsets, data)
    same = np.zeros(len(hashes) + 1, np.int64)
    if len(hashes):
        same[2:] = np.cumsum(hashes[1:] == hashes[:-1])
    ends = np.cumsum(counts)
    begins = ends - counts
    inside = same[ends] - same[np.minimum(begins + 1, ends)]
    return inside / np.maximum(counts, 1)


def shingles(hashes: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """``(row, hash)`` of every run of ``size`` words; a row with fewer words has its whole sequence, one without none."""
    ends = np.cumsum(counts)
    begins = ends - counts
    each = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    row = np.repeat(np.arange(len(counts)), each)
    value = np.zeros(len(row), np.uint64)
    place = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each) + begins[row]
    step = np.uint64(0xD6E8FEB86659FD93)
    long = (counts >= size)[row]
    runs = np.zeros(max(0, len(hashes) - size + 1), np.uint64)
    for i in range(size):
        runs *= step
        runs += hashes[i : i + len(runs)]
    if len(runs):
        value[long] = runs[place[long]]
    few = np.flatnonzero(~long)
    for i in range(size - 1):
        more = few[counts[row[few]] > i]
        value[more] = value[more] * step + hashes[place[more] + i] + np.uint64(i + 1)
    return row, mix(value)
