"""Word hashing of whole Arrow batches with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .common import mix64

#: Bytes of text that are worked on at a time; a longer text is a block of its own.
BLOCK = 1 << 19
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_P = 0x9E3779B97F4A7C15  # odd, so powers have inverses modulo 2**64
_PINV = pow(_P, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_pow, _inv = _powers(_P, BLOCK), _powers(_PINV, BLOCK)


def blocks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets of the rows in the bytes) of a string column; null is empty."""
    column = column.fill_null("").cast(pa.large_string())
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + BLOCK, "right")) - 1)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word (A-Z lower-cased, between ASCII white space) and each row's first word."""
    if len(data) == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    # a text longer than a block has its own powers, which go with it
    power, inverse = (_pow, _inv) if len(data) <= BLOCK else (_powers(_P, len(data)), _powers(_PINV, len(data)))
    inside = ~IS_SPACE[data]
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    cut = offsets[1:-1]
    cut = cut[cut < len(data)]
    before[cut] = False  # a row's first letter begins a word
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    after[cut - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    total = np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * power[: len(data)], dtype=np.uint64)
    upto = np.concatenate((np.zeros(1, np.uint64), total))
    hashes = mix64((upto[ends] - upto[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.searchsorted(starts, offsets)


def shingle_sets(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hashes, offsets of the rows in the hashes): each row's distinct shingles, ascending.

    A row with fewer words than `size` has its whole sequence as its one shingle; without words none.
    """
    for first, last, data, offsets in blocks(column):
        words, at = word_hashes(data, offsets)
        n = np.diff(at)
        with np.errstate(over="ignore"):
            h = np.zeros(max(0, len(words) - size + 1), np.uint64)
            for j in range(size):
                h = mix64(h + words[j : j + len(h)] + np.uint64(j + 1))
        out, ends = [], [0]
        for r in range(last - first):
            if n[r] >= size:
                own = np.unique(h[at[r] : at[r + 1] - size + 1])
            elif n[r]:
                x = np.zeros(1, np.uint64)
                with np.errstate(over="ignore"):
                    for j in range(n[r]):
                        x = mix64(x + words[at[r] + j] + np.uint64(j + 1))
                    own = mix64(x + np.uint64(0x5EED))
            else:
                own = h[:0]
            out.append(own)
            ends.append(ends[-1] + len(own))
        yield first, np.concatenate(out), np.array(ends)
