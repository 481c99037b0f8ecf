"""Vectorised word shingles of whole texts, as 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once; a longer text is worked on alone.
CHUNK_BYTES = 500_000
_MULT = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x100000001B3
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (the splitmix finaliser)."""
    x = (x + _MULT).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    global _powers
    if len(_powers[0]) < n:
        inverse = pow(_BASE, -1, 1 << 64)
        up, down = np.full(n, _BASE, np.uint64), np.full(n, inverse, np.uint64)
        up[0] = down[0] = 1
        _powers = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    return _powers


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of each word; words are runs of bytes that are not ASCII white space."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    word = ~_SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    starts = word & (first[:-1] | np.concatenate([[True], ~word[:-1]]))
    ends = word & (first[1:] | np.concatenate([~word[1:], [True]]))
    s, e = np.flatnonzero(starts), np.flatnonzero(ends)
    up, down = _power_tables(len(data))
    run = np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], dtype=np.uint64)
    before = np.where(s > 0, run[s - 1], np.uint64(0))
    return mix((run[e] - before) * down[s]), np.searchsorted(offsets, s, side="right") - 1


def chunks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of neighbouring texts; nulls are empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK_BYTES, side="right")) - 1)
        yield i, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def doc_shingles(texts: pa.Array, size: int = 5) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, distinct sorted shingle hashes, their counts) of each text with a word.

    A text of fewer than ``size`` words has one shingle of all its words.
    """
    scale = mix(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    for row, data, offsets in chunks(texts):
        w, of = word_hashes(data, offsets)
        n = len(offsets) - 1
        lengths = np.bincount(of, minlength=n)
        ends = np.cumsum(lengths)
        if len(w) >= size:
            h = sum((w[k:len(w) - size + 1 + k] * scale[k] for k in range(size)), np.zeros(len(w) - size + 1, np.uint64))
            h = mix(h)
        else:
            h = np.zeros(0, np.uint64)
        for d in np.flatnonzero(lengths).tolist():
            a, b = int(ends[d] - lengths[d]), int(ends[d])
            if b - a >= size:
                part = np.sort(h[a:b - size + 1])
                new = np.empty(len(part), bool)
                new[0] = True
                np.not_equal(part[1:], part[:-1], out=new[1:])
                at = np.flatnonzero(new)
                yield row + d, part[at], np.diff(np.append(at, len(part)))
            else:
                short = mix((w[a:b] * scale[:b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a))
                yield row + d, short, np.ones(1, np.int64)
