"""Runs of periodic words, from the Lyndon arrays that phase one of Baier's suffix sorter yields.

A run of period q holds a Lyndon word of q words that is the longest one starting at its
place, under one of the two orders of the words. Phase one of the sorter groups suffixes by
just these words. Each of them is extended to both sides by longest common extensions, and
what is long enough is a run.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shingles import mix

#: Words that are worked on at once; a longer text is worked on alone.
CHUNK_WORDS = 400_000


def lyndon_lengths(letters: list[int]) -> list[int]:
    """Length of the longest Lyndon word that starts at each place.

    Groups of suffixes are taken from the highest down. The last place before a member that is
    in no group taken yet gets the member's word appended to its own, and moves with all places
    of its old group that got the same to a new group just above the old one. Linear but for
    the places' union-find.
    """
    n, alphabet = len(letters), sorted(set(letters))
    first = {c: g for g, c in enumerate(alphabet)}
    group = [first[c] for c in letters]
    members: list[list[int]] = [[] for _ in alphabet]
    for i, g in enumerate(group):
        members[g].append(i)
    size, k = [1] * len(alphabet), len(alphabet)
    lower, upper = list(range(-1, k - 1)), [*range(1, k), -1]
    left = list(range(n + 1))  # left[i + 1] leads to the last place <= i that is not taken, plus one; 0 for none
    out, g = [0] * n, k - 1
    while g >= 0:
        length, mine = size[g], [i for i in members[g] if group[i] == g]
        for i in mine:
            out[i] = length
            left[i + 1] = i
        times: dict[int, int] = {}
        for i in mine:
            while left[i] != i:
                left[i] = i = left[left[i]]
            if i:
                times[i - 1] = times.get(i - 1, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for p, t in times.items():
            moved.setdefault((-t, group[p]), []).append(p)
        for t, old in sorted(moved) if len(moved) > 1 else moved:
            new, above = len(members), upper[old]
            members.append(moved[t, old])
            size.append(size[old] - t * length)
            lower.append(old)
            upper.append(above)
            upper[old] = lower[above] = new
            for p in moved[t, old]:
                group[p] = new
        g = lower[g]
    return out


class Extensions:
    """Longest common extensions of places of a word, by exact names of its stretches of 1, 2, 4, ... letters."""

    def __init__(self, letters: np.ndarray):
        self.n, self.names = len(letters), [letters.astype(np.int64)]
        while (step := 1 << len(self.names)) <= self.n and self.names[-1].max() < len(self.names[-1]) - 1:
            last = self.names[-1]
            both = last[:self.n - step + 1] * self.n + last[step // 2:]
            self.names.append(np.unique(both, return_inverse=True)[1])

    def right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Letters that agree from places a < b on."""
        start = b
        for k in range(len(self.names) - 1, -1, -1):
            names = self.names[k]
            fits = b + (1 << k) <= self.n
            fits[fits] = names[a[fits]] == names[b[fits]]
            a, b = a + (fits << k), b + (fits << k)
        return b - start

    def left(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Letters that agree before places a < b."""
        start = a
        for k in range(len(self.names) - 1, -1, -1):
            names, step = self.names[k], 1 << k
            fits = a >= step
            fits[fits] = names[a[fits] - step] == names[b[fits] - step]
            a, b = a - fits * step, b - fits * step
        return start - a


def runs_of(letters: np.ndarray, min_length: int, min_periods: int) -> np.ndarray:
    """(start, length, period) of the runs of letters 0, 1, ..., sorted; ``min_periods`` is 2 or more."""
    n, extend = len(letters), Extensions(letters)
    found = []
    for sign in (1, -1):
        period = np.array(lyndon_lengths((sign * letters).tolist()), np.int64)
        place = np.flatnonzero(period * min_periods <= n)
        period = period[place]
        place, period = place[place + period < n], period[place + period < n]
        back = extend.left(place, place + period)
        length = back + period + extend.right(place, place + period)
        good = length >= np.maximum(min_length, min_periods * period)
        found.append(np.stack([place - back, length, period], 1)[good])
    return np.unique(np.concatenate(found), axis=0)


def stretches(codes: np.ndarray, offsets: np.ndarray, min_length: int, min_periods: int) -> Iterator[tuple[int, int, int]]:
    """(text, start, end) of the stretches that can hold runs: every gram of theirs is found twice in its text.

    A run of the least length has each gram of this size twice or more, so no run is lost, and
    none crosses a stretch's ends. Equal hashes of other grams only lengthen a stretch.
    """
    size = max(1, ((min_periods - 2) * (min_length + 1) + 2) // min_periods)
    if len(codes) < size:
        return
    scale = mix(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    w, m = mix(codes.astype(np.uint64)), len(codes) - size + 1
    text = np.searchsorted(offsets, np.arange(m), side="right") - 1
    h = mix(sum((w[k:m + k] * scale[k] for k in range(size)), mix(text.astype(np.uint64))))
    order = np.argsort(h)
    same = h[order[1:]] == h[order[:-1]]
    twice = np.zeros(m + 1, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    twice[:m] &= np.arange(m) + size <= offsets[text + 1]
    # A gram that is the last of its text ends a stretch.
    cut = np.zeros(m + 1, bool)
    cut[np.minimum(offsets, m)] = True
    begins = np.flatnonzero(twice & (cut | ~np.concatenate([[False], twice[:-1]])))
    ends = np.flatnonzero(twice[:m] & (cut[1:] | ~twice[1:])) + size
    for s, e in zip(begins.tolist(), ends.tolist()):
        if e - s >= min_length:
            yield int(text[s]), s, e


def _longest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of most periods, exactly; ties go to the smallest start, then period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def _kept(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by blanks but those of a run after its first period."""
    if runs:
        change = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            change[start + period] += 1
            change[start + length] -= 1
        words = [w for w, inside in zip(words, np.cumsum(change[:-1]).tolist()) if not inside]
    return b" ".join(words)


class _Codes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, list[list[bytes]]]]:
    """(first row, words of each row) of neighbouring rows; words are runs of bytes that are not ASCII white space."""
    first, held, n = 0, [], 0
    for i, t in enumerate(texts):
        words = (t or "").encode("utf-8", "replace").split()
        if held and n + len(words) > CHUNK_WORDS:
            yield first, held
            first, held, n = i, [], 0
        held.append(words)
        n += len(words)
    if held:
        yield first, held


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 24, min_periods: int = 3) -> DataFrame:
    """(doc_id, n_words, runs, longest, collapsed) per row.

    ``runs`` holds (start, length, period) in words of every maximal stretch of that smallest
    period which has ``min_length`` words and ``min_periods`` periods or more; ``longest`` is
    the one of most periods. ``collapsed`` is the text without the words that repeat a run's
    first period, its words joined by one blank. Null and empty texts have no words, no runs,
    a null ``longest`` and an empty ``collapsed``; repeated rows get equal results, other
    columns are not read. Whole texts are searched; a task holds some hundred thousand words,
    or one text.
    """
    if min_periods < 2 or min_length < 2:
        raise ValueError("a run has two periods and two words or more")

    def search(texts: list[str | None]) -> Iterator[tuple[int, list[list[bytes]], list[list[tuple[int, int, int]]]]]:
        for first, texts_words in _chunks(texts):
            codes = _Codes()
            flat = np.fromiter((codes[w] for words in texts_words for w in words), np.int64)
            offsets = np.concatenate([[0], np.cumsum([len(w) for w in texts_words])]).astype(np.int64)
            found: list[list[tuple[int, int, int]]] = [[] for _ in texts_words]
            for t, s, e in stretches(flat, offsets, min_length, min_periods):
                letters = np.unique(flat[s:e], return_inverse=True)[1]
                shift = s - int(offsets[t])
                found[t] += [(a + shift, n, q) for a, n, q in runs_of(letters, min_length, min_periods).tolist()]
            yield first, texts_words, [sorted(r, key=lambda x: (x[0], x[2])) for r in found]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        as_struct = lambda r: None if r is None else dict(zip(("start", "length", "period"), r))
        for b in batches:
            for first, texts_words, found in search(b["text"].tolist()):
                yield pd.DataFrame({
                    "doc_id": b["doc_id"].iloc[first:first + len(found)].to_numpy(),
                    "n_words": [len(w) for w in texts_words],
                    "runs": [[as_struct(r) for r in rs] for rs in found],
                    "longest": pd.Series([as_struct(_longest(rs)) for rs in found], dtype=object),
                    "collapsed": [_kept(w, rs).decode("utf-8") for w, rs in zip(texts_words, found)],
                })

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    one = "struct<start: long, length: long, period: long>"
    return rows.mapInPandas(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words long, runs array<{one}>, longest {one}, collapsed string")


def repeat_tail(doc_id: Column, text: Column) -> Column:
    """The text with a periodic tail planted in about each tenth document, by the CRC-32 of its id.

    With h the checksum, g = h div 10 and n words, words from a = g mod n on repeat with period
    1 + (n - a) div (3 + g mod 8) where h ends in 0. Others, and texts without words, stay.
    """
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))

    def planted(ws: Column) -> Column:
        n = F.size(ws)
        a = (g % n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
        return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.element_at(ws, F.when(i < a, i).otherwise(a + (i - a) % p) + 1)), " ")

    tail = F.element_at(F.transform(F.array(words), lambda ws: F.when(F.size(ws) > 0, planted(ws))), 1)
    return F.coalesce(F.when(h % 10 == 0, tail), text)
