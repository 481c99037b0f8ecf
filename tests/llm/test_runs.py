"""Periodic runs against all stretches of all periods."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from helpers import empty_docs, odd_docs

from sitewise.llm import queries, runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words, min_length, min_periods):
    n, out = len(words), []
    for q in range(1, n // min_periods + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            part = words[i:j + q]
            if j > i and length >= max(min_length, min_periods * q) and not any(part[r:] == part[:-r] for r in range(1, q)):
                out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out)


def brute_collapsed(words, found):
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def brute_row(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute_runs(words, 24, 3)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(found), *best, None if best[0] is None else 1000 * best[1] // best[2], sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(brute_collapsed(words, found)))


def lyndon(w):
    ends = [max(j for j in range(i + 1, len(w) + 1) if all(w[i:j] < w[k:j] for k in range(i + 1, j))) for i in range(len(w))]
    return [e - i for i, e in enumerate(ends)]


def test_lyndon_lengths_by_definition():
    rng = random.Random(1)
    for _ in range(500):
        w = [rng.randrange(rng.choice([1, 2, 3])) for _ in range(rng.randrange(1, 14))]
        assert runs.lyndon_lengths(w) == lyndon(w)
        assert runs.lyndon_lengths([-c for c in w]) == lyndon([-c for c in w])


@pytest.mark.parametrize(("min_length", "min_periods"), [(2, 2), (6, 3), (24, 3), (10, 4)])
def test_runs_and_stretches_match_all_periods(min_length, min_periods):
    rng = random.Random(min_length)
    for _ in range(300):
        w = [rng.randrange(rng.choice([1, 2, 4])) for _ in range(rng.randrange(1, 9))] * rng.randrange(1, 7) + [rng.randrange(3) for _ in range(rng.randrange(6))]
        w *= rng.randrange(1, 4)
        assert [tuple(r) for r in runs.runs_of(np.unique(w, return_inverse=True)[1], min_length, min_periods).tolist()] == brute_runs(w, min_length, min_periods)
        texts, found = [w, [7, 8], w[::-1]], []
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        flat = np.concatenate(texts)
        for t, s, e in runs.stretches(flat, offsets, min_length, min_periods):
            letters = np.unique(flat[s:e], return_inverse=True)[1]
            found += [(t, a + s - int(offsets[t]), n, q) for a, n, q in runs.runs_of(letters, min_length, min_periods).tolist()]
        assert sorted(found) == [(t, *r) for t, x in enumerate(texts) for r in brute_runs(list(x), min_length, min_periods)]


def test_long_runs_stay_near_linear():
    for w in ([0] * 300_000, [i % 77 for i in range(300_000)]):
        (start, length, period), = runs.runs_of(np.array(w), 24, 3).tolist()
        assert (start, length, period) == (0, 300_000, max(w) + 1)


def docs_of(spark, tmp_path):
    rng = random.Random(4)
    words = [f"w{i}é" for i in range(40)]
    rows = [(k, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 200)))) for k in range(80)]
    rows += [(100 + k, "\n".join(["la li\tlu " * rng.randrange(1, 12), "x " * rng.randrange(40), " ".join(rng.choices(words[:2], k=50))])) for k in range(40)]
    rows += [(r.doc_id, r.text) for r in odd_docs(spark).where("doc_id <> 9 OR doc_id IS NULL").collect()]  # not the 20,000 words: slow by brute force
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    return rows


def test_registered_query_matches_brute_force(spark, tmp_path):
    rows = docs_of(spark, tmp_path)
    key = lambda r: (r[0] is None, r[0] or 0, r[-1])
    got = queries.op11_periodic_runs(spark, str(tmp_path)).collect()
    assert sorted((tuple(r) for r in got), key=key) == sorted((brute_row(*r) for r in rows), key=key)
    assert sum(r.n_runs > 0 for r in got) >= 20


def test_odd_rows_and_empty_table(spark):
    docs = odd_docs(spark)
    got = runs.find_runs(docs)
    assert got.columns == ["doc_id", "n_words", "runs", "longest", "collapsed"] and got.count() == docs.count()
    bare = got.where("doc_id IN (3, 4, 5)").collect()
    assert [(r.n_words, r.runs, r.longest, r.collapsed) for r in bare] == [(0, [], None, "")] * 3
    assert runs.find_runs(empty_docs(spark)).count() == 0
