"""Lexical search against scores of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
from helpers import empty_docs, odd_docs

from sitewise.llm import lexical, queries

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items, k=10):
    tf = [(i, Counter(terms(t))) for i, t in docs]
    tf = [(i, c) for i, c in tf if c]
    n_docs, total, df = len(tf), sum(sum(c.values()) for _, c in tf), Counter(t for _, c in tf for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in tf:
            m = 10 + 90 * sum(c.values()) * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return out


def key(r):
    return str(r[0]), r[1]


def corpus(n=3000):
    rng = random.Random(6)
    words = [f"Wé{i}" for i in range(400)]
    text = lambda m: " ".join(rng.choices(words, [1 / (k + 1) for k in range(400)], k=m)) + ", x-Y_z!"
    docs = [(k, text(rng.randrange(1, 120))) for k in range(n)]
    docs += [(n + k, docs[k % 5][1]) for k in range(500)]  # a large group of copies: ties by id
    items = [(k, text(30)) for k in range(25)] + [(30, docs[0][1]), (31, ""), (32, None), (33, "nowhere")]
    return docs, items


def test_registered_query_matches_all_scores(spark, tmp_path):
    docs, items = corpus()
    spark.createDataFrame(docs, "doc_id long, text string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = [tuple(r) for r in queries.op13_lexical_search(spark, str(tmp_path)).collect()]
    assert sorted(got, key=key) == sorted(brute(docs, items), key=key)


def test_blocks_and_small_trees_give_the_same(spark, monkeypatch):
    docs, items = corpus(300)
    monkeypatch.setattr(lexical, "MAX_BLOCK_TERMS", 200)
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert len(list(lexical.query_blocks(q, "item_id", "text"))) >= 3
    got = [tuple(r) for r in lexical.search(d, q, k=3).collect()]
    assert sorted(got, key=key) == sorted(brute(docs, items, 3), key=key)


def test_bounds_prune_and_stay_safe():
    rng = np.random.default_rng(7)
    start, cols, vals = [0], [], []
    for k in range(4000):  # rows of one topic use its own columns
        own = np.sort(rng.choice(20, 6, replace=False)) + 20 * (k % 25)
        cols += own.tolist()
        vals += rng.integers(1, 10**10, 6).tolist()
        start.append(len(cols))
    start, cols, vals = np.array(start), np.array(cols), np.array(vals, np.int64)
    tree, ids = lexical.BallTree(start, cols, vals, 500), np.arange(4000).astype(object)
    leaves = sum(x is not None for x in tree.leaf)
    for q in range(25):
        wanted, best = np.arange(20 * q, 20 * q + 20), lexical.Best(10)
        opened = lexical.search_tree(tree, ids, wanted, best)
        score = np.add.reduceat(np.where(np.isin(cols, wanted), vals, 0), start[:-1])
        want = sorted((-int(s), i) for i, s in enumerate(score) if s)[:10]
        assert [(s, i) for s, _, i in best.rows] == want and opened < leaves
        for node, inside in enumerate(tree.leaf):
            if inside is not None:
                assert tree.bound(node, wanted) >= score[inside[0]].max()


def test_odd_rows_and_empty_tables(spark):
    docs = odd_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    items = [(1, "one word1x1"), (1, "one word1x1"), (None, "ñandú 漢字"), (2, None)]
    q = spark.createDataFrame(items, "item_id long, text string")
    assert sorted((tuple(r) for r in lexical.search(docs, q).collect()), key=key) == sorted(brute(rows, items), key=key)
    assert lexical.search(empty_docs(spark), q).count() == 0
    assert lexical.search(docs, q.limit(0)).count() == 0
