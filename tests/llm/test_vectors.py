import numpy as np

from sitewise.llm import vectors


def brute(rows, cosine=0.95):
    unit = {}
    for k, (i, e) in enumerate(rows):
        if i is None or not e or any(c is None or not np.isfinite(c) for c in e) or not any(e):
            continue
        a = np.array(e, float)
        unit[k] = a / np.linalg.norm(a)
    root = {k: k for k in range(len(rows))}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    links = [0] * len(rows)
    for a in unit:
        for b in unit:
            if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= cosine:
                links[a] += 1
                links[b] += 1
                root[find(b)] = find(a)
    out = []
    for k, (i, _) in enumerate(rows):
        group = [rows[j][0] for j in range(len(rows)) if find(j) == find(k) and rows[j][0] is not None]
        out.append((i, links[k], min(group) if group else None))
    return out


def near(rng, v, cosine):
    g = rng.normal(size=v.size)
    g -= (g @ v) * v
    g /= np.linalg.norm(g)
    return cosine * v + np.sqrt(1 - cosine**2) * g


def test_links_match_all_pairs(spark):
    rng = np.random.default_rng(5)
    rows, k = [], 0
    for _ in range(30):
        v = rng.normal(size=64)
        v /= np.linalg.norm(v)
        for c in rng.uniform(0.93, 1.0, 12):
            rows.append((k, (near(rng, v, c) * rng.uniform(0.1, 5)).tolist()))
            k += 1
    base = rng.normal(size=64).tolist()
    nan, inf = float("nan"), float("inf")
    rows += [(1000, base), (1001, base), (1001, base), (1002, None), (1003, []), (1004, [0.0] * 64), (1005, [nan] * 64), (1006, [inf] + [1.0] * 63),
             (1007, [None] + [1.0] * 63), (None, base), (1008, [1.0, 2.0, 3.0]), (1009, [2.0, 4.0, 6.0]), (5, rng.normal(size=64).tolist())]
    table = spark.createDataFrame([(i, e, 3, "x") for i, e in rows], "vec_id long, embedding array<double>, rep int, cell string")
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in vectors.link_vectors(table).collect()), key=str)
    want = sorted(brute(rows), key=str)
    same = sum(a == b for a, b in zip(got, want))
    assert len(got) == len(want) and same >= 0.99 * len(want)
    assert sum(g[1] for g in got) >= 0.99 * sum(w[1] for w in want)


def test_large_group_and_empty(spark):
    rng = np.random.default_rng(6)
    v = rng.normal(size=64)
    v /= np.linalg.norm(v)
    rows = [(k, near(rng, v, c).tolist()) for k, c in enumerate(rng.uniform(0.96, 0.99, 700))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.vec_id, r.n_links) for r in vectors.link_vectors(table).collect())
    x = np.array([e for _, e in rows])
    want = ((x / np.linalg.norm(x, axis=1, keepdims=True)) @ (x / np.linalg.norm(x, axis=1, keepdims=True)).T >= 0.95).sum(1) - 1
    assert sum(n for _, n in got) >= 0.97 * want.sum() and all(n <= w for (_, n), w in zip(got, want.tolist()))
    assert vectors.link_vectors(table.limit(0)).count() == 0


def test_hash_recall_at_the_limit():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = np.array([near(rng, v, 0.95) for v in x])
    for hashes in (2, 3, 4):
        hit = np.zeros(len(x), bool)
        for (_, a), (_, b) in zip(vectors.buckets(x, hashes), vectors.buckets(y, hashes)):
            hit |= (a[:, :1] == b).any(1) | (b[:, :1] == a).any(1)
        assert hit.mean() > 0.99
