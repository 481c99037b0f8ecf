"""Modules of a network: forests in place of edges, and a plan that lists no edge once a module."""

from collections import defaultdict

import numpy as np

from sitewise.operators import graph


def _find(root, n):
    while root[n] != n:
        n = root[n]
    return n


def test_coherence_against_union_find(spark):
    rng = np.random.default_rng(3)
    edges = sorted({tuple(sorted((f"g{a}", f"g{b}"))) for a, b in rng.integers(0, 60, (70, 2))})
    modules = [(m, f"g{n}") for m, size in (("x", 50), ("y", 20), ("z|", 8), ("one", 1)) for n in rng.choice(60, size, replace=False)]
    links = spark.createDataFrame([(a, b, 1) for a, b in edges], "src string, dst string, weight long")
    got = {r.module: r for r in graph.module_coherence(spark.createDataFrame(modules, "module string, node string"), links, graph.degrees(links)).collect()}
    hub = {r.node: r.hub_score for r in graph.degrees(links).collect()}
    of = defaultdict(set)
    for m, n in modules:
        of[m].add(n)
    for m, nodes in of.items():
        root, count = {n: n for n in nodes}, 0
        for a, b in edges:
            if a != b and a in nodes and b in nodes:
                count += 1
                low, high = sorted((_find(root, a), _find(root, b)))
                root[high] = low
        size = defaultdict(int)
        for n in nodes:
            size[_find(root, n)] += 1
        n, share = len(nodes), max(size.values()) / len(nodes)
        density = 2 * count / (n * (n - 1)) if n > 1 else 0
        want = (n, density, share, 0.4 * density + 0.3 * sum(hub.get(x, 0) for x in nodes) / n + 0.3 * share)
        np.testing.assert_allclose((got[m].n, got[m].density, got[m].largest_share, got[m].coherence), want, rtol=1e-12)


def test_forests_keep_components_in_bounded_steps(spark):
    rng = np.random.default_rng(4)
    rows = spark.createDataFrame([(int(a), int(b), [0] if a % 2 else [0, 7]) for a, b in rng.integers(0, 200, (3000, 2)) if a != b and (a < 100) == (b < 100)], "a long, b long, modules array<long>").coalesce(1)
    for limit in (50, 4_000_000):
        out = graph._reduce_edges(rows, limit).collect()
        if limit > 3000:
            assert len([r for r in out if r.m == 0]) == 198
        root = {n: n for n in range(200)}
        for r in out:
            if r.m == 0:
                low, high = sorted((_find(root, r.a), _find(root, r.b)))
                root[high] = low
        assert {_find(root, n) for n in range(100)} == {0} and {_find(root, n) for n in range(100, 200)} == {100}


def test_density_lists_an_edge_once(spark):
    """Edges met the modules of one end each before those of the other ruled them out."""
    modules = spark.createDataFrame([(f"m{k % 5}", f"g{k}") for k in range(20)], "module string, node string")
    edges = spark.createDataFrame([(f"g{a}", f"g{b}", 1) for a in range(20) for b in range(a)], "src string, dst string, weight long")
    assert {(r.module, r.n, r.density) for r in graph.module_density(modules, edges).collect()} == {(f"m{k}", 4, 1.0) for k in range(5)}
