"""Registered queries on small tables that a cut by id, rank or prefix would shorten."""

from collections import defaultdict
from itertools import combinations
from types import SimpleNamespace

import pytest

from sitewise.operators import models as M
from sitewise.plans import fixtures, models_queries, registry


def run(monkeypatch, spark, name, **tables):
    """The registered query with tables of the test in place of the derived ones."""
    real = fixtures.Tables.__getattr__
    monkeypatch.setattr(fixtures.Tables, "__getattr__", lambda self, k: tables[k] if k in tables else real(self, k))
    return registry.queries()[name](spark, "/root/testdata/sf0.001").collect()


def test_distances_of_all_samples(spark):
    rows = [(str(s), "1", "CG", 100 + 2 * p, (s * 7 + p * 3) % 11, 11) for s in range(1, 26) for p in range(8) if (s + p) % 4]
    counts = spark.createDataFrame(rows, "sample_id string, chrom string, context string, pos long, mC long, uC long")
    level = defaultdict(dict)
    for s, _, _, p, m, u in rows:
        level[s][p] = m / (m + u)
    want = {}
    for a, b in combinations(sorted(level), 2):
        both = level[a].keys() & level[b].keys()
        if both:
            want[a, b] = len(both), sum(abs(level[a][p] - level[b][p]) for p in both) / len(both)
    d = models_queries.distances(SimpleNamespace(site_counts=counts)).cache()
    got = {(r.a, r.b): (r.n_common, r.distance) for r in d.collect()}
    assert got.keys() == want.keys() and len(got) == 300
    assert all(got[k] == (n, pytest.approx(x)) for k, (n, x) in want.items())
    near = {r.sample_id: r.medoid for r in M.assign_medoids(d, ["1", "2", "3"]).collect()}
    one = lambda a, b: 0 if a == b else want[min(a, b), max(a, b)][1]
    assert len(near) == 25 and all(one(s, m) == pytest.approx(min(one(s, k) for k in "123")) for s, m in near.items())
    labels = counts.selectExpr("sample_id", "cast(sample_id as long) % 2 as label").distinct()
    assert M.silhouette(d, labels).count() == 25


def test_panels_of_all_sites(monkeypatch, spark):
    rows = [(str(s), "disease" if s % 2 else "control", "1", "CG", 100 + 2 * p, (s + p) % 10, 10) for s in range(1, 7) for p in range(20)]
    counts = spark.createDataFrame(rows, "sample_id string, cohort string, chrom string, context string, pos long, mC long, uC long")
    got = run(monkeypatch, spark, "score_histogram", site_counts=counts)
    assert {r.sample_id: r.n_loci for r in got} == {str(s): 20 for s in range(1, 7)}
    got = {r.sample_id: r for r in run(monkeypatch, spark, "panel_score", site_counts=counts)}
    for s in range(1, 7):
        want = 0.25 + sum(0.01 * (p % 7) * m / (m + u) for k, _, _, _, p, m, u in rows if k == str(s))
        assert got[str(s)].n_observed == 20 and got[str(s)].score == pytest.approx(want, abs=2e-6)


def test_all_runs(monkeypatch, spark):
    rows = [(k, "1", 100 + 8 * k + j, 0.5, 0.25, -0.125 * k) for k in range(1, 8) for j in (0, 2)]
    runs = spark.createDataFrame(rows, "run_id int, chrom string, pos long, effect_size double, p_value double, delta_mean double")
    sites = runs.select("chrom", "pos").distinct()
    assert {r.pos for r in run(monkeypatch, spark, "panel_union", runs=runs)} == {r[2] for r in rows}
    got = run(monkeypatch, spark, "file_sites_csv", runs=runs)
    assert sorted((r.run_id, r.pos, r.delta_mean, r.effect_size) for r in got) == sorted((k, p, d, abs(d)) for k, _, p, _, _, d in rows)
    got = run(monkeypatch, spark, "tile_site_overlap", runs=runs, sites=sites)
    assert sorted((r.run_id, r.tile_start) for r in got) == sorted({(k, p // 8 * 8) for k, _, p, *_ in rows})


def test_components_of_all_edges(monkeypatch, spark):
    edges = [("a", "b", 9), ("a", "c", 1), ("d", "e", 5), ("c", "f", 2), ("g", "h", 3), ("g", "i", 2), ("g", "g", 8), ("i", "j", 1), ("k", "l", 1), ("k", "m", 1)]
    root = {n: n for s, d, _ in edges for n in (s, d)}

    def find(n):
        return n if root[n] == n else find(root[n])

    for s, d, _ in edges:
        low, high = sorted((find(s), find(d)))
        root[high] = low
    df = spark.createDataFrame(edges, "src string, dst string, weight long")
    assert {(r.node, r.component) for r in run(monkeypatch, spark, "graph_components", edges=df)} == {(n, find(n)) for n in root}
    size = lambda n: sum(find(m) == find(n) for m in root)
    want = {e for e in edges if e[0] != e[1] and size(e[0]) >= 4}
    assert {tuple(r) for r in run(monkeypatch, spark, "graph_keep_large", edges=df)} == want and len(want) == 6
