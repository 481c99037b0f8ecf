"""Operators without a SQL twin, against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitewise.operators import evidence, models, multiclass, panels
from sitewise.plans import registry

SF = "/root/testdata/sf0.001"


def test_k_medoids_against_numpy(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(c, 0.3, 6) for c in (0, 5, 11)])
    names = [f"s{i:02d}" for i in range(len(x))]
    pairs = [(names[i], names[j], 1, float(abs(x[i] - x[j]))) for i in range(len(x)) for j in range(i + 1, len(x))]
    d = spark.createDataFrame(pairs, "a string, b string, n_common long, distance double")
    got = {r.sample_id: r.medoid for r in models.k_medoids(d, 3).collect()}
    for group in (names[:6], names[6:12], names[12:]):
        at = [names.index(n) for n in group]
        centre = min(group, key=lambda n: (round(sum(abs(x[names.index(n)] - x[k]) for k in at), 12), n))
        assert {got[n] for n in group} == {centre}


def test_least_squares_against_numpy(spark):
    rng = np.random.default_rng(6)
    z = rng.normal(size=(30, 3))
    covariates = spark.createDataFrame([(str(i), *map(float, r)) for i, r in enumerate(z)] + [("x", None, 1.0, 1.0)], "sample_id string, a double, b double, c double")
    rows = [(str(i), "1", "CG", p, float(rng.normal())) for p in range(4) for i in range(30) if rng.random() < 0.8] + [("x", "1", "CG", 0, 9.0)]
    values = spark.createDataFrame(rows, "sample_id string, chrom string, context string, pos long, m double")
    fit = panels.fit_covariates(values, covariates, ["a", "b", "c"])
    got = {r.pos: r for r in fit.collect()}
    for p in range(4):
        mine = [r for r in rows if r[3] == p and r[0] != "x"]
        design = np.column_stack([np.ones(len(mine)), z[[int(r[0]) for r in mine]]])
        want = np.linalg.lstsq(design, np.array([r[4] for r in mine]), rcond=None)[0]
        np.testing.assert_allclose([got[p].intercept, got[p].slope_a, got[p].slope_b, got[p].slope_c], want, atol=1e-9)
    back = panels.residualize_on(values, covariates, fit, ["a", "b", "c"])
    assert back.where("sample_id = 'x'").first().residual == 9.0 and abs(back.where("sample_id <> 'x'").agg(F.sum("residual")).first()[0]) < 1e-9


def test_chromosome_weights_sum_to_one(spark):
    w = {r.chrom: r.weight for r in registry.queries()["multiclass_chromosome_weights"](spark, SF).collect()}
    assert len(w) == 3 and min(w.values()) >= 0 and sum(w.values()) == pytest.approx(1)


def test_fusion_without_evidence_is_even(spark):
    heads = spark.createDataFrame([(1, 0, None), (2, 1, 0.9), (3, 0, 0.2), (3, 1, 1.0), (3, 2, 0.0)], "id long, head int, p double")
    got = {r.id: r.p for r in multiclass.fuse_heads(heads, 3).collect()}
    np.testing.assert_allclose(got[1], [1 / 3] * 3)
    np.testing.assert_allclose(got[2], [0, 1, 0])
    assert abs(sum(got[3]) - 1) < 1e-12 and got[3][1] > 0.999
    pair = {r.id: r.label for r in multiclass.panel_readout(multiclass.fuse_heads(heads, 3, pairwise=True), {"x": [1], "y": [2]}, "x", 0.5).collect()}
    assert pair == {1: "indeterminate", 2: "primary_disease", 3: "primary_disease"}


def test_thinned_coverage_is_binomial(spark):
    rows = [("s", "1", "CG", p, 60, 40) for p in range(2000)] + [("t", "1", "CG", 0, 3, 4), ("t", "1", "CG", 1, 0, 90), ("t", "1", "CG", 2, None, 90), ("t", "1", "CG", 3, 0, 0)]
    counts = spark.createDataFrame(rows, "sample_id string, chrom string, context string, pos long, mC long, uC long")
    got = evidence.thin_coverage(counts, 20, 3)
    at = {(r.sample_id, r.pos): (r.mC, r.uC) for r in got.collect()}
    assert at == {(r.sample_id, r.pos): (r.mC, r.uC) for r in evidence.thin_coverage(counts.repartition(5), 20, 3).collect()}
    assert at["t", 0] == (3, 4) and at["t", 1][0] == 0 and at["t", 1][1] < 90 and at["t", 2] == (None, 90) and at["t", 3] == (0, 0)
    m, u = np.array([at["s", p] for p in range(2000)], float).T
    # Binomial(60, 0.2) and Binomial(40, 0.2): means 12 and 8, variances 9.6 and 6.4; four standard errors.
    assert abs(m.mean() - 12) < 4 * (9.6 / 2000) ** 0.5 and abs(u.mean() - 8) < 4 * (6.4 / 2000) ** 0.5
    assert abs(m.var() / 9.6 - 1) < 0.13 and abs(u.var() / 6.4 - 1) < 0.13 and abs(np.corrcoef(m, u)[0, 1]) < 0.09


def test_evidence_odd_rows(spark):
    a = spark.createDataFrame([(True, None, None, None, None, None), (True, "known", "HIGH", 2, "disgenet", None), (True, "known", "high", 2, "other", None), (None, "known", "high", 9, "other", 1.0)],
                              "associated boolean, association_type string, evidence_level string, publications int, source string, score double")
    assert [tuple(r) for r in a.select(evidence.meets("strict"), evidence.meets("permissive")).collect()] == [(False, False), (False, True), (True, True), (False, False)]
    p = spark.createDataFrame([(1, None, 3.0), (1, 0.5, None), (1, 0.5, 1.0), (2, None, None)], "pos int, frequency double, effect_size double")
    assert sorted(tuple(r) for r in evidence.merge_stable(p, ["pos"]).collect()) == [(1, 0.5, 1.0), (2, None, None)]
    m = spark.createDataFrame([("m", "x"), ("m", "x"), ("n", "y")], "module string, term string")
    terms = spark.createDataFrame([("x", 1e-20, 2.0, None)], "term string, q_value double, combined_score double, overlap_abs double")
    genes, w = spark.createDataFrame([("x", "g")], "term string, gene string"), spark.createDataFrame([], "gene string, w double, effect double")
    got = {r.module: r for r in evidence.module_scores(m, terms, genes, w).collect()}
    assert got["n"].score == 0 and got["m"].n_terms == 1 and got["m"].score == pytest.approx(0.35 + 0.15 / 50 + 0.15 / 200 + 0.15)
