"""Decisions that the last bits of a sum, and so the order of its rows, must not take."""

from itertools import permutations

from sitewise.operators import multiclass, samples

from test_whole_jobs import run


def test_pmd_of_a_mean_of_one_half(monkeypatch, spark):
    levels = [(8, 6), (6, 1), (4, 3), (0, 5)]  # 8/14 + 6/7 + 4/7 + 0/5 is 2; added up in doubles, two of three orders are below it
    rows = [(str(s), "1", "CG", 100 + 2 * i, *x) for s, order in enumerate(permutations(levels)) for i, x in enumerate(order)]
    counts = spark.createDataFrame(rows, "sample_id string, chrom string, context string, pos long, mC long, uC long")
    assert {r.sample_id: (r.n_windows, r.n_pmd) for r in run(monkeypatch, spark, "pmd_load", site_counts=counts)} == {str(s): (1, 0) for s in range(24)}


def test_guardrails_at_the_limit(spark):
    metrics = spark.createDataFrame([("a", "d", 0.051), ("b", "d", 0.05100000000000001), ("c", "d", 0.0511), ("a", "q", 24.0), ("b", "q", 23.999999999999996), ("c", "q", 23.999)], "sample_id string, metric string, value double")
    limits = spark.createDataFrame([("d", "max", 0.051), ("q", "min", 24.0)], "metric string, op string, limit_value double")
    assert {r.sample_id: (r.n_metrics, r.n_failed, r.passed) for r in samples.guardrails(metrics, limits).collect()} == {"a": (2, 0, True), "b": (2, 0, True), "c": (2, 2, False)}


def test_readout_of_ties(spark):
    fused = spark.createDataFrame([(1, [-1.2, 1.2, 0.7]), (2, [-0.3, 0.1 + 0.2, 0.3]), (3, [0.3, 0.1 + 0.2, -2.0]), (4, [-1.2, 1.2, 0.71])], "id long, logits array<double>")
    got = {r.id: r.label for r in multiclass.panel_readout(fused, {"x": [1], "y": [2]}, "x", 0.5).collect()}
    assert got == {1: "primary_disease", 2: "indeterminate", 3: "healthy", 4: "indeterminate"}
