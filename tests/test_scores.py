"""Directional scores, distortion, edge evidence, hold-out metrics, class panels and expression files on small odd tables."""

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitewise.operators import derived, directional, distortion, edges, graph, models, multiclass, panels, scoring, stability
from sitewise.sources import expression

COUNTS = "sample_id string, chrom string, context string, pos long, mC long, uC long"


def test_directional_scores(spark):
    counts = spark.createDataFrame([("a", "1", "CG", 1, 9, 1), ("a", "1", "CG", 2, 2, 8), ("a", "1", "CG", 3, 0, 0), ("b", "1", "CG", 3, 5, 5), ("c", "1", "CG", 9, 1, 1)], COUNTS)
    sites = spark.createDataFrame(
        [("k", "1", "CG", 1, "g1", "exon", 0.5, 2.0), ("k", "1", "CG", 2, "g1", "exon", -0.25, None), ("k", "1", "CG", 3, "g2", "intron", 1.0, 1.0), ("k", "1", "CG", 1, "g2", None, 0.0, 1.0),
         ("k", "1", "CG", 2, None, "unknown", 0.3, 1.0), ("k", "1", "CG", 2, "g3", "exon", float("nan"), 1.0), ("k", "1", "CG", 2, "g4", "intron", 0.5, -3.0)],
        "comparison string, chrom string, context string, pos long, gene string, feature_type string, effect_size double, region_weight double")
    got = {(r.sample_id, r.feature_type): r.score for r in directional.region_scores(counts, sites).collect()}
    exon = (1.0 * 0.4 + 0.25 * 0.3) / 1.25
    assert got == {("a", "exon"): pytest.approx(exon), ("b", "intron"): pytest.approx(0.0)}
    assert directional.region_scores(counts, sites, ["exon"], min_loci=3).count() == 0
    genes = spark.createDataFrame([("k", "g1", 2.0, 4, 1.0), ("k", "g2", 1.0, None, -1.0), ("k", "g9", 1.0, 1, 0.0)], "comparison string, gene string, importance double, support int, prior double")
    got = {r.sample_id: r for r in directional.gene_scores(counts, sites, genes).collect()}
    assert set(got) == {"a", "b", "c"} and got["a"].score == pytest.approx(exon) and got["a"].observed_fraction == pytest.approx(1 / 3)
    assert got["a"].sign_agreement == 1.0 and got["a"].iqr is None
    assert got["b"].score is None and got["b"].observed_fraction == pytest.approx(1 / 3) and (got["c"].observed_fraction, got["c"].score) == (0.0, None)


def test_distortion(spark):
    x = (np.arange(200_000) + 0.5) / 200_000
    a, b = 6.0, 3.0
    p = np.exp((a - 1) * np.log(x) + (b - 1) * np.log(1 - x) - (math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b)))
    one = spark.range(1)
    got = one.select(distortion.beta_entropy(F.lit(a), F.lit(b)).alias("h"), distortion.distortion(F.lit(a), F.lit(b), F.lit(a), F.lit(b)).alias("same"),
                     distortion.distortion(F.lit(50.0), F.lit(1.0), F.lit(1.0), F.lit(50.0), clip=0.5).alias("clipped")).first()
    assert got.h == pytest.approx(-(p * np.log(p)).mean(), abs=1e-6) and got.same == 0.0 and got.clipped == -0.5
    levels = spark.createDataFrame([("a", 1, 0.5), ("a", 2, 1.0), ("z", 1, 0.0)], "sample_id string, pos int, x double")
    t = spark.createDataFrame([(1, 2.0), (2, -1.0)], "pos int, t double")
    for norm, want in (("l2", [0.5**0.5, -(0.5**0.5)]), ("l1", [0.5, -0.5]), ("minmax", [1.0, 0.0]), ("zscore", [0.5**0.5, -(0.5**0.5)]), (None, [1.0, -1.0])):
        out = {(r.sample_id, r.pos): r.value for r in distortion.apply_distortion(levels, t, ["pos"], norm).collect()}
        assert [out["a", 1], out["a", 2]] == pytest.approx(want) and out["z", 1] == 0.0
    with pytest.raises(ValueError):
        distortion.apply_distortion(levels, t, ["pos"], "other")


def test_edge_evidence(spark):
    rows = [("b", "a", 1, 1000.0, "module_copresence"), ("a", "b", 2, 1000.0, "module_copresence"), ("a", "b", 2, None, "edge"), ("a", "c", 1, 900.0, "edge"), ("a", "a", 1, 1.0, "edge")]
    known = [("b", "a", 100.0), ("a", "b", 700.0)]
    got = {(r.gene_a, r.gene_b): r for r in edges.edge_evidence(
        spark.createDataFrame(rows, "gene_a string, gene_b string, source_run int, observed_score double, evidence_type string"), spark.createDataFrame(known, "gene_a string, gene_b string, score double"), 400.0).collect()}
    ab, ac = got["a", "b"], got["a", "c"]
    assert set(got) == {("a", "b"), ("a", "c")} and (ab.occurrences, ab.support_runs, ab.copresences) == (3, 2, 2)
    assert ab.score == pytest.approx(0.5 + 0.3 * 2 / 3 + 0.2) and (ab.novelty, ab.status, ab.known_score) == ("known", "accepted_supported", 700.0)
    assert ac.score == pytest.approx(0.25 + 0.27) and (ac.novelty, ac.status) == ("missing", "candidate")


def test_class_panel_keeps_sites_that_a_class_lacks(spark):
    counts = spark.createDataFrame([("a", "1", "CG", 1, 9, 1), ("b", "1", "CG", 1, 1, 9), ("a", "1", "CG", 2, 9, 1)], COUNTS).withColumn("k", F.when(F.col("sample_id") == "a", 0).otherwise(1))
    panel = {r.pos: r for r in multiclass.class_panel(counts, "k", [0, 1], bins=4).collect()}
    assert panel[2].p[1] == pytest.approx([0.25] * 4) and panel[2].p[0] == pytest.approx([0.5 / 3, 0.5 / 3, 0.5 / 3, 1.5 / 3])
    bare = {r.pos: r for r in multiclass.class_panel(counts, "k", [0, 1], bins=4, smoothing=0.0).collect()}
    assert bare[2].p[1] == pytest.approx([0.25] * 4)
    own = multiclass.class_panel(counts, "k", [0, 1], [F.col("pos").cast("double"), F.lit(0.0)], bins=4)
    got = {r.sample_id: r.scores for r in multiclass.class_scores(counts, own, 2, bins=4).collect()}
    assert got["a"][0] == pytest.approx(math.log(0.5)) and got["a"][1] == 0.0


def test_bootstrap_metrics(spark):
    pred = spark.createDataFrame([(1, 1)] * 8 + [(1, 0)] * 2 + [(0, 0)] * 15 + [(0, 1)] * 5, "y_true int, y_pred int")
    got = {r.metric: r for r in scoring.bootstrap_metrics(pred, 400).collect()}
    f1, f0 = 16 / (16 + 7), 30 / (30 + 7)
    want = {"accuracy": 23 / 30, "balanced_accuracy": (0.8 + 0.75) / 2, "sensitivity": 0.8, "specificity": 0.75, "f1": f1, "macro_f1": (f1 + f0) / 2}
    assert {k: r.point for k, r in got.items()} == {k: pytest.approx(v) for k, v in want.items()}
    assert all(r.n_valid == 400 and r.low <= r.mean <= r.high and r.sd > 0 and abs(r.mean - r.point) < 0.05 for r in got.values())
    assert got["sensitivity"].sd == pytest.approx(math.sqrt(0.8 * 0.2 / 10), rel=0.25)  # what a resample of ten rows has
    one = {r.metric: r for r in scoring.bootstrap_metrics(pred.where("y_true = 1"), 20).collect()}
    assert one["specificity"].n_valid == 0 and one["specificity"].point is None and one["sensitivity"].n_valid == 20
    balanced = scoring.bootstrap(pred, 400).first()
    assert balanced["mean"] == pytest.approx(got["balanced_accuracy"]["mean"])




def test_feature_heads_equal_numpy(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(30, 4)) + np.arange(30)[:, None] % 3
    x[5, 1] = np.nan
    rows = [(f"s{i:02d}", f"f{j}", float(v)) for i, r in enumerate(x) for j, v in enumerate(r)]
    long = spark.createDataFrame(rows, "sample_id string, feature string, value double")
    labels = spark.createDataFrame([(f"s{i:02d}", i % 3) for i in range(30)], "sample_id string, label int")
    schema = derived.FrozenSchema.fit(long)
    heads = multiclass.feature_heads(long, labels, schema, [0, 1, 2], bins=5)
    got = {r.sample_id: r for r in multiclass.score_feature_heads(long, schema, heads, 3, bins=5).collect()}
    filled = np.where(np.isnan(x), np.nanmedian(x, 0), x)
    low, high = np.nanmin(x, 0), np.nanmax(x, 0)
    b = np.minimum((np.clip((filled - low) / (high - low), 1e-7, 1 - 1e-7) * 5).astype(int), 4)
    for i in (0, 5, 29):
        logits = []
        for k in range(3):
            own = np.arange(30) % 3 == k
            d = [np.log(max((b[own, j] == b[i, j]).mean() * 5, 1e-300)) for j in range(4)]
            e = [np.log(max((b[~own, j] == b[i, j]).mean() * 5, 1e-300)) for j in range(4)]
            logits.append(np.mean(np.maximum(d, -20) - np.maximum(e, -20)) * min(2 * 2, 10) + np.log(0.5))
        logits = np.clip(logits, -40, 40)
        assert got[f"s{i:02d}"].logits == pytest.approx(logits.tolist()) and got[f"s{i:02d}"].p == pytest.approx((np.exp(logits) / np.exp(logits).sum()).tolist())


def test_learned_head(spark):
    rng = np.random.default_rng(4)
    rows = [(f"s{i}", (rng.normal(0, 0.3, 3) + 2 * np.eye(3)[i % 3]).tolist()) for i in range(60)]
    labels = [(f"s{i}", i % 3 if i < 50 else None) for i in range(60)]
    _, p = multiclass.learned_head(spark.createDataFrame(rows, "sample_id string, scores array<double>"), spark.createDataFrame(labels, "sample_id string, label int"))
    got = {r.sample_id: r.p for r in p.collect()}
    assert len(got) == 60 and all(sum(v) == pytest.approx(1) for v in got.values())
    assert all(int(np.argmax(got[f"s{i}"])) == i % 3 for i in range(60))  # those without a label too


def test_time_dependent_auc(spark):
    rng = np.random.default_rng(1)
    rows = [(float(rng.integers(1, 20)), int(rng.random() < 0.6), float(rng.integers(0, 6))) for _ in range(120)]
    got = {r.horizon: r for r in scoring.time_dependent_auc(spark.createDataFrame(rows, "time double, event int, risk double"), [0.0, 5.0, 12.0, 50.0]).collect()}
    for h in (5.0, 12.0):
        case, control = [r for t, e, r in rows if t <= h and e], [r for t, e, r in rows if t > h]
        assert got[h].auc == pytest.approx(np.mean([(a > b) + 0.5 * (a == b) for a in case for b in control])) and (got[h].n1, got[h].n0) == (len(case), len(control))
    assert got[0.0].auc is None and got[50.0].auc is None


def test_nested_test(spark):
    rng = np.random.default_rng(2)
    x, z = rng.normal(size=150), rng.normal(size=150)
    time = np.round(rng.exponential(np.exp(-0.8 * x)), 1) + 0.1
    event = rng.random(150) < 0.8
    rows = spark.createDataFrame([(float(t), int(e), float(a), float(b)) for t, e, a, b in zip(time, event, x, z)], "time double, event int, x double, z double")

    def log_likelihood(beta, cols):
        eta = cols @ beta
        return sum(eta[i] - math.log(np.exp(eta[time >= time[i]]).sum()) for i in range(150) if event[i])

    def best(cols):
        beta = np.zeros(cols.shape[1])
        for _ in range(400):
            grad = np.array([(log_likelihood(beta + d, cols) - log_likelihood(beta - d, cols)) / 2e-5 for d in np.eye(len(beta)) * 1e-5])
            beta = beta + 0.005 * grad
        return log_likelihood(beta, cols)

    full, reduced, none = best(np.c_[x, z]), best(x[:, None]), log_likelihood(np.zeros(1), x[:, None])
    r = models.nested_test(rows, ["x", "z"], ["x"]).first()
    assert r.statistic == pytest.approx(max(2 * (full - reduced), 0), abs=1e-4) and r.degrees == 1 and r.p_value == pytest.approx(math.erfc(math.sqrt(r.statistic / 2)), abs=1e-9)
    assert models.nested_test(rows, ["x"], []).first().statistic == pytest.approx(2 * (reduced - none), abs=1e-4)
    with pytest.raises(ValueError, match="some of the full"):
        models.nested_test(rows, ["x"], ["z"])


def test_rank_deficient_sites_have_no_slopes_and_keep_their_values(spark):
    values = [(f"s{i}", site, float(i * i)) for site, n in (("full", 6), ("two", 2), ("line", 5)) for i in range(n)]
    cov = [(f"s{i}", float(i), float(2 * i + (i == 5))) for i in range(6)]  # collinear but for the last sample
    v = spark.createDataFrame(values, "sample_id string, site string, m double")
    c = spark.createDataFrame(cov, "sample_id string, age double, dose double")
    fit = panels.fit_covariates(v, c, ["age", "dose"], ["site"])
    got = {r.site: r for r in fit.collect()}
    want = np.linalg.lstsq(np.array([[1, a, d] for _, a, d in cov]), np.arange(6.0) ** 2, rcond=None)[0]
    assert [got["full"].intercept, got["full"].slope_age, got["full"].slope_dose] == pytest.approx(want.tolist())
    assert all(got[s].slope_age is None and got[s].intercept is None for s in ("two", "line"))
    left = {(r.site, r.sample_id): (r.m, r.residual) for r in panels.residualize_on(v, c, fit, ["age", "dose"], ["site"]).collect()}
    assert all(m == r for (s, _), (m, r) in left.items() if s != "full") and any(m != r for (s, _), (m, r) in left.items() if s == "full")


def test_module_names_may_hold_any_letter(spark):
    modules = spark.createDataFrame([("a|b", "g1"), ("a|b", "g2"), ("c", "g1"), ("c", "g2")], "module string, node string")
    links = spark.createDataFrame([("g1", "g2", 1)], "src string, dst string, weight long")
    got = {r.module: r for r in graph.module_coherence(modules, links, graph.degrees(links)).collect()}
    assert got["a|b"].largest_share == got["c"].largest_share == 1.0 and got["a|b"].coherence == got["c"].coherence


def test_in_all(spark):
    rows = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x"), (2, "x"), (None, "y")], "run int, k string")
    assert [r.k for r in stability.in_all(rows, "run", ["k"]).collect()] == ["x"]
    assert sorted(r.k for r in stability.in_all(rows, "run", ["k"], 0.5).collect()) == ["x", "y"]
    assert stability.in_all(rows.limit(0), "run", ["k"]).count() == 0


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_expression_files(spark, tmp_path):
    write(f"{tmp_path}/genes/sample_id=s1/counts.tsv", "id\tn\ng1\t3\ng1\t2\ng2\tmany\n")
    write(f"{tmp_path}/genes/sample_id=s2/counts.tsv", "id\tn\ng2\t1.5\n")
    got = {(r.sample_id, r.gene): r["count"] for r in expression.read_gene_table(spark, f"{tmp_path}/genes").collect()}
    assert got == {("s1", "g1"): 5.0, ("s2", "g2"): 1.5}
    write(f"{tmp_path}/star/sample_id=s1/r.tab", "N_unmapped\t1\t1\t1\ng1\t5\t3\t2\ng2\t7\t7\t0\n")
    assert {r.gene: r["count"] for r in expression.read_star_counts(spark, f"{tmp_path}/star", 2).collect()} == {"g1": 2.0, "g2": 0.0}
    write(f"{tmp_path}/tx/sample_id=s1/abundance.tsv", "target_id\tlength\teff_length\test_counts\ttpm\nT1.1\t9\t9\t4\t1\nT1.2\t9\t9\t6\t2\nT2\t9\t9\t1\t1\nT9.3\t9\t9\t8\t5\nT2\t9\t9\tx\t1\n")
    genes = spark.createDataFrame([("T1", "gB"), ("T1", "gA"), ("T1.2", "gC"), ("T2", "gA"), (None, "gD")], "tx string, gene string")
    got = {r.gene: (r["count"], r.tpm) for r in expression.genes_of_transcripts(expression.read_abundance(spark, f"{tmp_path}/tx"), genes).collect()}
    assert got == {"gA": (5.0, 2.0), "gC": (6.0, 2.0), "T9.3": (8.0, 5.0)}


def test_protein_files(spark, tmp_path):
    write(f"{tmp_path}/lfq/sample_id=s1/lfq.tsv", "Peptide\tcharge\tProteins\trun1\trun2\nAA\t2\tP1\t1.5\t2\nBB\t3\tP1\t1\tnone\nCC\t2\tP2\t0\t0\n")
    assert [tuple(r) for r in expression.read_peptide_table(spark, f"{tmp_path}/lfq").collect()] == [("s1", "P1", 4.5)]
    write(f"{tmp_path}/bad/sample_id=s1/lfq.tsv", "Peptide\tx\nAA\t2\n")
    with pytest.raises(ValueError, match="protein column"):
        expression.read_peptide_table(spark, f"{tmp_path}/bad")
    write(f"{tmp_path}/long.tsv", "SampleID\tAssay\tNPX\ns1\tIL6\t3.5\ns2\tIL6\tNaNo\ns1\tTNF\t1\n")
    assert sorted(tuple(r) for r in expression.read_panel_matrix(spark, f"{tmp_path}/long.tsv").collect()) == [("s1", "IL6", 3.5), ("s1", "TNF", 1.0)]
    write(f"{tmp_path}/wide.tsv", "name\tA.1\tB\ns1\t1\t\ns2\t2\t3\n")
    assert sorted(tuple(r) for r in expression.read_panel_matrix(spark, f"{tmp_path}/wide.tsv").collect()) == [("s1", "A.1", 1.0), ("s2", "A.1", 2.0), ("s2", "B", 3.0)]
