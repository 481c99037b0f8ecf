"""Hand-computed values, invariances and plans of single operators."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitewise.functions import histograms, special
from sitewise.operators import centroid, detect, fdr, graph, intervals, models, samples, stability
from sitewise.plans.fixtures import Tables

SF = "/root/testdata/sf0.001"


def patterns(spark, counts):
    return spark.createDataFrame([("s", 0, k, v) for k, v in counts.items()], "sample_id string, tile long, pattern long, cnt long")


@pytest.mark.parametrize(("counts", "entropy"), [({0: 10}, 0.0), ({0: 5, 3: 5}, 0.5), ({0: 1, 1: 1, 2: 1, 3: 1}, 1.0)])
def test_pattern_entropy(spark, counts, entropy):
    assert samples.pattern_measures(patterns(spark, counts), 2).first().entropy == pytest.approx(entropy)


def test_pattern_measures(spark):
    assert samples.pattern_measures(patterns(spark, {k: 2 for k in range(4)}), 2).first().epipolymorphism == pytest.approx(0.75)
    assert samples.pattern_measures(patterns(spark, {0: 2, 3: 2, 1: 6}), 2).first().discordant == pytest.approx(0.6)


@pytest.mark.parametrize(("bits", "mhl"), [((1, 1, 1), 1.0), ((0, 0, 0), 0.0), ((1, 1, 0), (1 * 2 / 3 + 2 * 1 / 2 + 0) / 6)])
def test_haplotype_load(spark, bits, mhl):
    reads = spark.createDataFrame([("s", 1, i, m) for i, m in enumerate(bits)], "sample_id string, read_id long, i long, meth long")
    assert samples.haplotype_load(reads, 3).first().mhl == pytest.approx(mhl)


def test_binary_entropy(spark):
    assert spark.range(1).select(samples.binary_entropy(F.lit(0.5)).alias("h")).first().h == pytest.approx(1.0)


@pytest.mark.parametrize(("sql", "value"), [
    (special.norm_sf("1.959963984540054E0"), 0.025), (special.norm_sf("-1E0"), 0.8413447460685429), (special.norm_sf("10E0"), 7.619853024160527e-24),
    (special.norm_ppf("0.975E0"), 1.959963984540054), (special.norm_ppf("1E-10"), -6.361340902404056), (special.lgamma("0.5E0"), 0.5723649429247001),
    (special.lgamma("10E0"), 12.801827480081469), (special.digamma("1E0"), -0.5772156649015329), (special.kolmogorov_sf("1E0"), 0.26999967167735456)])
def test_special(spark, sql, value):
    assert spark.range(1).select(F.expr(sql).alias("v")).first().v == pytest.approx(value, rel=3e-9)


def test_histogram_functions(spark):
    a, b = [0] * 10 + [3, 4] + [0] * 8, [0] * 12 + [5, 1] + [0] * 6
    row = spark.createDataFrame([(a, b)], "a array<long>, b array<long>").select(
        histograms.mann_whitney_u(F.col("a"), F.col("b")).alias("u"), histograms.bhattacharyya(F.col("a"), F.col("a")).alias("same"), histograms.bhattacharyya(F.col("a"), F.col("b")).alias("bc"),
        histograms.ks_statistic(F.col("a"), F.col("b")).alias("ks"), histograms.cdf_edges(F.col("a")).alias("e")).first()
    assert row.u == 0 and row.same == pytest.approx(1.0) and row.e[-1] == 1.0
    grid = np.linspace(0, 1, 256)
    f = [np.interp(grid, np.linspace(0, 1, 21), np.concatenate([[0], np.cumsum(h) / sum(h)])) for h in (a, b)]
    assert row.ks == pytest.approx(np.abs(f[0] - f[1]).max()) and row.bc == pytest.approx(np.sqrt(np.maximum(np.diff(f[0]) * np.diff(f[1]), 0)).sum(), abs=1e-6)


def test_bins_are_exact(spark):
    rows = spark.createDataFrame([(0, 0), (1, 0), (0, 5), (1, 19), (1, 9), (19, 1)], "mC long, uC long").select(centroid.level_bin().alias("b"))
    assert [r.b for r in rows.collect()] == [0, 19, 0, 1, 2, 19]


def test_merge_equals_build_and_order_does_not_matter(spark):
    t = Tables(spark, SF)
    keys = [*centroid.KEY, "N", "Sm", "Su", "Sc2", "bin_counts"]
    whole = sorted(map(tuple, centroid.build(t.site_counts).select(*keys).collect()))
    parts = [centroid.build(t.site_counts.where(F.col("sample_id").cast("long") % 3 == k)) for k in range(3)]
    assert sorted(map(tuple, centroid.merge([(p, 1) for p in parts]).select(*keys).collect())) == whole
    assert sorted(map(tuple, centroid.build(t.site_counts.repartition(11)).select(*keys).collect())) == whole
    back = centroid.merge([(centroid.build(t.site_counts), 1), (parts[0], -1)]).select(*keys)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, centroid.merge([(p, 1) for p in parts[1:]]).select(*keys).collect()))


def test_q_values_with_ties_and_nulls(spark):
    p = [0.01, 0.01, 0.02, 0.5, 0.5, 1.0, None, 1e-320]
    df = spark.createDataFrame([("g", v) for v in p], "grp string, p double")
    got = {r.p: r.q_value for r in fdr.benjamini_hochberg(df, "p", ["grp"]).collect()}
    known = sorted(v for v in p if v is not None)
    want, low = {}, 1.0
    for i in range(len(known), 0, -1):
        low = min(low, known[i - 1] * len(known) / i)
        want[known[i - 1]] = min(low, 1.0) if known[i - 1] not in want else want[known[i - 1]]
    assert got.pop(None) is None and got == pytest.approx(want)


def test_effect_size_limits(spark):
    e = lambda d, o: spark.range(1).select(detect.effect_size(F.lit(d), F.lit(o), F.lit(0.0), F.lit(0.0)).alias("e")).first().e
    assert e(0.5, 1.0) == 0.0 and e(-0.5, 0.0) == 0.5 and e(2.0, 0.0) == 1.0


def test_elbow_is_interior(spark):
    v = [1, .75, .52, .36, .24, .08, .03, .01, .009, .008, .007]
    r = detect.elbow(spark.createDataFrame([("a", float(x)) for x in v], "g string, v double"), "v", ["g"], 1e-6).first()
    assert 1 < r.elbow_rank < len(v)


def test_pathway_terms_merge(spark):
    s = spark.createDataFrame([("l", "Cell Cycle", g) for g in "AB"] + [("l", " cell  cycle", g) for g in "BC"], "library string, term string, gene string")
    assert sorted((r.term, r.gene) for r in graph.merge_terms(s).collect()) == [("cell cycle", g) for g in "ABC"]


def test_empty_panels_have_jaccard_one(spark):
    none = spark.createDataFrame([], "k long")
    assert stability.jaccard(none, none, ["k"]).first().jaccard == 1.0


def test_split_leaves_a_test_sample(spark):
    s = spark.createDataFrame([(str(i), "a") for i in range(1, 3)] + [("9", "b")], "sample_id string, cohort string")
    rows = stability.split(s, spark.createDataFrame([(1,)], "run_id long"), 1.0).collect()
    assert sorted((r.cohort, r.part) for r in rows) == [("a", "test"), ("a", "train"), ("b", "train")]


def test_long_chain_is_one_component(spark):
    e = spark.createDataFrame([(f"n{i:03}", f"n{i + 1:03}") for i in range(150)] + [("x", "y")], "src string, dst string")
    got = {r.node: r.component for r in graph.components(e).collect()}
    assert {v for k, v in got.items() if k[0] == "n"} == {"n000"} and got["y"] == "x"


def test_concordance_of_perfect_risk(spark):
    rows = spark.createDataFrame([(i, 1, float(-i)) for i in range(50)], "time long, event int, risk double")
    assert models.concordance(rows, 8).first().c_index == 1.0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_nested_loops_and_pushed_filters(spark):
    t = Tables(spark, SF)
    for df in (intervals.overlap(t.sites, t.regions), intervals.within(t.sites, t.genes.select("chrom", F.col("gene_start").alias("pos_b")), 30), intervals.nearest(t.sites, t.regions.where("feature_type = 'exon'"))):
        assert "CartesianProduct" not in plan(df) and "BroadcastNestedLoopJoin" not in plan(df)
    from sitewise.sources.scans import scan_sites

    path = f"{SF}/lineitem.parquet"
    text = plan(scan_sites(spark.read.parquet(path).withColumnsRenamed({"l_partkey": "pos", "l_returnflag": "chrom"}), chroms=["R"], start=5, end=9).select("pos"))
    assert "PushedFilters: [" in text and "GreaterThanOrEqual" in text and "l_comment" not in text
