"""Fitted models against enumeration, published values and plain loops."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitewise.functions import incomplete as I
from sitewise.operators import classify, clusters, derived, families, fit_tests, genes, motifs, tiles
from sitewise.plans import fits_queries, registry
from sitewise.plans.fixtures import Tables

SF = "/root/testdata/sf0.001"


# -- special functions -----------------------------------------------------------------
def beta_by_sum(x, a, b, n=200_001):
    """I_x(a, b) by Simpson's rule over the angle, whose ends are tame for a, b >= 1/2."""
    t = np.linspace(0, math.asin(math.sqrt(x)), n)
    log = lambda v, c: np.where(v > 0, c * np.log(np.maximum(v, 1e-300)), 0.0 if c == 0 else -np.inf)
    f = 2 * np.exp(log(np.sin(t), 2 * a - 1) + log(np.cos(t), 2 * b - 1) + math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b))
    return (t[1] - t[0]) / 3 * (f[0] + f[-1] + 4 * f[1:-1:2].sum() + 2 * f[2:-1:2].sum())


def test_incomplete_beta(spark):
    rows = [(x, a, b) for a, b in ((0.5, 0.5), (2.0, 3.0), (30.0, 0.7), (400.0, 90.0), (1.0, 1.0)) for x in (0.01, 0.3, 0.5, 0.9, 0.99)]
    df = spark.createDataFrame(rows, "x double, a double, b double")
    got = df.select("x", "a", "b", I.beta_cdf(F.col("x"), F.col("a"), F.col("b")).alias("v")).collect()
    for r in got:
        assert r.v == pytest.approx(beta_by_sum(r.x, r.a, r.b), abs=1e-9)
        assert I.beta_grid(np.array([r.x]), np.array([r.a]), np.array([r.b]))[0, 0] == pytest.approx(r.v, abs=1e-11)
    ends = df.limit(1).select(*[I.beta_cdf(F.lit(x), F.lit(2.0), F.lit(3.0)).alias(f"c{i}") for i, x in enumerate((-1.0, 0.0, 1.0, 2.0))]).first()
    assert tuple(ends) == (0.0, 0.0, 1.0, 1.0)
    # Beyond LARGE the normal approximation joins the exact values.
    big = I.beta_grid(np.array([0.49, 0.5, 0.503]), np.array([10_001.0]), np.array([10_001.0]))
    exact = [beta_by_sum(x, 10_001.0, 10_001.0) for x in (0.49, 0.5, 0.503)]
    assert np.abs(big - exact).max() < 1e-4


def test_published_tails(spark):
    """Points of the usual tables of chi-square, t and F."""
    one = spark.range(1)
    chi = {(3.841458820694124, 1): 0.05, (11.070497693516351, 5): 0.05, (23.209251158954356, 10): 0.01, (0.0157907740934312, 1): 0.9, (124.34211340400407, 100): 0.05}
    t = {(12.706204736432095, 1): 0.05, (2.2281388519649385, 10): 0.05, (2.75, 30): 0.01000}
    f = {(4.964602743730711, 1, 10): 0.05, (3.3258345304130112, 5, 10): 0.05}
    cols = [I.chi2_sf(F.lit(x), F.lit(k)) for x, k in chi] + [I.t_p_value(F.lit(x), F.lit(k)) for x, k in t] + [I.f_sf(F.lit(x), F.lit(a), F.lit(b)) for x, a, b in f]
    got = one.select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()
    want = [*chi.values(), *t.values(), *f.values()]
    assert [abs(a - b) < (1e-4 if b == 0.01000 and i == 7 else 1e-9) for i, (a, b) in enumerate(zip(got, want))] == [True] * len(want)
    even = one.select(I.gamma_sf(F.lit(3.0), F.lit(8.5)).alias("v"), I.gamma_sf(F.lit(0.5), F.lit(0.0)).alias("z"), I.trigamma(F.lit(1.0)).alias("t")).first()
    assert even.v == pytest.approx(math.exp(-8.5) * (1 + 8.5 + 8.5**2 / 2), rel=1e-9) and even.z == 1.0 and even.t == pytest.approx(math.pi**2 / 6, abs=1e-9)


def test_beta_log_density_and_llr_moments(spark):
    a, b, da, db = 2.5, 4.0, 0.7, -1.2
    x = (np.arange(400_000) + 0.5) / 400_000
    log_density = (a - 1) * np.log(x) + (b - 1) * np.log(1 - x) - (math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b))
    w = np.exp(log_density) / len(x)
    llr = da * np.log(x) + db * np.log(1 - x)
    lit = [F.lit(v) for v in (a, b, da, db)]
    mean, var = I.beta_llr_moments(*lit)
    got = spark.range(1).select(mean.alias("m"), var.alias("v"), I.beta_log_density(F.lit(float(x[1000])), *lit[:2]).alias("d"), I.beta_overlap(*lit[:2], *lit[:2]).alias("o")).first()
    m = (w * llr).sum()
    assert got.m == pytest.approx(m, abs=1e-6) and got.v == pytest.approx((w * (llr - m) ** 2).sum(), abs=1e-5)
    assert got.d == pytest.approx(log_density[1000], abs=1e-9) and got.o == pytest.approx(1.0)


def test_fit_distances(spark):
    rng = np.random.default_rng(2)
    hists = [rng.integers(0, 9, 20).tolist() for _ in range(6)] + [[0] * 20, [5] + [0] * 19]
    rows = [(i, h, 0.4, 0.03 if i != 3 else 0.0, 2.0 + i, 3.0, 50) for i, h in enumerate(hists)]
    df = spark.createDataFrame(rows, "i int, bin_counts array<long>, mean double, variance double, a double, b double, N long")
    grid = np.linspace(0, 1, 256)
    phi = lambda z: 0.5 * math.erfc(-z / math.sqrt(2))
    for r in fit_tests.fit_distances(df).collect():
        h = np.array(r.bin_counts, float)
        if not h.sum():
            assert r.ks_normal is r.ks_beta is r.closest is None
            continue
        ecdf = np.interp(grid, np.linspace(0, 1, 21), np.concatenate([[0], np.cumsum(h)]) / h.sum())
        beta = np.array([0.0, *[beta_by_sum(x, r.a, r.b, 2001) for x in grid[1:-1]], 1.0])
        assert r.ks_beta == pytest.approx(np.abs(ecdf - beta).max(), abs=1e-8)
        if r.variance > 0:
            sd, low, high = math.sqrt(r.variance), phi(-r.mean / math.sqrt(r.variance)), phi((1 - r.mean) / math.sqrt(r.variance))
            normal = np.array([(phi((x - r.mean) / sd) - low) / (high - low) for x in grid])
            assert r.ks_normal == pytest.approx(np.abs(ecdf - normal).max(), abs=1e-9)
            assert r.closest == ("normal" if r.ks_normal < r.ks_beta else "beta")
        else:
            assert r.ks_normal is None and r.p_normal is None and r.closest == "beta"


def test_lancaster_is_fisher_only_with_equal_degrees(spark):
    df = spark.createDataFrame([("a", 0.01, 1.0, 1.0), ("a", 0.2, 3.0, 2.0), ("a", None, 9.0, 9.0), ("b", 1e-320, 1.0, 0.0)], "g string, p double, d double, w double")
    plain = {r.g: r for r in fit_tests.lancaster(df, ["g"], "p").collect()}
    s = -2 * (math.log(0.01) + math.log(0.2))
    assert plain["a"].k == 2 and plain["a"].p_combined == pytest.approx(math.exp(-s / 2) * (1 + s / 2), rel=1e-9)
    odd = {r.g: r for r in fit_tests.lancaster(df, ["g"], "p", F.col("d"), F.col("w")).collect()}
    assert odd["a"].statistic == pytest.approx((-2 * math.log(0.01) - 2 * 2 * math.log(0.2) / 3) / 3) and odd["a"].degrees == pytest.approx(2 * (1 + 6) / 3)
    assert odd["b"].p_combined is None


def test_combine_p_has_all_seven_combiners(spark):
    df = spark.createDataFrame([("a", 0.01), ("a", 0.2), ("a", 0.7), ("b", 1e-320), ("c", 1.0)], "g string, p_value double")
    found = {r.g: r for r in genes.combine_p(df, ["g"]).collect()}
    s = -2 * (math.log(0.01) + math.log(0.2) + math.log(0.7))
    assert found["a"].lancaster == pytest.approx(math.exp(-s / 2) * (1 + s / 2 + s * s / 8), rel=1e-9)
    assert found["b"].lancaster == pytest.approx(1e-300, rel=1e-9) and found["c"].lancaster == pytest.approx(1.0)
    names = {"fisher", "stouffer", "lancaster", "tippett", "edgington", "mudholkar_george", "simes"}
    assert names <= set(registry.queries()["gene_combine_p"](spark, "/root/testdata/sf0.001").columns)


# -- tiles -----------------------------------------------------------------------------
def enumerated(counts, stats, steps=20_000, rate=0.3):
    """Plain gradient ascent over all states, one tile at a time."""
    p, theta = counts / counts.sum(), np.zeros(stats.shape[1])
    for _ in range(steps):
        e = np.exp(stats @ theta)
        theta += rate * (p @ stats - e @ stats / e.sum()) / 2
    e = np.exp(stats @ theta)
    return theta, e / e.sum()


@pytest.mark.parametrize(("k", "couplings"), [(1, "nearest"), (3, "nearest"), (3, "all"), (4, "nearest")])
def test_tiles_match_enumeration(k, couplings):
    rng = np.random.default_rng(k)
    states = tiles.States(k, couplings)
    stats = states.statistics()
    counts = rng.integers(1, 30, (3, 2**k)).astype(float)
    theta, converged = tiles.fit_states(counts, states, tol=1e-10)
    found = tiles.state_measures(theta, states)
    level = np.array([bin(s).count("1") / k for s in range(2**k)])
    for i, c in enumerate(counts):
        t, p = enumerated(c, stats)
        assert np.abs(theta[i] - t).max() < 1e-5 and np.abs(found["prob"][i] - p).max() < 1e-6 and converged[i]
        assert found["mml"][i] == pytest.approx(p @ level, abs=1e-6) and found["nme"][i] == pytest.approx(-(p * np.log2(p)).sum() / k, abs=1e-6)

        def at(theta):
            e = np.exp(stats @ theta)
            q = e / e.sum()
            return q @ level, -(q * np.log2(q)).sum() / k

        step = [np.eye(len(t))[j] * 1e-5 for j in range(len(t))]
        slopes = np.array([(np.array(at(t + d)) - at(t - d)) / 2e-5 for d in step])
        assert found["msi"][i] == pytest.approx(np.linalg.norm(slopes[:, 0]), abs=1e-5) and found["esi"][i] == pytest.approx(np.linalg.norm(slopes[:, 1]), abs=1e-5)


def test_sparse_tiles_meet_their_means_and_do_not_depend_on_neighbours():
    rng = np.random.default_rng(3)
    states = tiles.States(4)
    counts = (rng.integers(0, 3, (500, 16)) * rng.integers(0, 2, (500, 16))).astype(float)
    counts[0], counts[1], counts[2] = 0, np.eye(16)[5] * 7, 0
    theta, converged = tiles.fit_states(counts, states)
    assert converged[counts.sum(1) > 0].all() and np.isfinite(theta).all() and not theta[0].any()
    for i in (1, 5, 77):
        alone, _ = tiles.fit_states(counts[[i]], states)
        assert np.allclose(alone[0], theta[i])


def test_differential_tiles(spark):
    rng = np.random.default_rng(4)
    rows = [(g, t, int(p), int(rng.integers(1, 9))) for g in (0, 1) for t in range(30) for p in range(8)]
    rows += [(0, 99, 1, 50), (1, 98, 1, 50), (None, 1, 1, 500)]
    df = spark.createDataFrame(rows, "g int, tile int, pattern long, cnt long")
    got = {r.tile: r for r in tiles.differential_tiles(df, F.col("g"), k=3, min_reads=10).collect()}
    stats = tiles.States(3).statistics()
    level = (stats[:, :3].mean(1) + 1) / 2
    for t in list(got)[:6]:
        p, q = (enumerated(np.array([next(c for gg, tt, s, c in rows if (gg, tt, s) == (g, t, p)) for p in range(8)], float), stats)[1] for g in (0, 1))
        m, h = (p + q) / 2, lambda v: -(v * np.log2(v)).sum()
        r = got[t]
        assert r.dmml == pytest.approx((p - q) @ level, abs=1e-5) and r.dnme == pytest.approx((h(p) - h(q)) / 3, abs=1e-5)
        assert r.model_jsd == pytest.approx(((p * np.log2(p / m)).sum() + (q * np.log2(q / m)).sum()) / 2, abs=1e-5) and r.mutual_information == pytest.approx(r.model_jsd, abs=1e-9)
    order = sorted(got.values(), key=lambda r: r["rank"])
    assert [r["rank"] for r in order] == list(range(1, len(order) + 1)) and all(abs(a.dnme) >= abs(b.dnme) for a, b in zip(order, order[1:]))
    assert 98 not in got and 99 not in got
    assert tiles.differential_tiles(df.limit(0), F.col("g"), k=3).count() == 0


# -- clusters ----------------------------------------------------------------------------
def planted(spark, groups=3, per=6, sites=40, seed=5):
    rng = np.random.default_rng(seed)
    centre = rng.uniform(0.1, 0.9, (groups, sites))
    rows = []
    for s in range(groups * per):
        for j in range(sites):
            if rng.random() < 0.8:
                n = int(rng.integers(5, 30))
                m = int(rng.binomial(n, np.clip(centre[s % groups, j] + rng.normal(0, 0.05), 0.01, 0.99)))
                rows.append((f"s{s:02d}", "1", "CG", j, m, n - m))
    return spark.createDataFrame(rows, "sample_id string, chrom string, context string, pos long, mC long, uC long"), groups * per


def reference_history(rows, start, k, min_variance=1e-3):
    """The same loop in numpy: hard clusters without balancing."""
    ids = sorted({r.sample_id for r in rows})
    sites = sorted({r.pos for r in rows})
    x = np.full((len(ids), len(sites)), np.nan)
    for r in rows:
        x[ids.index(r.sample_id), sites.index(r.pos)] = r.mC / (r.mC + r.uC)
    lab, history = np.array([start[i] for i in ids]), []
    clipped = np.clip(x, 1e-6, 1 - 1e-6)
    lb = np.vectorize(lambda a, b: math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b))
    while True:
        ll = np.full((len(ids), k), -1e300)
        for c in range(k):
            part = x[lab == c]
            known = ~np.isnan(part).all(0)
            m = np.nanmean(part[:, known], 0)
            v = np.maximum(np.nanmean(part[:, known] ** 2, 0) - m**2, min_variance)
            mu = np.clip(m, 1e-6, 1 - 1e-6)
            size = np.maximum(mu * (1 - mu) / v - 1, 1e-3)
            a, b = np.maximum(mu * size, 1e-3), np.maximum((1 - mu) * size, 1e-3)
            d = (a - 1) * np.log(clipped[:, known]) + (b - 1) * np.log(1 - clipped[:, known]) - lb(a, b)
            ll[:, c] = np.nanmean(d, 1)
        new, total = ll.argmax(1), ll.max(1).sum()
        if history and total < history[-1] - 1e-12:
            return history, dict(zip(ids, best))
        same = bool(history) and (new == best).all()
        history.append(total)
        best = lab = new
        if same:
            return history, dict(zip(ids, best))


def test_clusters_follow_the_plain_loop_and_never_fall(spark):
    counts, n = planted(spark)
    rng = random.Random(6)
    start = {f"s{s:02d}": (s % 3 if rng.random() < 0.6 else rng.randrange(3)) for s in range(n)}
    found = clusters.cluster_samples(counts, spark.createDataFrame(list(start.items()), "sample_id string, cluster int"), 3, min_size=0)
    history, labels = reference_history(counts.collect(), start, 3)
    assert np.allclose(found.history, history, atol=1e-7) and all(b >= a - 1e-12 for a, b in zip(found.history, found.history[1:]))
    assert {r.sample_id: r.cluster for r in found.samples.collect()} == labels


def test_soft_clusters_and_rescue(spark):
    counts, n = planted(spark, 2, 5)
    start = spark.createDataFrame([(f"s{s:02d}", s % 2) for s in range(n)], "sample_id string, cluster int")
    soft = clusters.cluster_samples(counts, start, 2, soft=True, temperature=0.5)
    assert all(b >= a - 1e-12 for a, b in zip(soft.history, soft.history[1:]))
    assert all(sum(r.weights) == pytest.approx(1) for r in soft.samples.collect())
    # Three clusters, two of them empty at first: both get their least size.
    one = start.withColumn("cluster", F.lit(0))
    full = clusters.cluster_samples(counts, one, 3, min_size=2)
    sizes = {r.cluster: r["count"] for r in full.samples.groupBy("cluster").count().collect()}
    assert set(sizes) == {0, 1, 2} and min(sizes.values()) >= 2
    with pytest.raises(ValueError, match="do not fill"):
        clusters.cluster_samples(counts, one, 3, min_size=9)


# -- families ----------------------------------------------------------------------------
def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 0.0


def serial_families(rows, threshold=0.35):
    """Stage by stage and module by module."""
    seen, names, out = {}, {}, {}
    for stage in sorted({r["stage_index"] for r in rows}):
        used = set()
        for m in sorted((r for r in rows if r["stage_index"] == stage), key=lambda r: (-(r["score"] or 0), r["module"])):
            genes, paths, label = set(m["genes"] or []), set(m["pathways"] or []), m["label"] or ""
            best = None
            for f, (g, p, lab) in seen.items():
                sim = 0.7 * jaccard(genes, g) + 0.3 * jaccard(paths, p)
                sim = max(sim, 0.5) if label and label == lab else sim
                if f not in used and sim >= threshold and (best is None or (-sim, f) < best):
                    best = (-sim, f)
            f = best[1] if best else len(names) + 1
            names.setdefault(f, label or m["module"])
            used.add(f)
            out[stage, m["module"]] = (f, names[f], best is None)
            seen[f] = (genes, paths, label)
    return out


def test_families_equal_serial_choice(spark):
    rng = random.Random(7)
    rows = []
    for stage in range(4):
        for m in range(14):
            pick = lambda n, k: [f"{n}{rng.randrange(k)}" for _ in range(rng.randrange(0, 7))]
            rows.append({"stage_index": stage, "module": f"m|{m}", "score": float(rng.randrange(5)), "label": rng.choice(["", "l1", "l2", f"x{m}"]), "genes": pick("g", 9), "pathways": pick("p", 6)})
    rows.append({"stage_index": 3, "module": "odd", "score": None, "label": None, "genes": None, "pathways": None})
    df = spark.createDataFrame(rows, "stage_index long, module string, score double, label string, genes array<string>, pathways array<string>")
    got = {(r.stage_index, r.module): (r.family, r.family_label, r.is_new) for r in families.module_families(df).collect()}
    assert got == serial_families(rows)
    assert families.module_families(df.limit(0)).count() == 0


def test_registered_families_equal_serial_choice(spark):
    rows = [r.asDict() for r in fits_queries.stage_modules(Tables(spark, SF)).collect()]
    got = {(r.stage_index, r.module): (r.family, r.family_label, r.is_new) for r in registry.queries()["module_families"](spark, SF).collect()}
    assert got == serial_families(rows)


# -- motifs --------------------------------------------------------------------------------
def brute_score(matrix, seq):
    m = np.log2((np.array(matrix) + 1e-3) / (np.array(matrix) + 1e-3).sum(1, keepdims=True) / 0.25)
    pair, best = {"A": "T", "C": "G", "G": "C", "T": "A"}, None
    seq = seq.upper()
    for strand in (seq, "".join(pair.get(c, "N") for c in reversed(seq))):
        for i in range(len(strand) - len(m) + 1):
            window = strand[i:i + len(m)]
            if set(window) <= set("ACGT"):
                s = sum(m[p]["ACGT".index(c)] for p, c in enumerate(window))
                best = s if best is None else max(best, s)
    low, high = m.min(1).sum(), m.max(1).sum()
    return 0.0 if best is None or high <= low else min(1.0, max(0.0, (best - low) / (high - low)))


def test_motif_scan_over_every_window(spark, monkeypatch):
    rng = random.Random(8)
    seqs = [(i, "".join(rng.choices("ACGTacgtN", k=rng.randrange(0, 60)))) for i in range(40)] + [(40, None), (41, "N" * 30), (42, "ACGT" * 3000)]
    mats = [(f"m{k}", [[rng.random() for _ in range(4)] for _ in range(length)]) for k, length in enumerate((3, 5, 5, 8))] + [("flat", [[1.0] * 4] * 4), ("none", [])]
    monkeypatch.setattr(motifs, "MAX_MOTIFS", 4)
    got = {(r.id, r.motif): r.score for r in motifs.scan(spark.createDataFrame(seqs, "id int, seq string"), spark.createDataFrame(mats, "motif string, matrix array<array<double>>")).collect()}
    assert len(got) == len(seqs) * len(mats)
    for i, s in seqs[:-1]:
        for name, m in mats:
            assert got[i, name] == pytest.approx(brute_score(m, s or "") if m else 0.0, abs=1e-12)
    scores = spark.createDataFrame([(i, "a" if i < 4 else "b", 0.9) for i in range(12)], "id int, motif string, score double")
    factors = spark.createDataFrame([("a", "F"), ("b", "F"), ("b", "G"), ("a", "H")], "motif string, factor string")
    sets = {r.factor: (r.n_targets, r.targets) for r in motifs.target_sets(scores, factors, 0.85, 5, 9).collect()}
    assert sets == {"F": (12, list(range(9))), "G": (8, list(range(4, 12)))}


# -- classifiers ---------------------------------------------------------------------------
def test_cross_validation_equals_refitting(spark):
    rng = np.random.default_rng(9)
    labels = [(f"s{i}", int(i % 3 == 0)) for i in range(33)]
    values = [(s, f"f{j}", float(rng.normal(1.5 * y * (j < 3), 1))) for s, y in labels for j in range(6) if rng.random() < 0.9] + [("none", "f0", 1.0), ("s1", "f9", None)]
    v, y = spark.createDataFrame(values, "sample_id string, feature_id string, value double"), spark.createDataFrame(labels, "sample_id string, label int")
    fold = {r.sample_id: r.fold for r in classify.stratified_folds(y, 4).collect()}
    got = {r.fold: r.balanced_accuracy for r in classify.cross_validate(v, y, 4).collect()}
    truth, table = dict(labels), {}
    for s, f, x in values:
        if x is not None and s in truth:
            table.setdefault(s, {})[f] = x
    for k in range(4):
        train = [s for s in truth if fold[s] != k]
        hits = {0: [], 1: []}
        for s in (s for s in truth if fold[s] == k and s in table):
            score = {}
            for c in (0, 1):
                score[c] = math.log(sum(truth[t] == c for t in train))
                for f, x in table[s].items():
                    xs = np.array([table[t][f] for t in train if truth[t] == c and f in table.get(t, {})])
                    var = max(xs.var(), classify.MIN_VARIANCE)
                    score[c] += -0.5 * math.log(2 * math.pi * var) - (x - xs.mean()) ** 2 / (2 * var)
            hits[truth[s]].append(max(score, key=lambda c: (score[c], -c)) == truth[s])
        assert got[k] == pytest.approx(np.mean([np.mean(h) for h in hits.values() if h]))
    assert classify.cross_validate(v, y.limit(1), 4).count() == 0


def test_discriminant_direction_equals_numpy(spark):
    rng = np.random.default_rng(10)
    x, y = rng.normal(size=(60, 4)) + np.outer(np.arange(60) % 2, [1, 0, -1, 0.5]), np.arange(60) % 2
    rows = spark.createDataFrame([(int(k), v.tolist()) for k, v in zip(y, x)] + [(0, [1.0, None, 2.0, 3.0]), (1, None), (None, [1.0] * 4)], "y int, x array<double>").repartition(5)
    d = classify.discriminant_direction(rows, F.col("x"), F.col("y"))
    sw = np.cov(x[y == 0], rowvar=False) + np.cov(x[y == 1], rowvar=False) + 1e-6 * np.eye(4)
    want = np.linalg.solve(sw, x[y == 1].mean(0) - x[y == 0].mean(0))
    want /= np.linalg.norm(want)
    assert np.abs(d - want).max() < 1e-9
    out = [r for r in classify.project(rows, "x", d).collect() if r.x and None not in r.x]
    assert all(r.projection == pytest.approx(np.array(r.x) @ want, abs=1e-9) and np.array(r.residual) @ want == pytest.approx(0, abs=1e-9) for r in out)
    with pytest.raises(ValueError, match="two complete rows"):
        classify.discriminant_direction(rows.where("y = 1"), F.col("x"), F.col("y"))


# -- derived features ----------------------------------------------------------------------
def test_frozen_schema_is_not_fitted_again(spark, tmp_path):
    train = spark.createDataFrame([(s, f, v) for s, vs in (("a", (1.0, 5.0)), ("b", (2.0, None)), ("c", (9.0, float("nan")))) for f, v in zip("xy", vs)], "sample_id string, feature string, value double")
    derived.FrozenSchema.fit(train).write(f"{tmp_path}/schema")
    schema = derived.FrozenSchema.read(spark, f"{tmp_path}/schema")
    new = spark.createDataFrame([("n", "x", 50.0), ("n", "z", 1.0), ("n", "z", 1.0), ("m", "y", 5.0), ("m", "x", None), ("m", "x", 3.0)], "sample_id string, feature string, value double")
    got = {r.sample_id: (r.features, r.n_filled, r.n_clipped, r.n_unknown) for r in schema.apply(new).collect()}
    assert got == {"n": ([9.0, 5.0], 1, 1, 1), "m": ([3.0, 5.0], 0, 0, 0)}
    assert {r.sample_id: r.features for r in schema.apply(new.where("sample_id = 'n'")).collect()} == {"n": got["n"][0]}
