"""Queries of fitted models: tiles, distributions of sites, clusters, families, motifs, cross-validation and derived features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import incomplete
from ..operators import centroid as C
from ..operators import classify, clusters, derived, families, fit_tests, motifs, tiles
from ..operators import samples as S
from ..shared import materialize, new_path
from ..sources import scans
from .centroid_queries import BY
from .genes_queries import _HIT, _hits
from .registry import register
from .samples_queries import _PAT

_BIT = [f"((pattern >> {3 - i}) & 1)" for i in range(4)]


def _group():
    return F.col("sample_id").cast("long") % 2


@register("tile_model", f"WITH {_PAT} SELECT sample_id, tile, CAST(sum(cnt) AS BIGINT) AS n_reads, "
          + ", ".join(f"CAST(sum(cnt * {b}) AS BIGINT) AS methylated{i}" for i, b in enumerate(_BIT)) + ", "
          + ", ".join(f"CAST(coalesce(sum(cnt) FILTER ({_BIT[i]} = {_BIT[i + 1]}), 0) AS BIGINT) AS agree{i}" for i in range(3)) + ", true AS converged FROM pt GROUP BY 1, 2")
def _(t):
    """What each tile's model expects of its reads, which is what they show."""
    m = tiles.fit_tiles(S.tile_patterns(t.read_cpgs), ["sample_id", "tile"], tol=1e-9).withColumn("m", tiles.model_means())
    expected = lambda k: F.round(F.col("n_reads") * (1 + F.element_at("m", k + 1)) / 2, 2)
    whole = lambda c: F.when(c == F.round(c), c.cast("long"))
    return m.select("sample_id", "tile", "n_reads", *[whole(expected(i)).alias(f"methylated{i}") for i in range(4)], *[whole(expected(4 + i)).alias(f"agree{i}") for i in range(3)], F.col("model.converged").alias("converged"))


@register("tile_model_measures", None, "mml nme esi msi")
def _(t):
    m = tiles.fit_tiles(S.tile_patterns(t.read_cpgs), ["sample_id", "tile"])
    return m.select("sample_id", "tile", "n_reads", *[F.col(f"model.{c}").alias(c) for c in ("mml", "nme", "esi", "msi")])


@register("tile_differential", None, "mml0 nme0 mml1 nme1 dmml dnme model_jsd mutual_information")
def _(t):
    return tiles.differential_tiles(S.tile_patterns(t.read_cpgs), _group())


@register("fit_theoretical", None, "ks_normal ks_beta p_normal p_beta")
def _(t):
    c = scans.beta_moments(C.build(t.site_counts, BY).where("N > 1"))
    c = c.withColumns({"mean": C.mean(), "variance": C.variance()})
    return fit_tests.fit_distances(c).select(*BY, "N", "ks_normal", "ks_beta", "p_normal", "p_beta", "closest")


_Q = "1 - least(1, list_sum([exp((degrees / 2 + j) * ln(statistic / 2) - statistic / 2 - lgamma(degrees / 2 + j + 1)) for j in range(0, 1500)]))"


@register("gene_lancaster", _HIT + f""", p AS (SELECT gene_id, greatest(least(p_value, 1 - 1e-15), 1e-300) AS p, 1 + (pos % 3) / 2.0e0 AS d, 1.0e0 + pos % 4 AS w FROM x),
g AS (SELECT gene_id, count(*) AS k, sum(w * -2 * ln(p) / d) / sum(w) AS statistic, 2 * sum(w * d) / sum(w) AS degrees FROM p GROUP BY gene_id)
SELECT gene_id, k, statistic, degrees, {_Q} AS p_combined FROM g""", "statistic degrees p_combined")
def _(t):
    hits = _hits(t)
    return fit_tests.lancaster(hits, ["gene_id"], "p_value", 1 + (F.col("pos") % 3) / 2, 1 + F.col("pos") % 4)


_AB = """l AS (SELECT *, mC / CAST(mC + uC AS DOUBLE) AS x FROM site_counts WHERE mC + uC > 0),
g AS (SELECT cohort AS c, chrom, context, pos, count(*) AS n, sum(x) AS s, sum(x * x) AS q FROM l GROUP BY 1, 2, 3, 4),
p AS (SELECT *, least(greatest(s / n, 1e-6), 1 - 1e-6) AS mu, greatest(q / n - pow(s / n, 2), 1e-3) AS va FROM g),
ab AS (SELECT c, chrom, context, pos, greatest(mu * greatest(mu * (1 - mu) / va - 1, 1e-3), 1e-3) AS a, greatest((1 - mu) * greatest(mu * (1 - mu) / va - 1, 1e-3), 1e-3) AS b FROM p)"""


def _cohort_centroids(t):
    levels = t.site_counts.where(C.coverage() > 0).select("sample_id", *C.KEY, C.level().alias("x"))
    control = F.when(F.col("cohort") == "control", F.array(F.lit(1.0), F.lit(0.0))).otherwise(F.array(F.lit(0.0), F.lit(1.0)))
    weights = t.site_counts.select("sample_id", control.alias("weights")).distinct()
    return levels, clusters.beta_centroids(levels, weights, 2)


@register("cluster_log_likelihood", f"""WITH {_AB},
d AS (SELECT sample_id, c, (a - 1) * ln(y) + (b - 1) * ln(1 - y) - (lgamma(a) + lgamma(b) - lgamma(a + b)) AS v FROM (SELECT *, least(greatest(x, 1e-6), 1 - 1e-6) AS y FROM l) z JOIN ab USING (chrom, context, pos))
SELECT sample_id, avg(v) FILTER (c = 'control') AS control, avg(v) FILTER (c = 'disease') AS disease FROM d GROUP BY sample_id""", "control disease")
def _(t):
    levels, centroids = _cohort_centroids(t)
    return clusters.log_likelihoods(levels, centroids, 2).select("sample_id", F.col("log_likelihoods")[0].alias("control"), F.col("log_likelihoods")[1].alias("disease"))


@register("beta_overlap", f"""WITH {_AB}, w AS (SELECT x.chrom, x.context, x.pos, x.a / (x.a + x.b) AS m1, x.a * x.b / (pow(x.a + x.b, 2) * (x.a + x.b + 1)) AS v1, y.a / (y.a + y.b) AS m2, y.a * y.b / (pow(y.a + y.b, 2) * (y.a + y.b + 1)) AS v2
FROM ab x JOIN ab y USING (chrom, context, pos) WHERE x.c = 'control' AND y.c = 'disease')
SELECT chrom, context, pos, exp(-pow(m1 - m2, 2) / (2 * (v1 + v2))) * sqrt(2 * sqrt(v1 * v2) / (v1 + v2)) AS overlap FROM w""", "overlap")
def _(t):
    _, centroids = _cohort_centroids(t)
    at = lambda c, k: F.col(c)[k]
    both = centroids.where(at("a", 0).isNotNull() & at("a", 1).isNotNull())
    return both.select(*C.KEY, incomplete.beta_overlap(at("a", 0), at("b", 0), at("a", 1), at("b", 1)).alias("overlap"))


@register("cluster_fit", None, "log_likelihood")
def _(t):
    start = t.site_counts.select("sample_id").distinct().select("sample_id", F.pmod(F.crc32("sample_id"), F.lit(3)).cast("int").alias("cluster"))
    found = clusters.cluster_samples(t.site_counts, start, 3, min_size=2).samples
    return found.select("sample_id", "cluster", F.expr("log_likelihoods[cluster]").alias("log_likelihood"))


def stage_modules(t):
    """Brands shipped in a year as modules of a stage: genes and part types of their parts, scored by revenue."""
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).withColumn("stage_index", F.year("l_shipdate").cast("long"))
    gene = F.concat((1 + F.col("p_partkey") % 3).cast("string"), F.lit("-"), F.floor(F.col("p_partkey") / 30).cast("string"))
    return rows.groupBy("stage_index", F.col("p_brand").alias("module")).agg(
        F.sum((F.col("l_extendedprice") * 100).cast("long")).cast("double").alias("score"), F.max("p_type").alias("label"),
        F.collect_set(gene).alias("genes"), F.collect_set("p_type").alias("pathways"))


@register("module_families", None)
def _(t):
    return families.module_families(stage_modules(t))


def _sequences(t):
    """Letters of the parts' comments as bases, and the first eight of each as an aligned site of its brand."""
    return t.part.select(F.col("p_partkey").alias("id"), "p_brand", F.translate(F.lower("p_name"), "abcdefghijklmnopqrstuvwxyz ", "ACGTACGTACGTACGTACGTACGTACG").alias("seq"))


def _motif_scores(t):
    seqs = _sequences(t)
    return motifs.scan(seqs, motifs.weight_matrices(seqs, "p_brand", "seq", 8), "id", "seq")


@register("motif_scan", None, "score")
def _(t):
    return _motif_scores(t)


@register("motif_targets", None)
def _(t):
    factors = t.part.select(F.col("p_brand").alias("motif"), F.col("p_type").alias("factor")).distinct()
    return motifs.target_sets(_motif_scores(t), factors, 0.7, 2)


@register("panel_cross_validation", f"""WITH y AS (SELECT DISTINCT sample_id, CAST(sample_id AS BIGINT) % 2 AS label FROM features), n AS (SELECT least(5, min(c)) AS folds FROM (SELECT count(*) AS c FROM y GROUP BY label)),
f AS (SELECT sample_id, label, (row_number() OVER (PARTITION BY label ORDER BY md5(sample_id), sample_id) - 1) % folds AS fold FROM y, n),
v AS (SELECT f.*, feature_id, value FROM features JOIN f USING (sample_id) WHERE value IS NOT NULL),
k AS (SELECT DISTINCT fold FROM f),
m AS (SELECT k.fold, label AS guess, feature_id, avg(value) AS mean, greatest(avg(value * value) - avg(value) * avg(value), {classify.MIN_VARIANCE}) AS var FROM k JOIN v ON v.fold <> k.fold GROUP BY 1, 2, 3),
pr AS (SELECT k.fold, label AS guess, ln(count(*)) AS prior FROM k JOIN f ON f.fold <> k.fold GROUP BY 1, 2),
s AS (SELECT v.fold, sample_id, label, guess, sum(-0.5 * ln(2 * pi() * var) - pow(value - mean, 2) / (2 * var)) AS score FROM v JOIN m USING (fold, feature_id) GROUP BY ALL),
b AS (SELECT fold, sample_id, label, arg_max(guess, score + prior) AS guess FROM s JOIN pr USING (fold, guess) GROUP BY ALL),
r AS (SELECT fold, label, count(*) AS n, avg(CASE WHEN guess = label THEN 1.0e0 ELSE 0 END) AS recall FROM b GROUP BY 1, 2)
SELECT CAST(fold AS INTEGER) AS fold, CAST(sum(n) AS BIGINT) AS n, avg(recall) AS balanced_accuracy FROM r GROUP BY fold""", "balanced_accuracy")
def _(t):
    labels = t.features.select("sample_id", _group().alias("label")).distinct()
    return classify.cross_validate(t.features, labels)


_ROOT = "sqrt(greatest({}, 0))"


def _distance_sql(c: str) -> str:
    part = lambda x: f"CASE WHEN {x} > 0 THEN {x} * log2({x} / ((p + {c}) / 2)) ELSE 0 END"
    return (f"sqrt(greatest(1 - sum(sqrt(p * {c})), 0)) AS hellinger_{c}, sum(abs(fp - f{c})) / 20 AS wasserstein_{c}, sqrt(greatest(sum(({part('p')} + {part(c)}) / 2), 0)) AS js_{c}")


@register("chromosome_features", f"""WITH l AS (SELECT sample_id, cohort, chrom, context, pos, mC / CAST(mC + uC AS DOUBLE) AS x, least((mC * 20) // (mC + uC), 19) AS bin FROM site_counts WHERE mC + uC > 0),
w AS (SELECT chrom, context, pos, abs(avg(x) FILTER (cohort = 'control') - avg(x) FILTER (cohort = 'disease')) AS weight FROM l GROUP BY 1, 2, 3 HAVING count(DISTINCT cohort) = 2),
sw AS (SELECT coalesce(w.chrom, '*') AS chrom, sum(weight) AS site_weight FROM w GROUP BY ROLLUP (w.chrom)),
cs AS (SELECT cohort, chrom, context, pos, bin, count(*) / CAST(sum(count(*)) OVER (PARTITION BY cohort, chrom, context, pos) AS DOUBLE) AS p FROM l JOIN w USING (chrom, context, pos) GROUP BY cohort, chrom, context, pos, bin),
n AS (SELECT chrom, count(*) AS n FROM w GROUP BY chrom),
hc AS (SELECT chrom, bin, sum(p) FILTER (cohort = 'control') / any_value(n) AS c, sum(p) FILTER (cohort = 'disease') / any_value(n) AS d FROM cs JOIN n USING (chrom) GROUP BY 1, 2),
h AS (SELECT chrom, bin, coalesce(c, 0) AS control, coalesce(d, 0) AS disease FROM hc
      UNION ALL SELECT '*', bin, sum(coalesce(c, 0) * site_weight) / any_value(total), sum(coalesce(d, 0) * site_weight) / any_value(total)
      FROM hc JOIN sw USING (chrom), (SELECT site_weight AS total FROM sw WHERE chrom = '*') GROUP BY bin),
r AS (SELECT l.*, weight FROM l JOIN w USING (chrom, context, pos) WHERE weight > 0),
e AS (SELECT *, least(greatest(x, 1e-10), 1 - 1e-10) AS q FROM r),
m AS (SELECT sample_id, coalesce(e.chrom, '*') AS chrom, sum(weight) AS w, sum(weight * x) / sum(weight) AS mean_beta, -sum(weight * (q * log2(q) + (1 - q) * log2(1 - q))) / sum(weight) AS entropy,
      coalesce(sum(weight) FILTER (x <= 0.2e0), 0) / sum(weight) AS hypo_fraction, coalesce(sum(weight) FILTER (x BETWEEN 0.2e0 AND 0.8e0), 0) / sum(weight) AS intermediate_fraction FROM e GROUP BY sample_id, ROLLUP (e.chrom)),
sh AS (SELECT sample_id, coalesce(r.chrom, '*') AS chrom, bin, sum(weight) AS v FROM r GROUP BY GROUPING SETS ((sample_id, r.chrom, bin), (sample_id, bin))),
g AS (SELECT m.sample_id, m.chrom, b.bin, coalesce(v, 0) / m.w AS p, coalesce(control, 0) AS control, coalesce(disease, 0) AS disease FROM m CROSS JOIN (SELECT unnest(generate_series(0, 19)) AS bin) b
      LEFT JOIN sh ON sh.sample_id = m.sample_id AND sh.chrom = m.chrom AND sh.bin = b.bin LEFT JOIN h ON h.chrom = m.chrom AND h.bin = b.bin),
f AS (SELECT *, sum(p) OVER o AS fp, sum(control) OVER o AS fcontrol, sum(disease) OVER o AS fdisease FROM g WINDOW o AS (PARTITION BY sample_id, chrom ORDER BY bin ROWS UNBOUNDED PRECEDING)),
ds AS (SELECT sample_id, chrom, {_distance_sql('control')}, {_distance_sql('disease')} FROM f GROUP BY 1, 2)
SELECT sample_id, chrom, mean_beta, entropy, hypo_fraction, intermediate_fraction, w / site_weight AS observed_fraction, ds.* EXCLUDE (sample_id, chrom), js_control - js_disease AS js_margin
FROM m JOIN sw USING (chrom) JOIN ds USING (sample_id, chrom)""",
    "mean_beta entropy hypo_fraction intermediate_fraction observed_fraction hellinger_control wasserstein_control js_control hellinger_disease wasserstein_disease js_disease js_margin")
def _(t):
    return _chromosome_features(t)


def _chromosome_features(t):
    c = C.build(t.site_counts, BY)
    mean = lambda k: F.max(F.when(F.col("cohort") == k, C.mean()))
    panel = c.groupBy(*C.KEY).agg(F.abs(mean("control") - mean("disease")).alias("weight")).where("weight is not null")
    reference = derived.class_histograms(c, panel, "cohort", ["control", "disease"])
    return derived.chromosome_features(t.site_counts, panel, reference, ["control", "disease"])


@register("derived_schema_apply", None)
def _(t):
    """Schema fitted on the control samples, written, read again and applied to every sample."""
    long = materialize(derived.long_features(_chromosome_features(t)), "features")  # read by the fit several times
    control = t.site_counts.where("cohort = 'control'").select("sample_id").distinct()
    path = new_path(t.spark, "derived-schema")
    derived.FrozenSchema.fit(long.join(control, "sample_id", "left_semi")).write(path)
    out = derived.FrozenSchema.read(t.spark, path).apply(long)
    return out.select("sample_id", F.size("features").alias("n_features"), "n_filled", "n_clipped", "n_unknown", F.transform("features", lambda x: F.round(x, 6)).alias("features"))


@register("discriminant_projection", None, "projection")
def _(t):
    """Brand totals of every supplier along the direction that parts odd from even ones."""
    brands = [r.feature_id for r in t.features.select("feature_id").distinct().orderBy("feature_id").collect()]
    wide = t.features.groupBy("sample_id").pivot("feature_id", brands).agg(F.sum("value")).na.fill(0.0)
    rows = wide.select("sample_id", F.array(*[F.col(f"`{b}`").cast("double") for b in brands]).alias("x"))
    d = classify.discriminant_direction(rows, F.col("x"), _group(), ridge=1.0)
    return classify.project(rows, "x", d).select("sample_id", "projection")
