"""Queries of covariate adjustment and feature matrices."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import adjust as A
from ..operators import centroid as C
from ..sources.scans import beta_to_m
from .registry import register

_M = "mv AS (SELECT sample_id, chrom, context, pos, log2(b / (1 - b)) AS m FROM (SELECT *, greatest(least(CASE WHEN mC + uC > 0 THEN mC / CAST(mC + uC AS DOUBLE) ELSE 0 END, 0.999e0), 0.001e0) AS b FROM site_counts))"
_FIT = "f AS (SELECT chrom, context, pos, count(*) AS n, regr_slope(m, balance) AS slope, regr_intercept(m, balance) AS intercept FROM mv JOIN covariates USING (sample_id) GROUP BY 1, 2, 3)"


def _m(t):
    return t.site_counts.select("sample_id", *C.KEY, beta_to_m(C.level(), 1e-3).alias("m"))


@register("adjust_fit", f"WITH {_M}, {_FIT} SELECT chrom, context, pos, n, slope * 1000 AS slope, intercept FROM f WHERE n >= 5", "slope intercept")
def _(t):
    return A.fit_covariate(_m(t), t.covariates, "balance").where("n >= 5").withColumn("slope", F.col("slope") * 1000)


@register("adjust_residuals", f"WITH {_M}, {_FIT} SELECT sample_id, chrom, context, pos, m, CASE WHEN slope IS NOT NULL AND n >= 5 THEN m - intercept - slope * balance ELSE m END AS residual FROM mv LEFT JOIN covariates USING (sample_id) LEFT JOIN f USING (chrom, context, pos)", "m residual")
def _(t):
    m = _m(t)
    return A.residualize(m, t.covariates, A.fit_covariate(m, t.covariates, "balance").where("n >= 5"), "balance")


@register("features_cpm", "WITH s AS (SELECT sample_id, sum(value) AS t FROM features GROUP BY 1) SELECT sample_id, feature_id, value, value / t * 1e6 AS cpm, log2(value / t * 1e6 + 1) AS logcpm FROM features JOIN s USING (sample_id)", "value cpm logcpm")
def _(t):
    return A.cpm(t.features)


@register("features_median_normalize", "WITH m AS (SELECT sample_id, quantile_cont(value, 0.5) AS m FROM features GROUP BY 1), g AS (SELECT quantile_cont(m, 0.5) AS g FROM m) SELECT sample_id, feature_id, CASE WHEN m > 0 THEN value * g / m ELSE value END AS normalized FROM features JOIN m USING (sample_id), g", "normalized")
def _(t):
    return A.median_normalize(t.features)


@register("features_quantile_normalize", "WITH r AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY value, feature_id) AS rk FROM features), m AS (SELECT rk, avg(value) AS normalized FROM r GROUP BY 1) SELECT sample_id, feature_id, normalized FROM r JOIN m USING (rk)", "normalized")
def _(t):
    return A.quantile_normalize(t.features)


@register("features_complete", "WITH g AS (SELECT * FROM (SELECT DISTINCT sample_id FROM features), (SELECT feature_id, min(value) AS lo FROM features GROUP BY 1)) SELECT g.sample_id, g.feature_id, coalesce(f.value, lo) AS value, f.value IS NULL AS filled FROM g LEFT JOIN features f ON f.sample_id = g.sample_id AND f.feature_id = g.feature_id", "value")
def _(t):
    return A.complete(t.features, "min")


@register("features_differential", """WITH g AS (SELECT feature_id, count(value) FILTER (CAST(sample_id AS BIGINT) % 2 = 0) AS n0, count(value) FILTER (CAST(sample_id AS BIGINT) % 2 = 1) AS n1, avg(value) FILTER (CAST(sample_id AS BIGINT) % 2 = 0) AS mean0, avg(value) FILTER (CAST(sample_id AS BIGINT) % 2 = 1) AS mean1,
var_samp(value) FILTER (CAST(sample_id AS BIGINT) % 2 = 0) AS v0, var_samp(value) FILTER (CAST(sample_id AS BIGINT) % 2 = 1) AS v1 FROM features GROUP BY 1)
SELECT feature_id, n0, n1, mean0, mean1, log2((mean1 + 1) / (mean0 + 1)) AS log2_fc, (mean1 - mean0) / sqrt(v0 / n0 + v1 / n1) AS welch_t FROM g""", "mean0 mean1 log2_fc welch_t")
def _(t):
    return A.differential(t.features, F.col("sample_id").cast("long") % 2)


@register("features_min_max", "SELECT sample_id, feature_id, CASE WHEN hi > lo THEN (value - lo) / (hi - lo) ELSE 0 END AS scaled FROM features JOIN (SELECT feature_id, min(value) AS lo, max(value) AS hi FROM features GROUP BY 1) USING (feature_id)", "scaled")
def _(t):
    return A.min_max(t.features)


@register("composition_log_ratios", """WITH c AS (SELECT sample_id, part, (share + 1e-6) / sum(share + 1e-6) OVER (PARTITION BY sample_id) AS s FROM composition)
SELECT sample_id, part, ln(s) - max(CASE WHEN part = 'BUILDING' THEN ln(s) END) OVER (PARTITION BY sample_id) AS alr, ln(s) - avg(ln(s)) OVER (PARTITION BY sample_id) AS clr FROM c""", "alr clr")
def _(t):
    return A.log_ratios(t.composition, "BUILDING")


@register("covariates_standardize", "SELECT sample_id, (age - avg(age) OVER ()) / stddev_pop(age) OVER () AS age, (balance - avg(balance) OVER ()) / stddev_pop(balance) OVER () AS balance FROM covariates", "age balance")
def _(t):
    return A.standardize(t.covariates, ["age", "balance"])


@register("panel_score", """WITH p AS (SELECT DISTINCT chrom, context, pos, 0.01e0 * (pos % 7) AS w FROM site_counts), n AS (SELECT count(*) AS n FROM p),
g AS (SELECT sample_id, count(*) AS k, sum(w * CASE WHEN mC + uC > 0 THEN mC / CAST(mC + uC AS DOUBLE) ELSE 0 END) AS s FROM site_counts JOIN p USING (chrom, context, pos) GROUP BY 1)
SELECT sample_id, k AS n_observed, s + 0.25 AS score, k / CAST(n AS DOUBLE) AS observed_share, CASE WHEN k / CAST(n AS DOUBLE) >= 0.5 THEN 'ok' ELSE 'low_coverage' END AS status FROM g, n""", "score observed_share")
def _(t):
    p = t.site_counts.select(*C.KEY, (0.01 * (F.col("pos") % 7)).alias("w")).distinct()
    return A.panel_score(t.site_counts, p, 0.25)


@register("sample_size", "SELECT metric, CAST(ceil(2 * ((1.959963984540054e0 + 0.8416212335729143e0) / least(greatest(abs(m * 0.05) / s, 0.02), 10)) ** 2) AS BIGINT) AS n_per_group FROM (SELECT metric, avg(value) AS m, stddev_samp(value) AS s FROM qc_metrics GROUP BY 1)")
def _(t):
    g = t.qc_metrics.groupBy("metric").agg((F.avg("value") * 0.05).alias("delta"), F.stddev_samp("value").alias("sd"))
    return g.select("metric", A.sample_size("delta", "sd").alias("n_per_group"))
