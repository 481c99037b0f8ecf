"""Queries of panels, sample features on them, and several-covariate adjustment."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import centroid as C
from ..operators import detect as D
from ..operators import panels as P
from ..shared import new_path
from ..sources import files, scans
from .adjust_queries import _M, _m
from .detect_queries import _MW, _GRID, _cohorts
from .registry import register

_RUN = "ru AS (SELECT *, 'c' || CAST(run_id % 3 AS VARCHAR) AS label FROM runs)"


def _runs(t):
    return t.runs.withColumn("label", F.concat(F.lit("c"), (F.col("run_id") % 3).cast("string")))


@register("panel_choice", "SELECT chrom, pos, effect_size, delta_mean FROM (SELECT *, row_number() OVER (PARTITION BY chrom, pos ORDER BY abs(effect_size) DESC, tie DESC, delta_mean DESC, run_id DESC) AS k FROM runs) WHERE k = 1", "effect_size delta_mean")
def _(t):
    return P.strongest(t.runs, ["chrom", "pos"], "effect_size", ["tie", "delta_mean", "run_id"]).select("chrom", "pos", "effect_size", "delta_mean")


@register("panel_choice_capped", "SELECT chrom, pos, effect_size FROM (SELECT chrom, pos, max(effect_size) AS effect_size FROM runs GROUP BY 1, 2) ORDER BY round(effect_size, 9) DESC, chrom, pos LIMIT 100", "effect_size")
def _(t):
    one = P.strongest(t.runs, ["chrom", "pos"], "effect_size", ["tie"])
    return one.orderBy(F.desc(F.round("effect_size", 9)), "chrom", "pos").limit(100).select("chrom", "pos", "effect_size")  # the cap is the feature


@register("panel_merge_comparisons", f"""WITH {_RUN}, o AS (SELECT chrom, pos, label, effect_size, delta_mean FROM (SELECT *, row_number() OVER (PARTITION BY chrom, pos, label ORDER BY abs(effect_size) DESC, tie DESC, delta_mean DESC) AS k FROM ru) WHERE k = 1)
SELECT chrom, pos, count(*) AS comparison_count, string_agg(label, '|' ORDER BY label) AS comparison_labels, sum(effect_size) AS effect_size_sum, max(effect_size) AS effect_size_max, avg(effect_size) AS effect_size_mean,
{', '.join(f"coalesce(max({c}) FILTER (label = 'c{k}'), 0) AS {c}__c{k}" for c in ('effect_size', 'delta_mean') for k in range(3))} FROM o GROUP BY 1, 2""",
    "effect_size_sum effect_size_max effect_size_mean " + " ".join(f"{c}__c{k}" for c in ("effect_size", "delta_mean") for k in range(3)))
def _(t):
    return P.merge_comparisons(_runs(t), ["c0", "c1", "c2"], ["chrom", "pos"])


@register("panel_expand_ranges", """WITH b AS (SELECT chrom, pos, max(effect_size) AS weight FROM runs GROUP BY 1, 2), r AS (SELECT s.chrom, s.pos, CASE WHEN feature_type = 'promoter' THEN 2.0e0 ELSE 0.5e0 END AS weight FROM sites s JOIN regions r ON s.chrom = r.chrom AND s.pos >= region_start AND s.pos < region_end WHERE feature_type IN ('promoter', 'exon'))
SELECT chrom, pos, max(weight) AS weight FROM (SELECT * FROM b UNION ALL SELECT * FROM r) GROUP BY 1, 2""", "weight")
def _(t):
    ranges = t.regions.where("feature_type in ('promoter', 'exon')").select("chrom", "region_start", "region_end", F.when(F.col("feature_type") == "promoter", 2.0).otherwise(0.5).alias("weight"))
    return P.expand_ranges(t.sites, ranges, t.runs.groupBy("chrom", "pos").agg(F.max("effect_size").alias("weight")))


_X = "CASE WHEN mC + uC > 0 THEN mC / CAST(mC + uC AS DOUBLE) ELSE 0 END"


@register("gene_values", f"""WITH j AS (SELECT sample_id, chrom || '-' || CAST(pos // 20 AS VARCHAR) AS gene, {_X} AS x, greatest(pos % 7 - 3, 0) * 0.1e0 AS w FROM site_counts)
SELECT sample_id, gene, count(*) AS n_loci, CASE WHEN sum(w) > 0 THEN sum(w * x) / sum(w) ELSE avg(x) END AS value FROM j GROUP BY 1, 2""", "value")
def _(t):
    loci = t.site_counts.select(*C.KEY).distinct().select(*C.KEY, F.concat_ws("-", "chrom", F.floor(F.col("pos") / 20).cast("string")).alias("gene"), ((F.col("pos") % 7 - 3) * 0.1).alias("w"))
    return P.gene_values(t.site_counts, loci)


_ANCHOR = f"a AS (SELECT * FROM (SELECT chrom, context, pos, avg({_X}) FILTER (cohort = 'control') AS m0, avg({_X}) FILTER (cohort = 'disease') AS m1 FROM site_counts GROUP BY 1, 2, 3) WHERE m0 IS NOT NULL AND m1 IS NOT NULL)"


@register("class_anchors", f"WITH {_ANCHOR} SELECT * FROM a", "m0 m1")
def _(t):
    return P.class_anchors(t.site_counts, "cohort", ["control", "disease"])


@register("panel_features", f"""WITH {_ANCHOR}, j AS (SELECT sample_id, {_X} AS x, m0, m1, 1 + (pos % 5) * 0.2e0 AS w FROM site_counts JOIN a USING (chrom, context, pos)),
m AS (SELECT sample_id, sum(w * x) / sum(w) AS mu FROM j GROUP BY 1), v AS (SELECT sample_id, any_value(mu) AS mu, sum(w * (x - mu) ** 2) / sum(w) AS v, sum(w * (x - mu) ** 3) / sum(w) AS t, sum(w * (x - mu) ** 4) / sum(w) AS f FROM j JOIN m USING (sample_id) GROUP BY 1),
g AS (SELECT sample_id, count(*) AS n_loci, quantile_cont(x, 0.25) AS q25, quantile_cont(x, 0.5) AS q50, quantile_cont(x, 0.75) AS q75, {', '.join(f'sum(w * x * m{k}) / sqrt(sum(w * x * x) * sum(w * m{k} * m{k})) AS cosine{k}, sum(w * abs(x - m{k})) / sum(w) AS mae{k}' for k in (0, 1))} FROM j GROUP BY 1)
SELECT g.*, mu AS mean, sqrt(v) AS sd, CASE WHEN v > 1e-12 THEN t / v ** 1.5 ELSE 0 END AS skew, CASE WHEN v > 1e-12 THEN f / v ** 2 ELSE 0 END AS kurtosis FROM g JOIN v USING (sample_id)""",
    "mean sd skew kurtosis q25 q50 q75 cosine0 mae0 cosine1 mae1")
def _(t):
    return P.panel_features(t.site_counts, P.class_anchors(t.site_counts, "cohort", ["control", "disease"]), 2, 1 + (F.col("pos") % 5) * 0.2)


@register("effect_trim", """WITH v AS (SELECT stage_index, round(score, 2) AS v FROM stages), r AS (SELECT *, row_number() OVER (PARTITION BY stage_index ORDER BY v DESC) AS rk, count(*) OVER (PARTITION BY stage_index) AS n, min(v) OVER (PARTITION BY stage_index) AS lo, max(v) OVER (PARTITION BY stage_index) AS hi FROM v),
d AS (SELECT *, round(((rk - 1) / CAST(n - 1 AS DOUBLE)) ** 2 + ((v - lo) / (hi - lo)) ** 2, 12) AS d FROM r WHERE n > 10 AND hi > lo), c AS (SELECT stage_index, arg_min(v, (d, rk)) AS c FROM d GROUP BY 1)
SELECT r.stage_index, coalesce(c, lo) AS cutoff, CAST(count(*) FILTER (v >= coalesce(c, lo)) AS BIGINT) AS n_kept FROM r LEFT JOIN c USING (stage_index) GROUP BY 1, 2""", "cutoff")
def _(t):
    return P.effect_trim(t.stages.withColumn("v", F.round("score", 2)), "v", ["stage_index"])


@register("effect_lambda", _MW + _GRID.replace("{src}", "t") + """, o AS (
  SELECT * EXCLUDE (g1, g2), least(greatest(list_sum([sqrt(CASE WHEN g1[j+1] - g1[j] > 1e-13 THEN g1[j+1] - g1[j] ELSE 0 END * CASE WHEN g2[j+1] - g2[j] > 1e-13 THEN g2[j+1] - g2[j] ELSE 0 END) for j in range(1, 256)]), 0), 1) AS overlap FROM g),
la AS (SELECT unnest([0.0e0, 0.5e0, 1.0e0, 2.0e0, 4.0e0]) AS lambda_var), ef AS (SELECT lambda_var, round(abs(mean1 - mean2) * (1 - overlap) * exp(-lambda_var * (sqrt(var1) + sqrt(var2))), 9) AS e, round(abs(z_stat), 9) AS z FROM o, la),
rk AS (SELECT lambda_var, rank() OVER (PARTITION BY lambda_var ORDER BY e) + (count(*) OVER (PARTITION BY lambda_var, e) - 1) / 2.0e0 AS re, rank() OVER (PARTITION BY lambda_var ORDER BY z) + (count(*) OVER (PARTITION BY lambda_var, z) - 1) / 2.0e0 AS rt FROM ef),
co AS (SELECT lambda_var, corr(re, rt) AS correlation FROM rk GROUP BY 1) SELECT lambda_var, correlation, lambda_var = (SELECT arg_max(lambda_var, (round(correlation, 9), -lambda_var)) FROM co) AS chosen FROM co""", "lambda_var correlation")
def _(t):
    rows = D.with_overlap(D.with_mann_whitney(D.gate(D.align(*_cohorts(t))))).withColumn("z", F.round(F.abs("z_stat"), 9))
    return P.choose_lambda(rows, [0.0, 0.5, 1.0, 2.0, 4.0], "z")


_OLS = "k AS (SELECT chrom, context, pos, m, age, balance / 1000 AS balance FROM mv JOIN covariates USING (sample_id)), f AS (SELECT chrom, context, pos, count(*) AS n, avg(m) AS my, avg(age) AS ma, avg(balance) AS mb, covar_pop(age, m) AS cay, covar_pop(balance, m) AS cby, covar_pop(age, balance) AS cab, var_pop(age) AS va, var_pop(balance) AS vb FROM k GROUP BY 1, 2, 3), d AS (SELECT *, CASE WHEN va > 1e-12 AND vb > 1e-12 AND va * vb - cab * cab > 1e-8 * va * vb THEN va * vb - cab * cab END AS det FROM f), b AS (SELECT *, (cay * vb - cby * cab) / det AS slope_age, (cby * va - cay * cab) / det AS slope_balance FROM d)"


def _two(t):
    c = t.covariates.withColumn("balance", F.col("balance") / 1000)
    m = _m(t)
    return m, c, P.fit_covariates(m, c, ["age", "balance"])


@register("adjust_fit_two", f"WITH {_M}, {_OLS} SELECT chrom, context, pos, n, round(my - slope_age * ma - slope_balance * mb, 4) AS intercept, round(slope_age, 4) AS slope_age, round(slope_balance, 4) AS slope_balance FROM b", "intercept slope_age slope_balance")
def _(t):
    _, _, f = _two(t)
    return f.select(*C.KEY, "n", *[F.round(c, 4).alias(c) for c in ("intercept", "slope_age", "slope_balance")])


@register("adjust_residuals_two", f"""WITH {_M}, {_OLS}, s AS (SELECT chrom, context, pos, my - slope_age * ma - slope_balance * mb AS i, slope_age, slope_balance FROM b)
SELECT v.* EXCLUDE (m), round(m, 4) AS m, round(coalesce(m - i - slope_age * age - slope_balance * c.balance / 1000, m), 4) AS residual FROM mv v LEFT JOIN s USING (chrom, context, pos) LEFT JOIN covariates c USING (sample_id)""", "m residual")
def _(t):
    m, c, f = _two(t)
    return P.residualize_on(m, c, f, ["age", "balance"]).withColumns({x: F.round(x, 4) for x in ("m", "residual")})


@register("stage_gene_coverage", """WITH k AS (SELECT stage_index, entity AS gene, row_number() OVER (PARTITION BY stage_index ORDER BY score DESC, entity) AS rk FROM stages), s AS (SELECT DISTINCT * FROM gene_sets), n AS (SELECT library, term, count(*) AS term_size FROM s GROUP BY 1, 2)
SELECT stage_index, library, term, term_size, count(*) AS n_all, count(*) FILTER (rk <= 50) AS n_top, count(*) / CAST(term_size AS DOUBLE) AS share_all, count(*) FILTER (rk <= 50) / CAST(term_size AS DOUBLE) AS share_top FROM s JOIN k USING (gene) JOIN n USING (library, term) GROUP BY 1, 2, 3, 4""", "share_all share_top")
def _(t):
    return P.stage_coverage(t.stages, t.gene_sets, 50)


@register("edge_export", "SELECT src, dst, weight FROM edges WHERE weight >= 3")
def _(t):
    return t.edges.where("weight >= 3").orderBy(F.desc("weight"), "src", "dst")


@register("features_detected", "SELECT sample_id, count(*) AS n_features, count(*) FILTER (value >= 50) AS n_detected, count(*) FILTER (value >= 50) / CAST(count(*) AS DOUBLE) AS detected_share FROM features GROUP BY 1", "detected_share")
def _(t):
    g = t.features.groupBy("sample_id").agg(F.count("*").alias("n_features"), F.count_if(F.col("value") >= 50).alias("n_detected"))
    return g.withColumn("detected_share", F.col("n_detected") / F.col("n_features"))


@register("gene_pool", "SELECT gene, score, source_count FROM (SELECT gene, max(s) AS score, count(*) AS source_count FROM (SELECT entity AS gene, max(score) AS s FROM stages GROUP BY 1 UNION ALL SELECT gene, count(*) * 1000.0e0 FROM gene_sets GROUP BY 1) GROUP BY 1) ORDER BY score DESC, gene LIMIT 100", "score")
def _(t):
    both = t.stages.groupBy(F.col("entity").alias("gene")).agg(F.max("score").alias("s")).unionByName(t.gene_sets.groupBy("gene").agg((F.count("*") * 1000.0).alias("s")))
    pool = both.groupBy("gene").agg(F.max("s").alias("score"), F.count("*").alias("source_count"))
    return pool.orderBy(F.desc("score"), "gene").limit(100)  # the cap is the feature


@register("file_protein_report", "SELECT l_suppkey AS sample_id, 'P' || CAST(l_partkey % 50 AS VARCHAR) AS protein, max(l_extendedprice) AS intensity FROM lineitem GROUP BY 1, 2", "intensity")
def _(t):
    path = new_path(t.spark, "proteins")
    rows = t.lineitem.select(F.col("l_suppkey").alias("Run"), F.concat(F.lit("P"), (F.col("l_partkey") % 50).cast("string")).alias("Protein.Group"), F.col("l_extendedprice").alias("PG.MaxLFQ"))
    rows.write.csv(path, header=True, sep="\t")
    return files.read_protein_report(t.spark, path).select(F.col("run").cast("long").alias("sample_id"), "protein", "intensity")


@register("context_split", "SELECT chrom, context, count(*) AS n, CAST(sum(mC) AS BIGINT) AS mC FROM site_counts GROUP BY 1, 2")
def _(t):
    path = new_path(t.spark, "contexts")
    scans.write_by_context(t.site_counts, path)
    back = t.spark.read.schema(t.site_counts.schema).parquet(path)
    return back.groupBy("chrom", "context").agg(F.count("*").alias("n"), F.sum("mC").alias("mC"))


@register("file_flagstat", "SELECT CAST(l_suppkey AS VARCHAR) AS sample_id, count(*) AS total, count(*) FILTER (l_quantity > 5) AS mapped, count(*) FILTER (l_quantity > 5) / CAST(count(*) AS DOUBLE) AS mapped_rate FROM lineitem GROUP BY 1", "mapped_rate")
def _(t):
    path = new_path(t.spark, "flagstat")
    g = t.lineitem.groupBy(F.col("l_suppkey").cast("string").alias("sample_id")).agg(F.count("*").alias("n"), F.count_if(F.col("l_quantity") > 5).alias("m"))
    g.select("sample_id", F.format_string("%d + 0 in total (QC-passed reads + QC-failed reads)\n%d + 0 mapped (%s : N/A)", "n", "m", F.lit("-")).alias("text")).write.partitionBy("sample_id").option("lineSep", "\n").text(path)
    return files.read_flagstat(t.spark, path)


@register("model_export", "WITH s AS (SELECT DISTINCT sample_id FROM features) SELECT (SELECT count(*) FROM features WHERE CAST(sample_id AS BIGINT) % 10 < 7) AS n_train, (SELECT count(*) FROM features WHERE CAST(sample_id AS BIGINT) % 10 >= 6) AS n_test, (SELECT count(*) FROM s WHERE CAST(sample_id AS BIGINT) % 10 = 6) AS n_overlap")
def _(t):
    k = F.col("sample_id").cast("long") % 10
    return P.write_split(t.features.where(k < 7), t.features.where(k >= 6), new_path(t.spark, "design"))
