"""Queries of recurrence, splits, panels and stages."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import special
from ..operators import centroid as C
from ..operators import stability as S
from .registry import register

_PER = """p AS (SELECT run_id, chrom, pos, avg(effect_size) AS effect_size, quantile_cont(p_value, 0.5) AS p_value, CASE WHEN avg(delta_mean) < 0 THEN -1 ELSE 1 END AS sign FROM runs GROUP BY 1, 2, 3)"""


@register("stability_recurrence", f"""WITH {_PER}, z AS (SELECT *, least(-{special.norm_ppf('(greatest(least(p_value, 1 - 1e-15), 1e-300) / 2)')}, 8) * sign AS z FROM p),
g AS (SELECT chrom, pos, count(*) AS n_present, avg(effect_size) AS effect_size, sum(z) / sqrt(count(*)) AS z FROM z GROUP BY 1, 2), n AS (SELECT count(DISTINCT run_id) AS n_runs FROM p),
c AS (SELECT *, least(1, 2 * {special.norm_sf('abs(z)')}) AS p_combined FROM g, n), r AS (SELECT *, row_number() OVER (ORDER BY p_combined) AS rk, count(*) OVER () AS m FROM c)
SELECT chrom, pos, n_present, n_runs, effect_size, n_present / CAST(n_runs AS DOUBLE) AS frequency, z, p_combined, least(min(p_combined * m / rk) OVER (ORDER BY p_combined DESC, rk DESC ROWS UNBOUNDED PRECEDING), 1) AS q_value FROM r""",
    "effect_size frequency z p_combined q_value")
def _(t):
    return S.recurrence(t.runs, ["chrom", "pos"])


_SAMPLES = "s AS (SELECT DISTINCT sample_id, cohort FROM site_counts), k AS (SELECT unnest(generate_series(1, 5)) AS run_id)"
_SPLIT = f"""WITH {_SAMPLES}, r AS (SELECT *, row_number() OVER (PARTITION BY run_id, cohort ORDER BY (CAST(sample_id AS BIGINT) * 48271 + run_id * 69621) % 2147483647, sample_id) AS i, count(*) OVER (PARTITION BY run_id, cohort) AS n FROM s, k),
u AS (SELECT *, greatest(CAST(floor(n * 0.7) AS BIGINT), 1) AS take FROM r)"""


def splits(t):
    return S.split(t.site_counts.select("sample_id", "cohort").distinct(), t.spark.range(1, 6).withColumnRenamed("id", "run_id"), 0.7)


@register("split_stratified", _SPLIT + " SELECT run_id, sample_id, cohort, CASE WHEN i <= CASE WHEN take >= n AND n > 1 THEN n - 1 ELSE take END THEN 'train' ELSE 'test' END AS part FROM u")
def _(t):
    return splits(t)


@register("split_holdout_exclude", _SPLIT + " SELECT DISTINCT sample_id FROM s WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.sample_id = s.sample_id AND run_id = 1 AND i > CASE WHEN take >= n AND n > 1 THEN n - 1 ELSE take END)")
def _(t):
    held = splits(t).where("run_id = 1 and part = 'test'")
    return t.site_counts.select("sample_id").distinct().join(held, "sample_id", "left_anti")


def _panel(t, run):
    return t.runs.where(F.col("run_id") == run).groupBy("chrom", "pos").agg(F.avg("delta_mean").alias("v"))


_AB = "a AS (SELECT chrom, pos, avg(delta_mean) AS v FROM runs WHERE run_id = 1 GROUP BY 1, 2), b AS (SELECT chrom, pos, avg(delta_mean) AS v FROM runs WHERE run_id = 2 GROUP BY 1, 2)"


@register("panel_jaccard", f"""WITH {_AB}, c AS (SELECT a.chrom IS NOT NULL AS ia, b.chrom IS NOT NULL AS ib FROM a FULL JOIN b ON a.chrom = b.chrom AND a.pos = b.pos)
SELECT count(*) FILTER (ia) AS n_a, count(*) FILTER (ib) AS n_b, count(*) FILTER (ia AND ib) AS n_shared, count(*) FILTER (NOT ib) AS only_a, count(*) FILTER (NOT ia) AS only_b, count(*) FILTER (ia AND ib) / CAST(count(*) AS DOUBLE) AS jaccard FROM c""", "jaccard")
def _(t):
    return S.jaccard(_panel(t, 1), _panel(t, 2), ["chrom", "pos"])


@register("panel_rank_agreement", f"""WITH {_AB}, c AS (SELECT round(a.v, 9) AS x, round(b.v, 9) AS y FROM a JOIN b USING (chrom, pos)),
r AS (SELECT x, y, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0e0 AS rx, rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0e0 AS ry FROM c)
SELECT count(*) AS n_shared, corr(rx, ry) AS spearman, avg(CASE WHEN sign(x) = sign(y) THEN 1.0e0 ELSE 0 END) AS same_sign FROM r""", "spearman same_sign")
def _(t):
    r = lambda k: _panel(t, k).withColumn("v", F.round("v", 9))
    return S.rank_agreement(r(1), r(2), ["chrom", "pos"], "v")


@register("panel_union", "SELECT DISTINCT chrom, pos FROM runs")
def _(t):
    return t.runs.select("chrom", "pos").distinct()


@register("panel_in_all_samples", """WITH n AS (SELECT cohort, count(DISTINCT sample_id) AS n_all FROM site_counts GROUP BY 1), c AS (SELECT cohort, chrom, context, pos, count(DISTINCT sample_id) AS n FROM site_counts GROUP BY 1, 2, 3, 4)
SELECT chrom, context, pos FROM c JOIN n USING (cohort) WHERE n >= 0.25 * n_all GROUP BY 1, 2, 3 HAVING count(*) = (SELECT count(*) FROM n)""")
def _(t):
    """Sites that a quarter of every cohort's samples cover."""
    kept = S.in_all(t.site_counts, "sample_id", C.KEY, 0.25, ["cohort"])
    return S.in_all(kept, "cohort", C.KEY)


@register("panel_in_all_runs", "SELECT chrom, pos FROM runs GROUP BY 1, 2 HAVING count(DISTINCT run_id) = (SELECT count(DISTINCT run_id) FROM runs)")
def _(t):
    return S.in_all(t.runs, "run_id", ["chrom", "pos"])


@register("panel_convergence", """WITH f AS (SELECT DISTINCT run_id, chrom, pos FROM runs), o AS (SELECT run_id, row_number() OVER (ORDER BY run_id) AS k FROM (SELECT DISTINCT run_id FROM runs)), ks AS (SELECT k FROM o),
s AS (SELECT ks.k, chrom, pos, count(*) AS n FROM f JOIN o USING (run_id) JOIN ks ON o.k <= ks.k GROUP BY 1, 2, 3), p AS (SELECT k, chrom, pos FROM s WHERE n >= 0.6 * k),
c AS (SELECT k, count(*) AS size FROM p GROUP BY k), h AS (SELECT p.k, count(*) AS shared FROM p JOIN p q ON q.k = p.k - 2 AND q.chrom = p.chrom AND q.pos = p.pos GROUP BY 1)
SELECT c.k, c.size, c.size - d.size AS delta, coalesce(shared, 0) / CAST(c.size + d.size - coalesce(shared, 0) AS DOUBLE) AS jaccard FROM c JOIN c d ON d.k = c.k - 2 LEFT JOIN h ON h.k = c.k""", "jaccard")
def _(t):
    return S.convergence(t.runs, ["chrom", "pos"], 0.6, 2).withColumn("k", F.col("k").cast("long"))


_SUMMARY = """count({v}) AS n, avg({v}) AS mean, stddev_samp({v}) AS sd, min({v}) AS min, max({v}) AS max, quantile_cont({v}, 0.05) AS p5, quantile_cont({v}, 0.5) AS p50, quantile_cont({v}, 0.95) AS p95,
avg({v}) - 1.96 * stddev_samp({v}) / sqrt(count({v})) AS ci_low, avg({v}) + 1.96 * stddev_samp({v}) / sqrt(count({v})) AS ci_high"""


@register("metric_summary", f"SELECT metric, {_SUMMARY.format(v='value')} FROM qc_metrics GROUP BY metric", "mean sd min max p5 p50 p95 ci_low ci_high")
def _(t):
    return S.summary(t.qc_metrics, ["metric"])


@register("metric_constant", """SELECT run_id, count(DISTINCT l) AS n_distinct, CASE WHEN count(DISTINCT l) = 1 THEN min(l) ELSE -1 END AS constant, max(l) - min(l) AS spread FROM (SELECT run_id, chrom AS c, count(*) AS l FROM runs GROUP BY 1, 2) GROUP BY run_id""")
def _(t):
    return S.constant_or_summary(t.runs.groupBy("run_id", "chrom").agg(F.count("*").alias("value")), ["run_id"]).na.fill(-1, ["constant"])


@register("panel_frequency_by_chrom", "SELECT run_id, chrom, count(*) AS n, count(*) / CAST(sum(count(*)) OVER (PARTITION BY run_id) AS DOUBLE) AS share FROM (SELECT DISTINCT run_id, chrom, pos FROM runs) GROUP BY 1, 2", "share")
def _(t):
    g = t.runs.select("run_id", "chrom", "pos").distinct().groupBy("run_id", "chrom").agg(F.count("*").alias("n"))
    return g.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("run_id")))


@register("stage_categories", """WITH g AS (SELECT entity, count(DISTINCT stage_index) AS n, min(stage_index) AS f FROM stages WHERE score > 200000 GROUP BY entity), t AS (SELECT count(DISTINCT stage_index) AS a FROM stages WHERE score > 200000)
SELECT entity, CASE WHEN n = a THEN 'core' WHEN n = 1 THEN 'stage_specific_' || f ELSE 'partial' END AS category FROM g, t""")
def _(t):
    return S.locus_categories(t.stages.where("score > 200000"), ["entity"])


@register("recurrence_violations", """SELECT CAST(count(*) FILTER (n > n_runs) AS BIGINT) AS too_many, count(*) FILTER (n < 1) AS too_few, count(*) AS n_rows FROM (SELECT chrom, pos, count(DISTINCT run_id) AS n FROM runs GROUP BY 1, 2), (SELECT count(DISTINCT run_id) AS n_runs FROM runs)""")
def _(t):
    n = t.runs.agg(F.countDistinct("run_id").alias("n_runs"))
    g = t.runs.groupBy("chrom", "pos").agg(F.countDistinct("run_id").alias("n")).crossJoin(F.broadcast(n))
    return g.agg(F.count_if(F.col("n") > F.col("n_runs")).alias("too_many"), F.count_if(F.col("n") < 1).alias("too_few"), F.count("*").alias("n_rows"))


@register("comparison_pairs", "WITH g AS (SELECT DISTINCT c_mktsegment AS label FROM customer) SELECT a.label AS control, b.label AS disease FROM g a, g b WHERE a.label < b.label")
def _(t):
    g = t.customer.select(F.col("c_mktsegment").alias("label")).distinct()
    a, b = g.select(F.col("label").alias("control")), g.select(F.col("label").alias("disease"))
    return a.join(b, F.col("control") < F.col("disease"))  # cohort labels, a handful


@register("sample_eligibility", """WITH e AS (SELECT DISTINCT chrom, context FROM site_counts), c AS (SELECT sample_id, count(DISTINCT (chrom, context)) AS n FROM site_counts GROUP BY 1)
SELECT sample_id, n AS n_found, (SELECT count(*) FROM e) AS n_expected, n = (SELECT count(*) FROM e) AS eligible FROM c""")
def _(t):
    e = t.site_counts.select("chrom", "context").distinct().agg(F.count("*").alias("n_expected"))
    c = t.site_counts.select("sample_id", "chrom", "context").distinct().groupBy("sample_id").agg(F.count("*").alias("n_found"))
    return c.crossJoin(F.broadcast(e)).withColumn("eligible", F.col("n_found") == F.col("n_expected"))
