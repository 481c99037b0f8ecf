"""Queries of two-cohort detection; the flagship is ``dmp_detect``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import histograms as H
from ..functions import special
from ..operators import centroid as C
from ..operators import detect as D
from ..operators import fdr
from .centroid_queries import BY, CENTROID
from .registry import register

_C = CENTROID.replace("array_to_string([", "[").replace("], ',') AS bins", "] AS h")
_PAIRS = f"""WITH c AS ({_C}), pr AS (
  SELECT x.chrom, x.context, x.pos, x.N AS n1, y.N AS n2, x.Sx / x.N AS mean1, y.Sx / y.N AS mean2, x.h AS h1, y.h AS h2,
         greatest((x.Sx2 - x.Sx * x.Sx / x.N) / greatest(x.N - 1, 1), 1e-12) AS var1, greatest((y.Sx2 - y.Sx * y.Sx / y.N) / greatest(y.N - 1, 1), 1e-12) AS var2
  FROM c x JOIN c y USING (chrom, context, pos) WHERE x.cohort = 'control' AND y.cohort = 'disease' AND x.N >= 2 AND y.N >= 2 AND x.Sm + x.Su >= 1 AND y.Sm + y.Su >= 1)"""
_MW = _PAIRS + f""", u AS (
  SELECT *, list_sum([CAST(h1[k] AS DOUBLE) * (coalesce(list_sum(h2[1:k-1]), 0) + 0.5 * h2[k]) for k in range(1, 21)]) AS u_stat,
         list_sum([CAST(h1[k] + h2[k] AS DOUBLE) * (CAST(h1[k] + h2[k] AS DOUBLE) ** 2 - 1) for k in range(1, 21)]) AS ties, CAST(n1 + n2 AS DOUBLE) AS n FROM pr),
v AS (SELECT *, n1 * n2 / 12.0e0 * greatest(n + 1 - ties / greatest(n * greatest(n - 1, 0), 1), 0) AS var_u FROM u),
z AS (SELECT *, CASE WHEN var_u > 0 THEN (u_stat - n1 * n2 / 2.0e0) / sqrt(var_u) ELSE 0 END AS z_stat FROM v),
t AS (SELECT *, CASE WHEN var_u > 0 THEN greatest(least(2 * {special.norm_sf('abs(z_stat)')}, 1e0), 1e-300) ELSE 1e0 END AS p_value FROM z)"""
_GRID = """, e AS (SELECT *, [coalesce(list_sum(h1[1:k]), 0) / greatest(list_sum(h1), 1e-20) for k in range(0, 21)] AS e1, [coalesce(list_sum(h2[1:k]), 0) / greatest(list_sum(h2), 1e-20) for k in range(0, 21)] AS e2 FROM {src}),
g AS (SELECT * EXCLUDE (e1, e2), [(1 - (j * 20 / 255.0e0 - least(j * 20 // 255, 19))) * e1[least(j * 20 // 255, 19) + 1] + (j * 20 / 255.0e0 - least(j * 20 // 255, 19)) * e1[least(j * 20 // 255, 19) + 2] for j in range(0, 256)] AS g1,
             [(1 - (j * 20 / 255.0e0 - least(j * 20 // 255, 19))) * e2[least(j * 20 // 255, 19) + 1] + (j * 20 / 255.0e0 - least(j * 20 // 255, 19)) * e2[least(j * 20 // 255, 19) + 2] for j in range(0, 256)] AS g2 FROM e)"""
_OVER = _MW + _GRID.replace("{src}", "t") + """, o AS (
  SELECT * EXCLUDE (g1, g2), least(greatest(list_sum([sqrt(CASE WHEN g1[j+1] - g1[j] > 1e-13 THEN g1[j+1] - g1[j] ELSE 0 END * CASE WHEN g2[j+1] - g2[j] > 1e-13 THEN g2[j+1] - g2[j] ELSE 0 END) for j in range(1, 256)]), 0), 1) AS overlap FROM g),
r AS (SELECT chrom, context, pos, n1, n2, mean1, mean2, abs(mean1 - mean2) AS delta_mean, CAST(sign(mean2 - mean1) AS DOUBLE) AS delta_sign, z_stat, p_value, overlap,
        least(greatest(abs(mean1 - mean2) * (1 - overlap) * exp(-2.0e0 * (sqrt(var1) + sqrt(var2))), 0), 1) AS effect_size FROM o)"""


def _storey(src: str, by: str, p: str, lambdas: list[float], centre: str, clip: bool) -> str:
    """Textbook form by window functions: rank, ratio, running minimum from the largest p."""
    lam = ", ".join(f"count(*) FILTER ({p} > {special.number(v)}) / (1 - {special.number(v)})" for v in lambdas)
    part = f"PARTITION BY {by}" if by else ""
    mid = f"list_{'avg' if centre == 'mean' else 'median'}([{lam}])"
    pi = f"(SELECT {by + ', ' if by else ''}count(*) AS m, least({mid} / count(*), 1) AS pi0 FROM {src} GROUP BY {by or 'ALL'})"
    using = f"JOIN {pi} USING ({by})" if by else f", {pi}"
    q = f"min(pi0 * m * {p} / rk) OVER ({part} ORDER BY {p} DESC, rk DESC ROWS UNBOUNDED PRECEDING)"
    return f"SELECT *, {f'least({q}, 1)' if clip else q} AS q_value FROM (SELECT *, row_number() OVER ({part} ORDER BY {p}) AS rk FROM {src} {using})"


def _cohorts(t):
    c = C.build(t.site_counts, BY)
    return c.where("cohort = 'control'"), c.where("cohort = 'disease'")


DMP_SQL = _OVER + f", q AS ({_storey('r', 'chrom, context', 'p_value', fdr.PAIR_LAMBDAS, 'mean', True)}) SELECT * EXCLUDE (m, pi0, rk) FROM q"
DMP_ROUNDS = "mean1 mean2 delta_mean delta_sign z_stat p_value overlap effect_size q_value"


def dmp(t):
    return D.compare(*_cohorts(t))


@register("dmp_detect", DMP_SQL, DMP_ROUNDS)
def _(t):
    return dmp(t)


@register("test_mann_whitney", _MW + " SELECT chrom, context, pos, u_stat, z_stat, p_value FROM t", "u_stat z_stat p_value")
def _(t):
    return D.with_mann_whitney(D.gate(D.align(*_cohorts(t)))).select(*C.KEY, "u_stat", "z_stat", "p_value")


@register("test_ks", _PAIRS + _GRID.replace("{src}", "pr") + f""", k AS (SELECT *, list_max([abs(g1[j] - g2[j]) for j in range(1, 257)]) AS ks_stat FROM g),
x AS (SELECT *, sqrt(2 / (1.0e0 / n1 + 1.0e0 / n2)) * ks_stat AS x FROM k) SELECT chrom, context, pos, ks_stat, {special.kolmogorov_sf('x')} AS ks_p FROM x""", "ks_stat ks_p")
def _(t):
    return D.with_ks(D.gate(D.align(*_cohorts(t)))).select(*C.KEY, "ks_stat", "ks_p")


@register("histogram_distances", _PAIRS + """, s AS (SELECT *, list_sum(h1) AS t1, list_sum(h2) AS t2 FROM pr),
k AS (SELECT *, [h1[k] / t1 for k in range(1, 21)] AS p, [h2[k] / t2 for k in range(1, 21)] AS q FROM s)
SELECT chrom, context, pos, list_sum([least(p[k], q[k]) for k in range(1, 21)]) AS overlap_min,
  sqrt(greatest(1 - list_sum([sqrt(p[k] * q[k]) for k in range(1, 21)]), 0)) AS hellinger,
  list_sum([abs(list_sum(p[1:k]) - list_sum(q[1:k])) for k in range(1, 21)]) / 20 AS wasserstein,
  list_sum([(CASE WHEN p[k] > 0 THEN p[k] * log2(p[k] / ((p[k] + q[k]) / 2)) ELSE 0 END + CASE WHEN q[k] > 0 THEN q[k] * log2(q[k] / ((p[k] + q[k]) / 2)) ELSE 0 END) / 2 for k in range(1, 21)]) AS js
FROM k""", "overlap_min hellinger wasserstein js")
def _(t):
    p = D.gate(D.align(*_cohorts(t)))
    a, b = F.col("h1"), F.col("h2")
    return p.select(*C.KEY, H.overlap_min(a, b).alias("overlap_min"), H.hellinger(a, b).alias("hellinger"), H.wasserstein(a, b).alias("wasserstein"), H.jensen_shannon(a, b).alias("js"))


_PV = "SELECT l_orderkey AS id, l_linenumber AS k, l_returnflag AS grp, (1 + (l_orderkey * 48271 + l_linenumber * 69621) % 9973) / 9974.0e0 AS p FROM lineitem"


def _pvalues(t):
    return t.lineitem.select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("k"), F.col("l_returnflag").alias("grp"),
                             ((1 + (F.col("l_orderkey") * 48271 + F.col("l_linenumber") * 69621) % 9973) / 9974.0).alias("p"))


@register("fdr_storey_pair", f"WITH v AS ({_PV}) SELECT id, k, grp, p, q_value FROM ({_storey('v', 'grp', 'p', fdr.PAIR_LAMBDAS, 'mean', True)})", "p q_value")
def _(t):
    return fdr.storey_pair(_pvalues(t), "p", ["grp"])


@register("fdr_storey_library", f"WITH v AS ({_PV}) SELECT id, k, grp, p, q_value FROM ({_storey('v', '', 'p', fdr.LIBRARY_LAMBDAS, 'median', False)})", "p q_value")
def _(t):
    return fdr.storey_library(_pvalues(t), "p", [])


@register("fdr_bh", f"""WITH v AS ({_PV}) SELECT id, k, grp, p, least(min(p * m / rk) OVER (PARTITION BY grp ORDER BY p DESC, rk DESC ROWS UNBOUNDED PRECEDING), 1) AS q_value
FROM (SELECT *, count(*) OVER (PARTITION BY grp) AS m, row_number() OVER (PARTITION BY grp ORDER BY p) AS rk FROM v)""", "p q_value")
def _(t):
    return fdr.benjamini_hochberg(_pvalues(t), "p", ["grp"])


@register("effect_rank", _OVER + """ SELECT chrom, context, pos, (rank() OVER w + (count(*) OVER (PARTITION BY chrom, context, effect_size) - 1) / 2.0e0 - 0.5) / count(*) OVER (PARTITION BY chrom, context) AS effect_ecdf
FROM (SELECT * REPLACE (round(effect_size, 9) AS effect_size) FROM r) WINDOW w AS (PARTITION BY chrom, context ORDER BY effect_size)""", "effect_ecdf")
def _(t):
    r = dmp(t).withColumn("effect_size", F.round("effect_size", 9))
    return fdr.fraction_rank(r, "effect_size", ["chrom", "context"], "effect_ecdf").select(*C.KEY, "effect_ecdf")


_Q = DMP_SQL.replace("SELECT * EXCLUDE (m, pi0, rk) FROM q", "")


@register("dmp_select_mass", _Q + """, s AS (SELECT * REPLACE (round(effect_size, 9) AS effect_size) FROM q), w AS (
SELECT *, sum(effect_size) OVER (PARTITION BY context ORDER BY effect_size DESC, chrom, context, pos ROWS UNBOUNDED PRECEDING) - effect_size AS before, sum(effect_size) OVER (PARTITION BY context) AS total FROM s)
SELECT chrom, context, pos, effect_size FROM w WHERE before < 0.5 * total""", "effect_size")
def _(t):
    return D.select_by_mass(dmp(t).withColumn("effect_size", F.round("effect_size", 9)), "effect_size", 0.5, ["context"]).select(*C.KEY, "effect_size")


@register("dmp_regions", _Q + """, s AS (SELECT *, CASE WHEN pos - lag(pos) OVER (PARTITION BY chrom, context ORDER BY pos) <= 40 THEN 0 ELSE 1 END AS brk FROM q WHERE q_value <= 0.2),
i AS (SELECT *, sum(brk) OVER (PARTITION BY chrom, context ORDER BY pos) AS region FROM s)
SELECT chrom, context, CAST(region AS BIGINT) AS region, min(pos) AS region_start, max(pos) AS region_end, count(*) AS n_sites, avg(delta_mean) AS mean_delta, min(q_value) AS min_q FROM i GROUP BY 1, 2, 3""", "mean_delta min_q")
def _(t):
    return D.regions(dmp(t), "q_value", 0.2, 40)


@register("dmp_funnel", _Q + " SELECT chrom, context, count(*) AS entered, count(*) FILTER (q_value <= 0.1) AS passed, count(*) FILTER (q_value <= 0.1) / CAST(count(*) AS DOUBLE) AS retained FROM q GROUP BY ROLLUP (chrom, context)", "retained")
def _(t):
    return D.funnel(dmp(t), F.col("q_value") <= 0.1)


@register("dmp_funnel_sweep", _Q + """, s AS (SELECT unnest([0.01e0, 0.05e0, 0.1e0, 0.2e0]) AS threshold)
SELECT threshold, context, count(*) AS entered, count(*) FILTER (q_value <= threshold) AS passed FROM q, s GROUP BY 1, 2""", "threshold")
def _(t):
    limits = F.explode(F.array(*[F.lit(v) for v in (0.01, 0.05, 0.1, 0.2)]))  # four rows for each site
    return dmp(t).withColumn("threshold", limits).groupBy("threshold", "context").agg(F.count("*").alias("entered"), F.count_if(F.col("q_value") <= F.col("threshold")).alias("passed"))


@register("dmp_context_weights", _OVER + """, l AS (SELECT context, quantile_cont(effect_size, 0.1) AS lo, quantile_cont(effect_size, 0.9) AS hi FROM r GROUP BY context),
m AS (SELECT context, avg(effect_size) AS trimmed_mean FROM r JOIN l USING (context) WHERE effect_size BETWEEN lo AND hi GROUP BY context)
SELECT context, trimmed_mean, trimmed_mean / sum(trimmed_mean) OVER () AS weight FROM m""", "trimmed_mean weight")
def _(t):
    return D.context_weights(dmp(t), "effect_size")


@register("dmp_elbow", _OVER + """, s AS (SELECT context, round(effect_size, 9) AS v FROM r),
k AS (SELECT context, v, row_number() OVER (PARTITION BY context ORDER BY v DESC) AS rank, count(*) OVER (PARTITION BY context) AS n, ln(v + 1e-6) AS y FROM s),
sc AS (SELECT *, (rank - 1) / CAST(greatest(n - 1, 1) AS DOUBLE) AS x, (y - min(y) OVER (PARTITION BY context)) / (max(y) OVER (PARTITION BY context) - min(y) OVER (PARTITION BY context)) AS ys FROM k),
d AS (SELECT *, round(abs((0.0e0 - 1) * x - ys + 1) / sqrt(2), 12) AS d FROM sc WHERE rank > 1 AND rank < n),
b AS (SELECT *, row_number() OVER (PARTITION BY context ORDER BY d DESC, rank) AS o FROM d) SELECT context, rank AS elbow_rank, v AS cutoff FROM b WHERE o = 1""", "cutoff")
def _(t):
    r = dmp(t).select("context", F.round("effect_size", 9).alias("v"))
    return D.elbow(r, "v", ["context"], 1e-6)


@register("dmp_topk", _Q + " SELECT chrom, context, pos, round(effect_size, 6) AS effect_size FROM q ORDER BY round(effect_size, 9) DESC, chrom, context, pos LIMIT 50", "effect_size")
def _(t):
    return dmp(t).orderBy(F.desc(F.round("effect_size", 9)), "chrom", "context", "pos").limit(50).select(*C.KEY, "effect_size")


@register("dmp_topk_group", _Q + """ SELECT chrom, context, pos, effect_size FROM (SELECT *, row_number() OVER (PARTITION BY chrom, context ORDER BY round(effect_size, 9) DESC, pos) AS k FROM q) WHERE k <= 5""", "effect_size")
def _(t):
    from pyspark.sql import Window

    k = F.row_number().over(Window.partitionBy("chrom", "context").orderBy(F.desc(F.round("effect_size", 9)), "pos"))
    return dmp(t).withColumn("k", k).where("k <= 5").select(*C.KEY, "effect_size")
