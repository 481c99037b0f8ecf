"""Queries of gene roll-ups over annotated detection results."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import special
from ..operators import genes as G
from ..operators import intervals as I
from .detect_queries import DMP_SQL, dmp
from .registry import register

_D = DMP_SQL[DMP_SQL.index("WITH ") + 5:]
_HIT = f"""WITH dm AS (WITH {_D}), h AS (SELECT s.*, r.gene_id, r.feature_type, r.region_start, r.region_end FROM dm s JOIN regions r ON s.chrom = r.chrom AND s.pos >= r.region_start AND s.pos < r.region_end),
x AS (SELECT *, CAST(delta_sign AS BIGINT) AS sgn, least(n1, 8) / 8.0e0 AS frequency FROM (SELECT *, row_number() OVER (PARTITION BY chrom, context, pos, gene_id
  ORDER BY CASE feature_type WHEN 'promoter' THEN 1 WHEN 'exon' THEN 2 WHEN 'intron' THEN 3 WHEN 'gene_body' THEN 4 ELSE 5 END, region_start, region_end) AS k FROM h) WHERE k = 1)"""


def _hits(t):
    d = dmp(t).select("chrom", "context", "pos", "p_value", "q_value", "effect_size", F.col("delta_sign").alias("sign"), (F.least("n1", F.lit(8)) / 8.0).alias("frequency"))
    return I.exclusive_features(I.overlap(d, t.regions.drop("strand")), ["chrom", "context", "pos", "gene_id"])


@register("gene_rollup", _HIT + """ SELECT gene_id, count(*) AS n_hits, count(DISTINCT (chrom, pos)) AS n_sites, min(p_value) AS min_p, avg(p_value) AS mean_p, min(q_value) AS min_q,
sum(effect_size) AS sum_effect, max(effect_size) AS max_effect, avg(effect_size) AS mean_effect FROM x GROUP BY gene_id""", "min_p mean_p min_q sum_effect max_effect mean_effect")
def _(t):
    return G.roll_up(_hits(t))


@register("gene_importance", _HIT + """, w AS (SELECT *, frequency * CASE feature_type WHEN 'promoter' THEN CASE WHEN sgn > 0 THEN 2.0 WHEN sgn < 0 THEN 1.0 ELSE 1.5 END WHEN 'exon' THEN CASE WHEN sgn > 0 THEN 1.5 WHEN sgn < 0 THEN 1.0 ELSE 1.25 END
  WHEN 'intron' THEN CASE WHEN sgn > 0 THEN 0.5 WHEN sgn < 0 THEN 0.7 ELSE 0.6 END WHEN 'gene_body' THEN 1.0 ELSE 0.5 END * abs(effect_size) AS term FROM x),
g AS (SELECT gene_id, sum(term) AS sum_abs, CASE WHEN sum(term) > 0 THEN abs(sum(term * sgn)) / sum(term) ELSE 0 END AS coherence, avg(frequency) AS f FROM w GROUP BY gene_id)
SELECT gene_id, sum_abs, coherence, sum_abs * coherence * sqrt(f) AS gene_importance FROM g""", "sum_abs coherence gene_importance")
def _(t):
    return G.importance(_hits(t))


@register("gene_stouffer", _HIT + f""", z AS (SELECT gene_id, effect_size AS w, least(-{special.norm_ppf('(greatest(least(p_value, 1 - 1e-15), 1e-300) / 2)')}, 8) * sgn AS z FROM x WHERE effect_size > 0),
s AS (SELECT gene_id, sum(w * z) / sqrt(sum(w * w)) AS z FROM z GROUP BY gene_id) SELECT gene_id, z, least(1, 2 * {special.norm_sf('abs(z)')}) AS p_combined FROM s""", "z p_combined")
def _(t):
    return G.stouffer(_hits(t).withColumn("w", F.col("effect_size")).where("w > 0"), ["gene_id"])


@register("gene_combine_p", _HIT + f""", p AS (SELECT gene_id, greatest(least(p_value, 1 - 1e-15), 1e-300) AS p FROM x),
i AS (SELECT *, row_number() OVER (PARTITION BY gene_id ORDER BY p) AS i, count(*) OVER (PARTITION BY gene_id) AS k FROM p),
g AS (SELECT gene_id, count(*) AS k, -2 * sum(ln(p)) AS fisher_stat, min(p) AS m, least(min(k * p / i), 1) AS simes, avg(-{special.norm_ppf('p')}) AS mz, sum(p) AS sp, sum({special.norm_ppf('greatest(least(1 - pow(p, 1 / CAST(k AS DOUBLE)), 1 - 1e-15), 1e-300)')}) AS mg FROM i GROUP BY gene_id),
f AS (SELECT *, least(1, list_sum([exp(j * ln(fisher_stat / 2) - fisher_stat / 2 - lgamma(j + 1)) for j in range(0, k)])) AS fisher FROM g)
SELECT gene_id, k, fisher_stat, 1 - pow(1 - m, k) AS tippett, simes, {special.norm_sf('mz')} AS stouffer, fisher, fisher AS lancaster,
CASE WHEN k < 20 THEN 1 - pow(least(sp, 1), k) ELSE {special.norm_sf('((sp - k / 2e0) / sqrt(k / 12e0))')} END AS edgington, {special.norm_sf('(mg / sqrt(k))')} AS mudholkar_george FROM f""", "fisher_stat tippett simes stouffer fisher lancaster edgington mudholkar_george")
def _(t):
    return G.combine_p(_hits(t), ["gene_id"])
