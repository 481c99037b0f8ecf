"""Queries of cohort statistics, scans and scalar functions on the derived site counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import special
from ..operators import centroid as C
from ..sources import scans
from .registry import register

_X = "CASE WHEN mC + uC > 0 THEN mC / CAST(mC + uC AS DOUBLE) ELSE 0 END"
_BIN = "CASE WHEN mC + uC > 0 THEN least((mC * 20) // (mC + uC), 19) ELSE 0 END"
_HIST = "array_to_string([{}], ',')".format(", ".join(f"count(*) FILTER (b = {k})" for k in range(20)))
#: Body of the cohort statistics in SQL, grouped by cohort and site.
CENTROID = f"""
  SELECT cohort, chrom, context, pos, count(*) AS N, sum(x) AS Sx, sum(x * x) AS Sx2, CAST(sum(mC) AS BIGINT) AS Sm, CAST(sum(uC) AS BIGINT) AS Su,
         CAST(sum(c * c) AS BIGINT) AS Sc2, sum(c * x * x) AS Swx2, {_HIST} AS bins
  FROM (SELECT *, {_X} AS x, mC + uC AS c, {_BIN} AS b FROM site_counts) GROUP BY cohort, chrom, context, pos"""
BY = ["cohort", *C.KEY]


def joined_bins(df):
    return df.withColumn("bins", F.array_join(F.col("bin_counts").cast("array<string>"), ",")).drop("bin_counts")


@register("centroid_build", CENTROID, "Sx Sx2 Swx2")
def _(t):
    return joined_bins(C.build(t.site_counts, BY))


@register("centroid_merge", f"WITH c AS (SELECT * FROM ({CENTROID})) " + """
SELECT chrom, context, pos, N, Sx, Sm, Su, bins FROM c WHERE cohort = 'control'""", "Sx")
def _(t):
    both = C.build(t.site_counts, C.KEY)
    sick = C.build(t.site_counts.where("cohort = 'disease'"), C.KEY)
    return joined_bins(C.merge([(both, 1), (sick, -1)])).select(*C.KEY, "N", "Sx", "Sm", "Su", "bins")


@register("centroid_moments", f"WITH c AS ({CENTROID}) " + """
SELECT cohort, chrom, context, pos, Sx / N AS mean, greatest((Sx2 - Sx * Sx / N) / greatest(N - 1, 1), 1e-12) AS variance,
       CASE WHEN Sm + Su > 0 THEN Sm / CAST(Sm + Su AS DOUBLE) END AS weighted_mean,
       CASE WHEN Sm + Su > 0 THEN greatest(Swx2 / (Sm + Su) - (Sm / CAST(Sm + Su AS DOUBLE)) ** 2, 0) END AS weighted_variance,
       (Sm + Su) / CAST(N AS DOUBLE) AS mean_coverage FROM c""", "mean variance weighted_mean weighted_variance mean_coverage")
def _(t):
    return C.moments(C.build(t.site_counts, BY)).select(*BY, "mean", "variance", "weighted_mean", "weighted_variance", "mean_coverage")


@register("centroid_filter", f"WITH c AS ({CENTROID}) SELECT cohort, chrom, context, pos, N, Sm + Su AS total FROM c WHERE N >= 5 AND Sm + Su >= 100")
def _(t):
    return C.filter_cohort(C.build(t.site_counts, BY), 5, 100).select(*BY, "N", (F.col("Sm") + F.col("Su")).alias("total"))


@register("centroid_rebin", f"""
SELECT cohort, chrom, context, pos, array_to_string([{', '.join(f'count(*) FILTER (b = {k})' for k in range(10))}], ',') AS bins
FROM (SELECT *, {_BIN.replace('* 20', '* 10').replace('19', '9')} AS b FROM site_counts) GROUP BY cohort, chrom, context, pos""")
def _(t):
    return joined_bins(C.build(t.site_counts, BY, 10)).select(*BY, "bins")


@register("coverage_summary", """
SELECT context, quantile_cont(mC + uC, 0.5) AS median, avg(mC + uC) AS mean, quantile_cont(mC + uC, 0.25) AS q1, quantile_cont(mC + uC, 0.75) AS q3,
       quantile_cont(mC + uC, 0.75) + 1.5 * (quantile_cont(mC + uC, 0.75) - quantile_cont(mC + uC, 0.25)) AS fence,
       CAST(greatest(floor(quantile_cont(mC + uC, 0.75) + 1.5 * (quantile_cont(mC + uC, 0.75) - quantile_cont(mC + uC, 0.25))), 1) AS BIGINT) AS n_cap
FROM site_counts GROUP BY context""", "median mean q1 q3 fence")
def _(t):
    return C.coverage_summary(t.site_counts, ["context"])


@register("coverage_outliers", """
WITH m AS (SELECT sample_id, quantile_cont(mC + uC, 0.5) AS median FROM site_counts GROUP BY sample_id),
c AS (SELECT quantile_cont(median, 0.5) AS centre FROM m),
d AS (SELECT quantile_cont(abs(median - centre), 0.5) AS mad FROM m, c)
SELECT sample_id, median, CASE WHEN mad > 0 THEN 0.6745 * (median - centre) / mad ELSE 0 END AS robust_z,
       abs(CASE WHEN mad > 0 THEN 0.6745 * (median - centre) / mad ELSE 0 END) > 3.5 AS is_outlier FROM m, c, d""", "median robust_z")
def _(t):
    return C.coverage_outliers(t.site_counts)


@register("centroid_pair_check", f"WITH c AS ({CENTROID}), " + """
b AS (SELECT x.Sx / x.N AS m1, y.Sx / y.N AS m2, abs(x.Sx / x.N - y.Sx / y.N) AS d FROM c x JOIN c y USING (chrom, context, pos) WHERE x.cohort = 'control' AND y.cohort = 'disease'),
k AS (SELECT quantile_cont(d, 0.1) AS cut FROM b)
SELECT count(*) AS n_common, quantile_cont(m1, 0.5) AS median1, quantile_cont(m2, 0.5) AS median2, avg(d) FILTER (d >= cut) AS trimmed_delta FROM b, k""", "median1 median2 trimmed_delta")
def _(t):
    c = C.build(t.site_counts, BY)
    return C.validate_pair(c.where("cohort = 'control'"), c.where("cohort = 'disease'"))


@register("heterogeneity_tau2", f"WITH c AS ({CENTROID}) " + """
SELECT cohort, chrom, context, pos, greatest(0, (Swx2 - Sm * Sm / greatest(CAST(Sm + Su AS DOUBLE), 1e-12) - greatest(N - 1, 0))
       / greatest(Sm + Su - Sc2 / greatest(CAST(Sm + Su AS DOUBLE), 1e-12), 1e-12)) AS tau2 FROM c""", "tau2")
def _(t):
    return C.build(t.site_counts, BY).select(*BY, C.heterogeneity().alias("tau2"))


@register("scan_range", "SELECT sample_id, chrom, context, pos, mC, uC FROM site_counts WHERE chrom IN ('1', '2') AND context = 'CG' AND pos >= 200 AND pos < 600")
def _(t):
    return scans.scan_sites(t.site_counts, chroms=["1", "2"], contexts=["CG"], start=200, end=600).select("sample_id", "chrom", "context", "pos", "mC", "uC")


@register("scan_positions", "SELECT * FROM site_counts s WHERE EXISTS (SELECT 1 FROM genes g WHERE g.chrom = s.chrom AND g.gene_start = s.pos)")
def _(t):
    return scans.scan_positions(t.site_counts, t.genes.select("chrom", F.col("gene_start").alias("pos")))


@register("scan_shards", """
WITH m AS (SELECT chrom, min(pos) AS lo FROM site_counts GROUP BY chrom)
SELECT chrom, CAST((pos - lo) // 500 AS BIGINT) AS shard, count(*) AS n_rows, min(pos) AS first_pos, max(pos) AS last_pos FROM site_counts JOIN m USING (chrom) GROUP BY 1, 2""")
def _(t):
    return scans.shards(t.site_counts, 500).groupBy("chrom", "shard").agg(F.count("*").alias("n_rows"), F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"))


@register("decode_context", """
WITH p AS (SELECT p_partkey AS pos, p_partkey % 25 + 32 * (p_partkey % 4) + 128 * (p_partkey % 2) AS tnc FROM part)
SELECT pos, CAST(tnc & 31 AS BIGINT) AS trinucleotide, CASE (tnc >> 5) & 3 WHEN 0 THEN 'CG' WHEN 1 THEN 'CHG' WHEN 2 THEN 'CHH' ELSE 'UNKNOWN' END AS context,
       CASE WHEN (tnc >> 7) & 1 = 0 THEN '+' ELSE '-' END AS strand FROM p""")
def _(t):
    packed = t.part.select(F.col("p_partkey").alias("pos"), (F.col("p_partkey") % 25 + 32 * (F.col("p_partkey") % 4) + 128 * (F.col("p_partkey") % 2)).alias("tnc"))
    return scans.decode_tnc(packed).select("pos", "trinucleotide", "context", "strand")


@register("beta_m_values", """
SELECT sample_id, chrom, context, pos, log2(b / (1 - b)) AS m, 1 / (1 + pow(2, -log2(b / (1 - b)))) AS back
FROM (SELECT *, greatest(least(CASE WHEN mC + uC > 0 THEN mC / CAST(mC + uC AS DOUBLE) ELSE 0 END, 1 - 1e-3), 1e-3) AS b FROM site_counts)""", "m back")
def _(t):
    m = t.site_counts.withColumn("m", scans.beta_to_m(C.level(), 1e-3))
    return m.select("sample_id", *C.KEY, "m", scans.m_to_beta(F.col("m")).alias("back"))


_MOM = f"""WITH c AS ({CENTROID}), v AS (SELECT *, least(greatest(Sx / N, 1e-6), 1 - 1e-6) AS mu, greatest((Sx2 - Sx * Sx / N) / greatest(N - 1, 1), 1e-12) AS va FROM c WHERE N > 1),
ab AS (SELECT cohort, chrom, context, pos, greatest(mu * greatest(mu * (1 - mu) / va - 1, 1e-3), 1e-3) AS a, greatest((1 - mu) * greatest(mu * (1 - mu) / va - 1, 1e-3), 1e-3) AS b FROM v)"""


def _beta(t):
    return scans.beta_moments(C.build(t.site_counts, BY).where("N > 1"))


@register("beta_moments", _MOM + " SELECT cohort, chrom, context, pos, a, b FROM ab WHERE a < 1e6", "a b")
def _(t):
    return _beta(t).select(*BY, "a", "b").where("a < 1e6")


@register("beta_distances", _MOM + """, lb AS (SELECT *, lgamma(a) + lgamma(b) - lgamma(a + b) AS l FROM ab),
p AS (SELECT x.chrom, x.context, x.pos, x.a a1, x.b b1, x.l l1, y.a a2, y.b b2, y.l l2, lgamma((x.a + y.a) / 2) + lgamma((x.b + y.b) / 2) - lgamma((x.a + y.a + x.b + y.b) / 2) AS lm
      FROM lb x JOIN lb y USING (chrom, context, pos) WHERE x.cohort = 'control' AND y.cohort = 'disease' AND x.a + x.b < 1000 AND y.a + y.b < 1000)
SELECT chrom, context, pos, (l1 + l2) / 2 - lm AS bhattacharyya, sqrt(greatest(1 - exp(lm - (l1 + l2) / 2), 0)) AS hellinger FROM p""", "bhattacharyya hellinger")
def _(t):
    b = _beta(t).where("a + b < 1000")
    left = b.where("cohort = 'control'").select(*C.KEY, F.col("a").alias("a1"), F.col("b").alias("b1"))
    right = b.where("cohort = 'disease'").select(*C.KEY, F.col("a").alias("a2"), F.col("b").alias("b2"))
    return scans.beta_distances(left.join(right, C.KEY)).select(*C.KEY, "bhattacharyya", "hellinger")


@register("beta_divergences", _MOM + f""", p AS (SELECT x.chrom, x.context, x.pos, x.a a1, x.b b1, y.a a2, y.b b2
      FROM ab x JOIN ab y USING (chrom, context, pos) WHERE x.cohort = 'control' AND y.cohort = 'disease' AND x.a + x.b < 1000 AND y.a + y.b < 1000),
k AS (SELECT *, lgamma(a2) + lgamma(b2) - lgamma(a2 + b2) - (lgamma(a1) + lgamma(b1) - lgamma(a1 + b1)) + (a1 - a2) * {special.digamma('a1')} + (b1 - b2) * {special.digamma('b1')}
        + (a2 - a1 + b2 - b1) * {special.digamma('(a1 + b1)')} AS kl12,
      lgamma(a1) + lgamma(b1) - lgamma(a1 + b1) - (lgamma(a2) + lgamma(b2) - lgamma(a2 + b2)) + (a2 - a1) * {special.digamma('a2')} + (b2 - b1) * {special.digamma('b2')}
        + (a1 - a2 + b1 - b2) * {special.digamma('(a2 + b2)')} AS kl21 FROM p)
SELECT chrom, context, pos, round(kl12, 4) AS kl, round(kl12 + kl21, 4) AS jeffreys FROM k""", "kl jeffreys")
def _(t):
    b = _beta(t).where("a + b < 1000")
    left = b.where("cohort = 'control'").select(*C.KEY, F.col("a").alias("a1"), F.col("b").alias("b1"))
    right = b.where("cohort = 'disease'").select(*C.KEY, F.col("a").alias("a2"), F.col("b").alias("b2"))
    return scans.beta_distances(left.join(right, C.KEY)).select(*C.KEY, F.round("kl", 4).alias("kl"), F.round("jeffreys", 4).alias("jeffreys"))


@register("genome_summary", f"""
SELECT chrom, count(*) AS n_rows, CAST(sum(mC + uC) AS BIGINT) AS total_coverage, avg({_X}) AS mean_level, avg(mC + uC) AS mean_coverage FROM site_counts GROUP BY chrom""", "mean_level mean_coverage")
def _(t):
    return t.site_counts.groupBy("chrom").agg(F.count("*").alias("n_rows"), F.sum(C.coverage()).alias("total_coverage"), F.avg(C.level()).alias("mean_level"), F.avg(C.coverage()).alias("mean_coverage"))


@register("count_violations", """
SELECT 'negative' AS rule, count(*) FILTER (mC < 0 OR uC < 0) AS n FROM site_counts UNION ALL SELECT 'uncovered', count(*) FILTER (mC + uC = 0) FROM site_counts
UNION ALL SELECT 'deep', count(*) FILTER (mC + uC > 60) FROM site_counts""")
def _(t):
    return scans.violations(t.site_counts, {"negative": (F.col("mC") < 0) | (F.col("uC") < 0), "uncovered": C.coverage() == 0, "deep": C.coverage() > 60})
