"""Queries of per-sample measures and quality control."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import samples as S
from .registry import register

_L = "l AS (SELECT *, mC + uC AS c, CASE WHEN mC + uC > 0 THEN mC / CAST(mC + uC AS DOUBLE) ELSE 0 END AS x FROM site_counts)"
_H = "-(least(greatest(x, 1e-12), 1 - 1e-12) * log2(least(greatest(x, 1e-12), 1 - 1e-12)) + (1 - least(greatest(x, 1e-12), 1 - 1e-12)) * log2(1 - least(greatest(x, 1e-12), 1 - 1e-12)))"


@register("genome_measures", f"""WITH {_L} SELECT sample_id, sum(c * x) / sum(c) AS mean_beta, sum(c * {_H}) / sum(c) AS entropy, avg(CASE WHEN x < 0.2e0 THEN 1.0e0 ELSE 0 END) AS hypo_fraction,
avg(CASE WHEN x BETWEEN 0.2e0 AND 0.8e0 THEN 1.0e0 ELSE 0 END) AS middle_fraction, avg(c) AS mean_coverage, quantile_cont(c, 0.5) AS median_coverage FROM l WHERE c > 0 GROUP BY sample_id""",
    "mean_beta entropy hypo_fraction middle_fraction mean_coverage median_coverage")
def _(t):
    return S.genome_measures(t.site_counts)


@register("coverage_deviation", """WITH m AS (SELECT sample_id, chrom, quantile_cont(mC + uC, 0.5) AS median FROM site_counts GROUP BY 1, 2), c AS (SELECT chrom, quantile_cont(median, 0.5) AS cohort FROM m GROUP BY 1)
SELECT sample_id, chrom, median, CASE WHEN cohort > 0 THEN (median - cohort) / cohort END AS deviation FROM m JOIN c USING (chrom)""", "median deviation")
def _(t):
    return S.relative_coverage(t.site_counts)


@register("adjacent_disagreement", f"""WITH {_L}, w AS (SELECT sample_id, pos - lag(pos) OVER v AS gap, abs(x - lag(x) OVER v) AS d FROM l WHERE c >= 1 WINDOW v AS (PARTITION BY sample_id, chrom ORDER BY pos))
SELECT sample_id, count(*) AS n_pairs, avg(CASE WHEN d > 0.5 THEN 1.0e0 ELSE 0 END) AS disagreement FROM w WHERE gap <= 2 GROUP BY sample_id""", "disagreement")
def _(t):
    return S.adjacent_disagreement(t.site_counts, ["sample_id"])


_PAT = """r AS (SELECT sample_id, read_id, i // 4 AS tile, CAST(sum(meth * (8 >> CAST(i % 4 AS INT))) AS BIGINT) AS pattern FROM read_cpgs GROUP BY 1, 2, 3 HAVING count(*) = 4),
pt AS (SELECT sample_id, tile, pattern, count(*) AS cnt FROM r GROUP BY 1, 2, 3)"""


@register("read_patterns", f"WITH {_PAT} SELECT * FROM pt")
def _(t):
    return S.tile_patterns(t.read_cpgs)


@register("read_pattern_measures", f"""WITH {_PAT}, p AS (SELECT *, sum(cnt) OVER (PARTITION BY sample_id, tile) AS n, cnt / CAST(sum(cnt) OVER (PARTITION BY sample_id, tile) AS DOUBLE) AS p FROM pt)
SELECT sample_id, tile, CAST(max(n) AS BIGINT) AS n_reads, -sum(p * log2(p)) / 4 AS entropy, 1 - sum(p * p) AS epipolymorphism, coalesce(sum(p) FILTER (pattern NOT IN (0, 15)), 0) AS discordant FROM p GROUP BY 1, 2""", "entropy epipolymorphism discordant")
def _(t):
    return S.pattern_measures(S.tile_patterns(t.read_cpgs))


@register("tile_divergence", f"""WITH {_PAT}, g AS (SELECT CAST(sample_id AS BIGINT) % 2 AS g, tile, pattern, sum(cnt) AS cnt FROM pt GROUP BY 1, 2, 3), p AS (SELECT *, cnt / CAST(sum(cnt) OVER (PARTITION BY g, tile) AS DOUBLE) AS p FROM g),
w AS (SELECT tile, pattern, coalesce(sum(p) FILTER (g = 0), 0) AS p, coalesce(sum(p) FILTER (g = 1), 0) AS q FROM p GROUP BY 1, 2)
SELECT tile, sum((CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2) AS jsd FROM w GROUP BY tile""", "jsd")
def _(t):
    return S.tile_divergence(S.tile_patterns(t.read_cpgs), F.col("sample_id").cast("long") % 2)


@register("haplotype_load", """WITH r AS (SELECT *, i // 16 AS block FROM read_cpgs), k AS (SELECT unnest(generate_series(1, 16)) AS k),

h AS (SELECT a.sample_id, a.block, k.k, count(*) AS every, count(*) FILTER (a.run >= k.k) AS full_ FROM (
  SELECT *, coalesce(min(CASE WHEN meth = 0 THEN i END) OVER (PARTITION BY sample_id, read_id, block ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), (block + 1) * 16) - i AS run FROM r) a, k WHERE a.i + k.k <= (a.block + 1) * 16 GROUP BY 1, 2, 3)
SELECT sample_id, block, sum(k * (full_ / CAST(every AS DOUBLE))) / sum(k) AS mhl FROM h GROUP BY 1, 2""", "mhl")
def _(t):
    return S.haplotype_load(t.read_cpgs, 16)


@register("neighbour_r2", """WITH w AS (SELECT sample_id, i, meth, lead(meth) OVER (PARTITION BY sample_id, read_id ORDER BY i) AS nx FROM read_cpgs),
c AS (SELECT sample_id, i, count(*) AS n, corr(CAST(meth AS DOUBLE), CAST(nx AS DOUBLE)) AS r FROM w WHERE nx IS NOT NULL GROUP BY 1, 2) SELECT sample_id, i, n, CASE WHEN r IS NULL OR isnan(r) THEN 0 ELSE r * r END AS r2 FROM c""", "r2")
def _(t):
    return S.neighbour_r2(t.read_cpgs)


@register("haplotype_blocks", """WITH w AS (SELECT sample_id, i, meth, lead(meth) OVER (PARTITION BY sample_id, read_id ORDER BY i) AS nx FROM read_cpgs),
c AS (SELECT sample_id, i, avg(CASE WHEN meth = nx THEN 1.0e0 ELSE 0 END) AS same FROM w WHERE nx IS NOT NULL GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY i) AS k FROM c), g AS (SELECT *, k - row_number() OVER (PARTITION BY sample_id ORDER BY i) AS island FROM k WHERE same >= 0.5)
SELECT sample_id, min(i) AS first, max(i) AS last, count(*) AS n_pairs FROM g GROUP BY sample_id, island HAVING count(*) >= 2""")
def _(t):
    from pyspark.sql import Window

    w = Window.partitionBy("sample_id", "read_id").orderBy("i")
    pairs = t.read_cpgs.withColumn("nx", F.lead("meth").over(w)).where("nx is not null").groupBy("sample_id", "i").agg(F.avg((F.col("meth") == F.col("nx")).cast("double")).alias("same"))
    return S.good_runs(pairs, ["sample_id"], "i", F.col("same") >= 0.5, 2)


#: Letters to bases, ASCII of either case; others stay and make no motif.
_LETTERS, _BASES = "bdefhijklmopqrsuvwxyzacgtnBDEFHIJKLMOPQRSUVWXYZ", "ACGTACGTACGTACGTACGTAACGTNACGTACGTACGTACGTACGTA"
_ENDS = f"SELECT source AS sample_id, translate(substring(text, 1, 8), '{_LETTERS}', '{_BASES}') AS seq FROM documents"


@register("end_motifs", f"WITH e AS ({_ENDS}), m AS (SELECT sample_id, substring(seq, 1, 4) AS motif FROM e WHERE regexp_full_match(substring(seq, 1, 4), '[ACGT]{{4}}')) SELECT sample_id, motif, count(*) AS n, count(*) / CAST(sum(count(*)) OVER (PARTITION BY sample_id) AS DOUBLE) AS share FROM m GROUP BY 1, 2", "share")
def _(t):
    seq = F.translate(F.substring("text", 1, 8), _LETTERS, _BASES)
    return S.end_motifs(t.documents.select(F.col("source").alias("sample_id"), seq.alias("seq")))


@register("fragment_bins", "SELECT sample_id, chrom, CAST((frag_start + isize // 2) // 5000 AS BIGINT) AS bin, count(*) AS n FROM fragments GROUP BY 1, 2, 3")
def _(t):
    return S.fragment_bins(t.fragments, 5000)


@register("fragment_lengths", """WITH p AS (SELECT sample_id, isize, count(*) AS n FROM fragments GROUP BY 1, 2), m AS (SELECT sample_id, isize, row_number() OVER (PARTITION BY sample_id ORDER BY n DESC, isize) AS k FROM p WHERE isize BETWEEN 20 AND 100)
SELECT p.sample_id, CAST(sum(n) AS BIGINT) AS n, coalesce(sum(n) FILTER (p.isize <= 150), 0) / CAST(sum(n) AS DOUBLE) AS short_share, coalesce(sum(n) FILTER (p.isize > 220), 0) / CAST(sum(n) AS DOUBLE) AS long_share, any_value(m.isize) AS mode_length
FROM p LEFT JOIN m ON m.sample_id = p.sample_id AND m.k = 1 GROUP BY 1""", "short_share long_share")
def _(t):
    return S.fragment_lengths(t.fragments, 20, 100)


_LIM = "k AS (SELECT * FROM (VALUES ('quantity', 'min', 24.0e0), ('discount', 'max', 0.051e0), ('tax', 'max', 0.041e0)) v(metric, op, limit_value))"


@register("qc_guardrails", f"WITH {_LIM}, j AS (SELECT sample_id, CASE WHEN op = 'min' THEN value >= limit_value ELSE value <= limit_value END AS ok FROM qc_metrics JOIN k USING (metric)) SELECT sample_id, count(*) AS n_metrics, count(*) FILTER (NOT ok) AS n_failed, bool_and(ok) AS passed FROM j GROUP BY 1")
def _(t):
    limits = t.spark.createDataFrame([("quantity", "min", 24.0), ("discount", "max", 0.051), ("tax", "max", 0.041)], "metric string, op string, limit_value double")
    return S.guardrails(t.qc_metrics, limits)


@register("qc_suggest_limits", "SELECT metric, quantile_cont(value, 0.05) AS p5, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.95) AS p95 FROM qc_metrics GROUP BY 1", "p5 p50 p95")
def _(t):
    return S.suggest_limits(t.qc_metrics)


_DIP = "d AS (SELECT sample_id, min(cycle) AS first_cycle, max(cycle) AS last_cycle, min(quality) AS lowest FROM (SELECT *, cycle - row_number() OVER (PARTITION BY sample_id ORDER BY cycle) AS island FROM cycles WHERE quality < 23) GROUP BY sample_id, island)"


@register("qc_quality_dips", f"WITH {_DIP} SELECT * FROM d", "lowest")
def _(t):
    return S.quality_dips(t.cycles, 23.0)


@register("qc_dip_pattern", f"WITH {_DIP}, g AS (SELECT sample_id, CAST(sum(last_cycle - first_cycle + 1) AS BIGINT) AS n_bad, count(*) AS n_regions, min(first_cycle) AS a, max(last_cycle) AS b FROM d GROUP BY 1) SELECT sample_id, n_bad, n_regions, CASE WHEN n_bad >= 12 THEN 'broad' WHEN n_regions >= 2 THEN 'multi' WHEN b <= 10 THEN 'read_start' WHEN a > 90 THEN 'read_end' ELSE 'middle' END AS pattern FROM g")
def _(t):
    return S.dip_pattern(S.quality_dips(t.cycles, 23.0), 100)


@register("qc_compare_groups", """WITH g AS (SELECT metric, CASE WHEN CAST(sample_id AS BIGINT) % 3 = 0 THEN 'a' WHEN CAST(sample_id AS BIGINT) % 3 = 1 THEN 'b' ELSE 'c' END AS grp, avg(value) AS m, count(*) AS n FROM qc_metrics GROUP BY 1, 2)
SELECT x.metric, x.grp AS grp1, y.grp AS grp2, x.n AS n1, y.n AS n2, x.m - y.m AS difference FROM g x JOIN g y ON x.metric = y.metric AND x.grp < y.grp""", "difference")
def _(t):
    k = F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("sample_id").cast("long") % 3 + 1).cast("int"))
    return S.compare_groups(t.qc_metrics.withColumn("grp", k))
