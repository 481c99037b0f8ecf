"""Queries of directional scores, distortion weights, edge evidence, hold-out metrics and expression files."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import special
from ..operators import centroid as C
from ..operators import directional, distortion, edges
from ..operators import models as M
from ..operators import scoring as S
from ..shared import new_path
from ..sources import expression
from .fits_queries import _AB, _cohort_centroids
from .genes_queries import _HIT, _hits
from .registry import register
from .scoring_queries import _MIXED

_SITES = """d AS (SELECT gene_id AS gene, context AS comparison, chrom, context, pos, feature_type, effect_size * sgn AS e, abs(effect_size * sgn) * CASE feature_type WHEN 'promoter' THEN 2.0e0 WHEN 'exon' THEN 1.5e0 ELSE 1.0e0 END AS w FROM x),
lv AS (SELECT sample_id, chrom, context, pos, mC / CAST(mC + uC AS DOUBLE) - 0.5e0 AS b FROM site_counts WHERE mC + uC > 0)"""


def _sites(t):
    weight = F.when(F.col("feature_type") == "promoter", 2.0).when(F.col("feature_type") == "exon", 1.5).otherwise(1.0)
    return _hits(t).select(F.col("gene_id").alias("gene"), F.col("context").alias("comparison"), *C.KEY, "feature_type", (F.col("effect_size") * F.col("sign")).alias("effect_size"), weight.alias("region_weight"))


@register("region_directional_scores", _HIT + f""", {_SITES}, n AS (SELECT comparison, feature_type FROM d WHERE w > 0 GROUP BY 1, 2 HAVING count(DISTINCT (chrom, context, pos)) >= 2)
SELECT sample_id, comparison, feature_type, sum(sign(e) * w * b) / sum(w) AS score, count(*) AS n_loci FROM d JOIN n USING (comparison, feature_type) JOIN lv USING (chrom, context, pos) WHERE w > 0 GROUP BY 1, 2, 3""", "score")
def _(t):
    return directional.region_scores(t.site_counts, _sites(t), min_loci=2)


@register("gene_directional_scores", _HIT + f""", {_SITES}, p AS (SELECT comparison, gene, sqrt(count(*)) * sum(abs(e)) AS w, sign(sum(e)) AS prior FROM d GROUP BY 1, 2), sz AS (SELECT comparison, count(*) AS size FROM p GROUP BY 1),
g AS (SELECT sample_id, comparison, gene, sum(sign(e) * w * b) / sum(w) AS dir FROM d JOIN lv USING (chrom, context, pos) WHERE w > 0 GROUP BY 1, 2, 3),
a AS (SELECT sample_id, comparison, count(*) AS n, sum(w * dir) / sum(w) AS score, quantile_cont(dir, 0.75) - quantile_cont(dir, 0.25) AS iqr,
      coalesce(sum(w) FILTER (prior <> 0 AND sign(dir) = prior), 0) / sum(w) FILTER (prior <> 0) AS agree FROM g JOIN p USING (comparison, gene) GROUP BY 1, 2)
SELECT s.sample_id, comparison, score, coalesce(n, 0) / CAST(size AS DOUBLE) AS observed_fraction, CASE WHEN n >= 2 THEN iqr END AS iqr, agree AS sign_agreement
FROM (SELECT DISTINCT sample_id FROM site_counts) s CROSS JOIN sz LEFT JOIN a USING (sample_id, comparison)""", "score observed_fraction iqr sign_agreement")
def _(t):
    sites = _sites(t)
    genes = sites.groupBy("comparison", "gene").agg(F.sum(F.abs("effect_size")).alias("importance"), F.count("*").alias("support"), F.sum("effect_size").alias("prior"))
    return directional.gene_scores(t.site_counts, sites, genes)


def _entropy(a: str, b: str) -> str:
    return f"(lgamma({a}) + lgamma({b}) - lgamma({a} + {b}) - ({a} - 1) * {special.digamma(a)} - ({b} - 1) * {special.digamma(b)} + ({a} + {b} - 2) * {special.digamma(f'({a} + {b})')})"


_T = f"""{_AB}, sh AS (SELECT *, a / (a + b) AS m, greatest(a / (a + b) * (b / (a + b)) / (a + b), 1e-12) AS vn FROM ab),
st AS (SELECT *, CASE WHEN a + b < 5 THEN (m - 0.5e0) / sqrt(vn) ELSE (a - b) / (a + b) END AS s, CASE WHEN a + b < 5 THEN 0.5e0 * ln(2 * pi() * exp(1.0e0) * vn) ELSE {_entropy('a', 'b')} END AS h FROM sh),
tt AS (SELECT x.chrom, x.context, x.pos, (y.m - x.m) * (1 + abs(y.s - x.s)) * exp(-abs(y.h - x.h)) AS t FROM st x JOIN st y USING (chrom, context, pos) WHERE x.c = 'control' AND y.c = 'disease')"""


def _distortions(t):
    _, c = _cohort_centroids(t)
    at = lambda n, k: F.col(n)[k]
    both = c.where(at("a", 0).isNotNull() & at("a", 1).isNotNull())
    return both.select(*C.KEY, distortion.distortion(at("a", 0), at("b", 0), at("a", 1), at("b", 1)).alias("t"))


@register("site_distortion", f"WITH {_T} SELECT * FROM tt", "t")
def _(t):
    return _distortions(t)


@register("distorted_levels", f"WITH {_T}, v AS (SELECT sample_id, chrom, context, pos, x * t AS v FROM l JOIN tt USING (chrom, context, pos)) SELECT sample_id, chrom, context, pos, v / greatest(sqrt(sum(v * v) OVER (PARTITION BY sample_id)), 1e-12) AS value FROM v", "value")
def _(t):
    levels = t.site_counts.where(C.coverage() > 0).select("sample_id", *C.KEY, C.level().alias("x"))
    return distortion.apply_distortion(levels, _distortions(t), C.KEY)


_EVIDENCE = """SELECT a.gene AS gene_a, b.gene AS gene_b, a.k % 7 AS source_run, CAST(a.k * 48271 % 1000 AS DOUBLE) AS observed_score, CASE WHEN a.k % 2 = 0 THEN 'module_copresence' ELSE 'edge' END AS evidence_type
FROM order_genes a JOIN order_genes b ON a.k = b.k AND a.gene <> b.gene WHERE (a.gene < b.gene) = (a.k % 3 > 0)"""


@register("edge_evidence", f"""WITH ev AS (SELECT least(gene_a, gene_b) AS gene_a, greatest(gene_a, gene_b) AS gene_b, source_run, observed_score, evidence_type FROM ({_EVIDENCE}) z),
g AS (SELECT gene_a, gene_b, count(*) AS occurrences, count(DISTINCT source_run) AS support_runs, avg(observed_score) AS mean_score, max(observed_score) AS max_score, count(*) FILTER (evidence_type = 'module_copresence') AS copresences FROM ev GROUP BY 1, 2),
s AS (SELECT *, least(greatest(0.5e0 * (support_runs / CAST((SELECT greatest(max(support_runs), 1) FROM g) AS DOUBLE)) + 0.3e0 * (least(greatest(mean_score, 0), 1000) / 1000) + 0.2e0 * (copresences / CAST((SELECT greatest(max(copresences), 1) FROM g) AS DOUBLE)), 0), 1) AS score FROM g),
k AS (SELECT src AS gene_a, dst AS gene_b, weight * 150.0e0 AS known_score FROM edges WHERE weight >= 2),
j AS (SELECT s.*, k.known_score IS NOT NULL AS in_known, coalesce(known_score, 0) AS known_score FROM s LEFT JOIN k USING (gene_a, gene_b)),
n AS (SELECT *, CASE WHEN NOT in_known THEN 'missing' WHEN known_score < 400 THEN 'known_below_threshold' ELSE 'known' END AS novelty FROM j)
SELECT *, CASE WHEN novelty = 'missing' AND score >= 0.55e0 THEN 'accepted_novel' WHEN score >= 0.7e0 THEN 'accepted_supported' ELSE 'candidate' END AS status FROM n""", "mean_score max_score score known_score")
def _(t):
    a, b = t.order_genes.alias("a"), t.order_genes.alias("b")
    k = F.col("a.k")
    pairs = a.join(b, (k == F.col("b.k")) & (F.col("a.gene") != F.col("b.gene"))).where((F.col("a.gene") < F.col("b.gene")) == (k % 3 > 0))
    evidence = pairs.select(F.col("a.gene").alias("gene_a"), F.col("b.gene").alias("gene_b"), (k % 7).alias("source_run"), (k * 48271 % 1000).cast("double").alias("observed_score"), F.when(k % 2 == 0, "module_copresence").otherwise("edge").alias("evidence_type"))
    known = t.edges.where("weight >= 2").select(F.col("src").alias("gene_a"), F.col("dst").alias("gene_b"), (F.col("weight") * 150.0).alias("score"))
    return edges.edge_evidence(evidence, known, 400.0)


@register("eval_bootstrap_metrics", f"""WITH s AS (SELECT y_true, count(*) AS n, count(*) FILTER (y_true = y_pred) AS good FROM predictions GROUP BY 1),
a AS (SELECT draw, y_true, count(*) FILTER ({_MIXED} % n < good) AS r FROM (SELECT y_true, n, good, unnest(generate_series(1, n)) AS i FROM s), generate_series(1, 1000) d(draw) GROUP BY 1, 2),
w AS (SELECT * FROM a UNION ALL SELECT 0 AS draw, y_true, good FROM s),
c AS (SELECT draw, sum(r) FILTER (y_true = 1) AS tp, sum(r) FILTER (y_true = 0) AS tn, (SELECT n FROM s WHERE y_true = 1) AS n1, (SELECT n FROM s WHERE y_true = 0) AS n0 FROM w GROUP BY 1),
m AS (SELECT draw, unnest(['accuracy', 'balanced_accuracy', 'sensitivity', 'specificity', 'f1', 'macro_f1']) AS metric, unnest([(tp + tn) / CAST(n1 + n0 AS DOUBLE), (tp / CAST(n1 AS DOUBLE) + tn / CAST(n0 AS DOUBLE)) / 2, tp / CAST(n1 AS DOUBLE), tn / CAST(n0 AS DOUBLE),
  2.0e0 * tp / (2 * tp + n0 - tn + n1 - tp), (2.0e0 * tp / (2 * tp + n0 - tn + n1 - tp) + 2.0e0 * tn / (2 * tn + n0 - tn + n1 - tp)) / 2]) AS v FROM c)
SELECT metric, max(v) FILTER (draw = 0) AS point, count(*) FILTER (draw > 0) AS n_valid, avg(v) FILTER (draw > 0) AS mean, stddev_pop(v) FILTER (draw > 0) AS sd,
quantile_cont(v, 0.025) FILTER (draw > 0) AS low, quantile_cont(v, 0.975) FILTER (draw > 0) AS high FROM m GROUP BY 1""", "point mean sd low high")
def _(t):
    return S.bootstrap_metrics(t.predictions, 1000)


@register("survival_time_auc", """WITH h AS (SELECT unnest([365.0e0, 1000.0e0, 2000.0e0, 99999.0e0]) AS horizon), s AS (SELECT horizon, risk, CASE WHEN time <= horizon THEN 1 ELSE 0 END AS y FROM survival, h WHERE (time <= horizon AND event > 0) OR time > horizon),
r AS (SELECT horizon, y, rank() OVER (PARTITION BY horizon ORDER BY risk) + (count(*) OVER (PARTITION BY horizon, risk) - 1) / 2.0e0 AS r FROM s),
g AS (SELECT horizon, count(*) FILTER (y = 1) AS n1, count(*) FILTER (y = 0) AS n0, sum(r) FILTER (y = 1) AS t FROM r GROUP BY 1)
SELECT horizon, coalesce(n1, 0) AS n1, coalesce(n0, 0) AS n0, CASE WHEN n1 > 0 AND n0 > 0 THEN (t - n1 * (n1 + 1) / 2.0e0) / (n1 * n0) END AS auc FROM h LEFT JOIN g USING (horizon)""", "horizon auc")
def _(t):
    return S.time_dependent_auc(t.survival, [365.0, 1000.0, 2000.0, 99999.0])


@register("survival_nested_test", None, "statistic p_value")
def _(t):
    rows = t.survival.select("time", "event", (F.col("risk") / 100000).alias("risk"), (F.col("id") % 5).cast("double").alias("other"))
    return M.nested_test(rows, ["risk", "other"], ["risk"])


_TX = "'T' || CAST(l_partkey % 40 AS VARCHAR) || CASE WHEN l_linenumber % 2 = 0 THEN '.1' ELSE '.2' END"


@register("file_gene_counts", f"SELECT CAST(l_suppkey AS VARCHAR) AS sample_id, CASE WHEN l_partkey % 40 < 30 THEN 'G' || CAST(l_partkey % 40 AS VARCHAR) ELSE {_TX} END AS gene, sum(l_quantity) AS count, sum(l_tax) AS tpm FROM lineitem GROUP BY 1, 2", "count tpm")
def _(t):
    """Transcript tables written one folder a sample, or together where samples are many, read again and added up to genes."""
    path = new_path(t.spark, "abundance")
    tx = F.concat(F.lit("T"), (F.col("l_partkey") % 40).cast("string"), F.when(F.col("l_linenumber") % 2 == 0, ".1").otherwise(".2"))
    rows = t.lineitem.select(F.col("l_suppkey").cast("string").alias("sample_id"), tx.alias("target_id"), F.lit(1000).alias("length"), F.lit(900).alias("eff_length"), F.col("l_quantity").alias("est_counts"), F.col("l_tax").alias("tpm"))
    expression.write_tables(rows, path)
    tx2gene = t.part.select((F.col("p_partkey") % 40).cast("string").alias("k")).distinct().where("cast(k as int) < 30").select(F.concat(F.lit("T"), "k").alias("tx"), F.concat(F.lit("G"), "k").alias("gene"))
    return expression.genes_of_transcripts(expression.read_abundance(t.spark, path), tx2gene)


@register("file_star_counts", "SELECT CAST(l_suppkey AS VARCHAR) AS sample_id, 'G' || CAST(l_partkey % 40 AS VARCHAR) AS gene, sum(l_linenumber) AS count FROM lineitem GROUP BY 1, 2", "count")
def _(t):
    path = new_path(t.spark, "star")
    genes = t.lineitem.select(F.col("l_suppkey").cast("string").alias("sample_id"), F.concat(F.lit("G"), (F.col("l_partkey") % 40).cast("string")).alias("gene"), F.col("l_quantity").alias("a"), F.col("l_linenumber").alias("b"), F.lit(0).alias("c"))
    head = genes.select("sample_id").distinct().select("sample_id", F.explode(F.array(*[F.lit(n) for n in ("N_unmapped", "N_multimapping", "N_noFeature", "N_ambiguous")])).alias("gene"), *[F.lit(7).alias(c) for c in "abc"])
    expression.write_tables(head.unionByName(genes), path, header=False)
    return expression.read_star_counts(t.spark, path, 1)


@register("file_peptides", "SELECT CAST(l_suppkey AS VARCHAR) AS sample_id, 'P' || CAST(l_partkey % 30 AS VARCHAR) AS protein, sum(l_quantity + l_discount) AS intensity FROM lineitem GROUP BY 1, 2", "intensity")
def _(t):
    path = new_path(t.spark, "peptides")
    rows = t.lineitem.select(F.col("l_suppkey").cast("string").alias("sample_id"), F.col("l_orderkey").cast("string").alias("peptide"), F.lit(2).alias("charge"), F.concat(F.lit("P"), (F.col("l_partkey") % 30).cast("string")).alias("proteins"), F.col("l_quantity").alias("run1.mzML"), F.col("l_discount").alias("run2.mzML"))
    expression.write_tables(rows, path)
    return expression.read_peptide_table(t.spark, path)


@register("file_panel_matrix", "SELECT sample_id, feature_id, value FROM features WHERE value IS NOT NULL", "value")
def _(t):
    """Brand totals as a wide matrix of all samples, read back."""
    path = new_path(t.spark, "matrix")
    brands = [r.feature_id for r in t.features.select("feature_id").distinct().orderBy("feature_id").collect()]
    t.features.groupBy(F.col("sample_id").alias("SampleID")).pivot("feature_id", brands).agg(F.sum("value")).write.csv(path, header=True, sep="\t")
    return expression.read_panel_matrix(t.spark, path)
