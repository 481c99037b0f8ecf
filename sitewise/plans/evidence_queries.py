"""Queries of thinned coverage, panel checks, association thresholds, merged enrichment and module scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import centroid as C
from ..operators import evidence as E
from .detect_queries import _Q, dmp
from .enrichment_queries import _W, ORA, ora
from .registry import register


@register("coverage_thin")
def _(t):
    return E.thin_coverage(t.site_counts, 20, 7).select("sample_id", *C.KEY, "mC", "uC")


@register("panel_qc", """WITH r AS (SELECT chrom, region_start, region_end, CASE feature_type WHEN 'exon' THEN 'target' WHEN 'promoter' THEN 'positive' ELSE 'negative' END AS kind FROM regions WHERE feature_type IN ('exon', 'promoter', 'terminator')),
k AS (SELECT s.chrom, s.pos, bool_or(kind = 'target') AS a, bool_or(kind = 'positive') AS b, bool_or(kind = 'negative') AS c FROM sites s JOIN r ON s.chrom = r.chrom AND s.pos >= region_start AND s.pos < region_end GROUP BY 1, 2),
j AS (SELECT sample_id, mC + uC AS cov, mC / CAST(nullif(mC + uC, 0) AS DOUBLE) AS x, coalesce(a, FALSE) AS a, coalesce(b, FALSE) AS b, coalesce(c, FALSE) AS c FROM site_counts LEFT JOIN k USING (chrom, pos))
SELECT sample_id, count(*) AS n_sites, count(*) FILTER (a) AS n_on_target, avg(cov) FILTER (a) AS on_target_mean_coverage, quantile_cont(CAST(cov AS DOUBLE), 0.5) FILTER (a) AS on_target_median_coverage,
avg(x) FILTER (b) AS positive_level, avg(x) FILTER (c) AS negative_level, count(*) FILTER (a) / CAST(count(*) AS DOUBLE) AS on_target_fraction FROM j GROUP BY 1""",
    "on_target_mean_coverage on_target_median_coverage positive_level negative_level on_target_fraction")
def _(t):
    kind = F.when(F.col("feature_type") == "exon", "target").when(F.col("feature_type") == "promoter", "positive").otherwise("negative")
    return E.panel_qc(t.site_counts, t.regions.where("feature_type in ('exon', 'promoter', 'terminator')").withColumn("kind", kind))


@register("panel_merge_stable", """WITH p AS (SELECT run_id % 2 AS part, chrom, pos, count(DISTINCT run_id) AS frequency, round(max(effect_size), 9) AS effect_size FROM runs GROUP BY 1, 2, 3)
SELECT chrom, pos, part, frequency, effect_size FROM (SELECT *, row_number() OVER (PARTITION BY chrom, pos ORDER BY frequency DESC, effect_size DESC, part DESC) AS k FROM p) WHERE k = 1""", "effect_size")
def _(t):
    panels = t.runs.groupBy((F.col("run_id") % 2).alias("part"), "chrom", "pos").agg(F.countDistinct("run_id").alias("frequency"), F.round(F.max("effect_size"), 9).alias("effect_size"))
    return E.merge_stable(panels, ["chrom", "pos"]).select("chrom", "pos", "part", "frequency", "effect_size")


@register("panel_partition_coverage", """WITH l AS (SELECT DISTINCT chrom, context, pos, cohort AS label FROM site_counts), f AS (SELECT DISTINCT s.chrom, context, pos, feature_type FROM (SELECT DISTINCT chrom, context, pos FROM site_counts) s JOIN regions r ON s.chrom = r.chrom AND pos >= region_start AND pos < region_end),
j AS (SELECT l.*, feature_type FROM l LEFT JOIN f USING (chrom, context, pos)), p AS (SELECT label, feature_type AS region, count(DISTINCT (chrom, context, pos)) AS n_loci FROM j WHERE feature_type IN ('promoter', 'exon') GROUP BY 1, 2),
w AS (SELECT NULL AS label, NULL AS region, count(DISTINCT (chrom, context, pos)) AS n_loci FROM j WHERE feature_type IN ('promoter', 'exon')) SELECT *, n_loci >= 100 AS enough FROM (SELECT * FROM p UNION ALL SELECT * FROM w)""")
def _(t):
    features = E.overlap(t.site_counts.select(*C.KEY).distinct(), t.regions.select("chrom", "region_start", "region_end", "feature_type"))
    return E.partition_coverage(t.site_counts.withColumnRenamed("cohort", "label"), features, ["promoter", "exon"], 100)


@register("signature_overlap", """WITH a AS (SELECT DISTINCT gene FROM gene_sets WHERE term = 'Brand#1'), b AS (SELECT DISTINCT gene FROM gene_sets WHERE term = 'Brand#2'), s AS (SELECT DISTINCT library || ':' || term AS panel, gene FROM gene_sets),
g AS (SELECT panel, count(*) AS n_selected, count(a.gene) AS n_a, count(b.gene) AS n_b FROM s LEFT JOIN a USING (gene) LEFT JOIN b USING (gene) GROUP BY 1), z AS (SELECT *, n_a / CAST((SELECT count(*) FROM a) AS DOUBLE) AS share_a, n_b / CAST((SELECT count(*) FROM b) AS DOUBLE) AS share_b FROM g)
SELECT *, CASE WHEN share_a > share_b THEN 'Brand#1' WHEN share_b > share_a THEN 'Brand#2' ELSE 'tie' END AS dominant FROM z""", "share_a share_b")
def _(t):
    selected = t.gene_sets.select(F.concat_ws(":", "library", "term").alias("panel"), "gene")
    return E.signature_overlap(selected, t.gene_sets.withColumnRenamed("term", "signature"), "Brand#1", "Brand#2")


_ASSOCIATIONS = """SELECT concat(CAST(1 + l_partkey % 3 AS STRING), '-', CAST(CAST(floor(floor(l_partkey / 3) / 10) AS BIGINT) AS STRING)) AS gene, l_quantity > 5 AS associated,
CASE WHEN l_tax > 0.055E0 THEN 'predicted' ELSE 'known' END AS association_type, CASE CAST(l_quantity AS BIGINT) % 4 WHEN 0 THEN 'none' WHEN 1 THEN 'low' WHEN 2 THEN 'Medium' ELSE 'high' END AS evidence_level,
CASE WHEN l_linenumber < 7 THEN l_linenumber - 1 END AS publications, CASE l_orderkey % 3 WHEN 0 THEN 'disgenet' WHEN 1 THEN 'open_targets' ELSE 'other' END AS source, l_discount * 10 + 0.005E0 AS score FROM lineitem"""


@register("association_profiles", f"""WITH a AS (SELECT *, CASE lower(evidence_level) WHEN 'high' THEN 3 WHEN 'medium' THEN 2 WHEN 'low' THEN 1 ELSE 0 END AS r FROM ({_ASSOCIATIONS}) x WHERE associated)
SELECT gene, {', '.join(f"count(*) FILTER (r >= {E.LEVELS[v[0]]} AND coalesce(publications, 0) >= {v[1]} AND NOT (source = 'disgenet' AND score < {v[2]}) AND NOT (source = 'open_targets' AND score < {v[3]}) AND ({v[4]} OR association_type <> 'predicted')) AS {n}" for n, v in E.PROFILES.items())} FROM a GROUP BY 1""")
def _(t):
    a = t.spark.sql(_ASSOCIATIONS.replace("FROM lineitem", "FROM {lineitem}"), lineitem=t.lineitem).where("associated")
    return a.groupBy("gene").agg(*[F.count_if(E.meets(n)).alias(n) for n in E.PROFILES])


@register("dmp_training_filter", _Q + " SELECT chrom, context, pos, effect_size FROM q WHERE q_value <= 0.2 AND abs(delta_mean) >= 0.05 AND overlap <= 0.95 ORDER BY round(effect_size, 9) DESC, chrom, context, pos LIMIT 100", "effect_size")
def _(t):
    limits = {"max_q_value": 0.2, "min_delta_mean": 0.05, "max_overlap": 0.95, "min_auc": 0.5}
    return E.select_sites(dmp(t), limits, 100, "effect_size").select(*C.KEY, "effect_size")  # the cap is the feature


_MERGED = f"""o AS ({ORA}), s AS (SELECT *, CAST(library = 'brand' AS INTEGER) AS block, -ln(greatest(p_value, 5e-324)) * odds_ratio AS combined_score FROM o)"""


@register("enrich_merge_libraries", f"WITH {_MERGED} SELECT library, term, p_value, q_value, odds_ratio, combined_score, block, row_number() OVER (PARTITION BY block ORDER BY round(q_value, 9), round(p_value, 9), round(odds_ratio, 9) DESC, library, term) AS place FROM s",
          "p_value q_value odds_ratio combined_score")
def _(t):
    return E.merge_libraries(ora(t), ["brand"]).select("library", "term", "p_value", "q_value", "odds_ratio", "combined_score", "block", "place")


@register("module_scores", f"""WITH {_MERGED}, {_W}, m AS (SELECT DISTINCT length(term) % 5 AS module, term FROM gene_sets), v AS (SELECT term, avg(w) AS a FROM gene_sets JOIN w USING (gene) GROUP BY 1),
t AS (SELECT module, count(*) AS n_terms, avg(-log10(greatest(q_value, 1e-10))) AS activity_log10q, avg(combined_score) AS activity_combined, avg(coalesce(a, 0)) AS activity_overlap FROM m JOIN s USING (term) LEFT JOIN v USING (term) GROUP BY 1),
x AS (SELECT DISTINCT module, gene FROM m JOIN gene_sets USING (term)), g AS (SELECT module, count(*) AS n_genes, avg(coalesce(w / 4, 1)) AS mw, avg(abs(coalesce(w - 1, 0))) AS activity_gene FROM x LEFT JOIN w USING (gene) GROUP BY 1)
SELECT module, n_terms, n_genes, least(0.35e0 * least(activity_log10q / 10, 1) + 0.15e0 * least(n_terms / 50.0e0, 1) + 0.15e0 * least(n_genes / 200.0e0, 1) + 0.15e0 * least(mw, 1) + 0.2e0 * least(activity_overlap, 1), 1) AS score, activity_log10q, activity_combined, activity_overlap, activity_gene FROM t JOIN g USING (module)""",
    "score activity_log10q activity_combined activity_overlap activity_gene")
def _(t):
    modules = t.gene_sets.select((F.length("term") % 5).cast("long").alias("module"), "term")
    w = t.stages.groupBy(F.col("entity").alias("gene")).agg((F.avg("score") / 1e6).alias("w"))
    over = t.gene_sets.join(w, "gene").groupBy("term").agg(F.avg("w").alias("overlap_abs"))
    terms = E.merge_libraries(ora(t), ["brand"]).select("term", "q_value", "combined_score").join(over, "term", "left")
    return E.module_scores(modules, terms, t.gene_sets.select("term", "gene"), w.select("gene", (F.col("w") / 4).alias("w"), (F.col("w") - 1).alias("effect")))


_MV = f"""SELECT chrom, context, pos, avg({{x}}) FILTER (cohort = 'disease') AS mean1, avg({{x}}) FILTER (cohort = 'control') AS mean2, var_samp({{x}}) FILTER (cohort = 'disease') AS var1, var_samp({{x}}) FILTER (cohort = 'control') AS var2 FROM site_counts GROUP BY 1, 2, 3""".replace("{x}", "CASE WHEN mC + uC > 0 THEN mC / CAST(mC + uC AS DOUBLE) ELSE 0 END")


@register("overlap_normal", f"SELECT chrom, context, pos, exp(-((mean1 - mean2) ** 2) / greatest(4 * (var1 + var2), 1e-12)) AS overlap_normal FROM ({_MV}) WHERE var1 IS NOT NULL AND var2 IS NOT NULL", "overlap_normal")
def _(t):
    side = lambda f, c: f(F.when(F.col("cohort") == c, C.level()))
    pairs = t.site_counts.groupBy(*C.KEY).agg(side(F.avg, "disease").alias("mean1"), side(F.avg, "control").alias("mean2"), side(F.var_samp, "disease").alias("var1"), side(F.var_samp, "control").alias("var2"))
    return E.normal_overlap(pairs.na.drop(subset=["var1", "var2"])).select(*C.KEY, "overlap_normal")


@register("sample_log_probability", """WITH b AS (SELECT chrom, context, pos, k, count(*) AS c FROM (SELECT *, least(CASE WHEN mC + uC > 0 THEN mC * 20 // (mC + uC) ELSE 0 END, 19) AS k FROM site_counts WHERE cohort = 'control') GROUP BY 1, 2, 3, 4), n AS (SELECT chrom, context, pos, sum(c) AS n FROM b GROUP BY 1, 2, 3),
j AS (SELECT sample_id, chrom, context, pos, CAST(least(CASE WHEN mC + uC > 0 THEN mC * 20 // (mC + uC) ELSE 10 END, 19) AS BIGINT) AS k FROM site_counts)
SELECT sample_id, count(*) AS n_sites, sum(ln(greatest(coalesce(c, 0) * 20.0e0 / n, 1e-12))) AS log_p FROM j JOIN n USING (chrom, context, pos) LEFT JOIN b USING (chrom, context, pos, k) GROUP BY 1""", "log_p")
def _(t):
    return E.log_probability(t.site_counts, C.build(t.site_counts.where("cohort = 'control'")))
