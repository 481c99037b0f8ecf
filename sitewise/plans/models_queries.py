"""Queries of models, fusion, pair distances and file formats."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import centroid as C
from ..operators import models as M
from ..operators import samples as S
from ..shared import new_path
from ..sources import files
from .registry import register


@register("fuse_geometric", "SELECT l_orderkey AS id, exp(avg(ln(greatest(l_discount * 10, 1e-12)))) AS p, count(*) AS n_experts FROM lineitem GROUP BY 1", "p")
def _(t):
    return M.geometric_mean(t.lineitem.select(F.col("l_orderkey").alias("id"), (F.col("l_discount") * 10).alias("p")), ["id"])


@register("fuse_weighted", "SELECT l_orderkey AS id, CASE WHEN sum(l_tax) > 0 THEN sum(l_discount * l_tax) / sum(l_tax) ELSE avg(l_discount) END AS p FROM lineitem GROUP BY 1", "p")
def _(t):
    return M.weighted_mean(t.lineitem.withColumnRenamed("l_orderkey", "id"), ["id"], "l_discount", "l_tax")


@register("fuse_blocks", """WITH b AS (SELECT l_suppkey AS sample_id, (l_partkey % 60) // 6 AS block, count(*) AS n, sum(sqrt(l_quantity) * l_discount) / sum(sqrt(l_quantity)) AS m FROM lineitem GROUP BY 1, 2)
SELECT sample_id, count(*) AS n_blocks, avg(m * n / (n + 1.0e0)) AS score FROM b GROUP BY 1""", "score")
def _(t):
    s = t.lineitem.select(F.col("l_suppkey").alias("sample_id"), (F.col("l_partkey") % 60).alias("rank"), F.col("l_quantity").alias("w"), F.col("l_discount").alias("score"))
    return M.block_mean(s, 6)


_X = "x AS (SELECT sample_id, chrom, context, pos, CASE WHEN mC + uC > 0 THEN mC / CAST(mC + uC AS DOUBLE) ELSE 0 END AS x FROM site_counts)"
_D = f"WITH {_X}, d AS (SELECT a.sample_id AS a, b.sample_id AS b, count(*) AS n_common, avg(abs(a.x - b.x)) AS distance FROM x a JOIN x b USING (chrom, context, pos) WHERE a.sample_id < b.sample_id GROUP BY 1, 2)"


def distances(t):
    c = t.site_counts.select("sample_id", *C.KEY, C.level().alias("x"))
    return M.pair_distances(c, C.KEY)


@register("pair_distances", _D + " SELECT * FROM d", "distance")
def _(t):
    return distances(t)


_BOTH = ", e AS (SELECT a AS s, b AS o, distance FROM d UNION ALL SELECT b, a, distance FROM d)"


@register("medoid_assignment", _D + _BOTH + """, m AS (SELECT s, o AS m, distance FROM e WHERE o IN ('1', '2', '3') UNION ALL SELECT DISTINCT s, s, 0 FROM e WHERE s IN ('1', '2', '3')),
k AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY distance, m) AS k FROM m) SELECT s AS sample_id, m AS medoid, distance FROM k WHERE k = 1""", "distance")
def _(t):
    return M.assign_medoids(distances(t), ["1", "2", "3"])


@register("pair_distance_statistics", _D + " SELECT count(*) AS n, avg(distance) AS mean, stddev_samp(distance) AS sd, min(distance) AS min, max(distance) AS max, quantile_cont(distance, 0.25) AS q25, quantile_cont(distance, 0.5) AS q50, quantile_cont(distance, 0.75) AS q75 FROM d", "mean sd min max q25 q50 q75")
def _(t):
    return M.distance_statistics(distances(t))


@register("medoid_clusters", rounds="distance")
def _(t):
    return M.k_medoids(distances(t), 3)


@register("pair_silhouette", _D + _BOTH + """, m AS (SELECT s, CAST(s AS BIGINT) % 2 AS ls, CAST(o AS BIGINT) % 2 AS lo, avg(distance) AS d FROM e GROUP BY 1, 2, 3), g AS (SELECT s, min(d) FILTER (ls = lo) AS i, min(d) FILTER (ls <> lo) AS o FROM m GROUP BY 1)
SELECT s AS sample_id, CASE WHEN i IS NULL OR o IS NULL THEN 0 ELSE (o - i) / greatest(i, o) END AS silhouette FROM g""", "silhouette")
def _(t):
    labels = t.site_counts.select("sample_id", (F.col("sample_id").cast("long") % 2).alias("label")).distinct()
    return M.silhouette(distances(t), labels)


@register("survival_concordance", "SELECT sum(CASE WHEN b.risk < a.risk THEN 1.0e0 WHEN b.risk = a.risk THEN 0.5 ELSE 0 END) / count(*) AS c_index, count(*) AS n_pairs FROM survival a JOIN survival b ON b.time > a.time WHERE a.event = 1", "c_index")
def _(t):
    return M.concordance(t.survival)


@register("survival_cox")
def _(t):
    rows = t.survival.select("time", "event", (F.col("risk") / 100000).alias("risk"), (F.col("id") % 5).cast("double").alias("other"))
    beta, value = M.cox_fit(rows, ["risk", "other"])
    return rows.agg(F.count("*").alias("n")).select("n", F.lit(float(beta[0])).alias("beta_risk"), F.lit(float(beta[1])).alias("beta_other"), F.lit(value).alias("log_likelihood"))


@register("deconvolution")
def _(t):
    means = t.site_counts.withColumn("third", F.col("sample_id").cast("long") % 3).groupBy(*C.KEY).pivot("third", [0, 1, 2]).agg(F.avg(C.level())).na.drop()
    basis = means.select(*C.KEY, *[F.col(str(k)).alias(f"part{k}") for k in range(3)])
    return M.deconvolve(t.site_counts.select("sample_id", *C.KEY, C.level().alias("x")), basis, ["part0", "part1", "part2"])


def _tabular(t):
    rows = t.predictions.join(t.survival.select("id", (F.col("risk") / 1e5).alias("risk"), "time"), "id").withColumn("time", F.col("time").cast("double"))
    data = M.assemble(rows, ["p1", "risk", "time"], "y_true")
    return data.where("id % 10 < 7"), data.where("id % 10 >= 7")


@register("model_logistic")
def _(t):
    return M.logistic(*_tabular(t)).select("id", "label", "p1")


@register("model_compare")
def _(t):
    return M.compare_classifiers(*_tabular(t))


@register("model_calibrate")
def _(t):
    return M.calibrate(t.predictions, F.col("id") % 2 == 0)


@register("model_latent_gaussian")
def _(t):
    return M.latent_gaussian(*_tabular(t), 2)


@register("model_strata")
def _(t):
    wide = t.composition.groupBy(F.col("sample_id")).pivot("part", ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]).agg(F.first("share")).na.fill(0.0)
    return M.strata(M.assemble(wide, ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]), [2, 3, 4])


@register("file_gtf", "SELECT chrom, region_start, region_end, strand, gene_id, gene_id || '.1' AS transcript_id FROM regions WHERE feature_type = 'exon'")
def _(t):
    path = new_path(t.spark, "gtf")
    files.write_gtf(t.regions, path)
    return files.read_gtf(t.spark, path)


@register("file_bed", "SELECT chrom, region_start, region_end, gene_id || '|' || feature_type AS name FROM regions")
def _(t):
    path = new_path(t.spark, "bed")
    files.write_bed(t.regions.select("chrom", "region_start", "region_end", F.concat_ws("|", "gene_id", "feature_type").alias("name")), path)
    return files.read_bed(t.spark, path)


@register("file_gmt", "SELECT DISTINCT term, library AS description, gene FROM gene_sets")
def _(t):
    path = new_path(t.spark, "gmt")
    files.write_gmt(t.gene_sets.select("term", F.col("library").alias("description"), "gene"), path)
    return files.read_gmt(t.spark, path)


@register("file_sites_csv", "SELECT run_id, chrom, pos, p_value, delta_mean, abs(delta_mean) AS effect_size FROM runs", "p_value delta_mean effect_size")
def _(t):
    path = new_path(t.spark, "csv")
    t.runs.select("run_id", F.col("chrom").alias("chromosome"), F.col("pos").alias("position"), F.col("p_value").alias("pvalue"), F.col("delta_mean").alias("delta")).write.csv(path, header=True)
    return files.read_sites_csv(t.spark, path, ("run_id",))


@register("locus_parse", "SELECT DISTINCT chrom, pos, context FROM site_counts")
def _(t):
    names = t.site_counts.select(F.concat_ws(":", "chrom", F.col("pos").cast("string"), "context", F.lit("eff=0.1")).alias("name")).distinct()
    c, p, x = files.parse_locus(F.col("name"))
    return names.select(c.alias("chrom"), p.alias("pos"), x.alias("context"))


@register("json_metrics", "SELECT sample_id, metric, value FROM qc_metrics", "value")
def _(t):
    packed = t.qc_metrics.groupBy("sample_id").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("metric", "value")))).alias("j"))
    return files.flatten_json(packed, "sample_id", "j")


@register("tile_divergence_top", rounds="jsd")
def _(t):
    return S.tile_divergence(S.tile_patterns(t.read_cpgs), F.col("sample_id").cast("long") % 2).orderBy(F.desc("jsd"), "tile").limit(5)
