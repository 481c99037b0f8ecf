"""Queries of interval joins and annotation."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import intervals as I
from .registry import register


@register("interval_overlap", "SELECT s.chrom, s.pos, r.gene_id, r.feature_type, r.region_start, r.region_end FROM sites s JOIN regions r ON s.chrom = r.chrom AND s.pos >= r.region_start AND s.pos < r.region_end")
def _(t):
    return I.overlap(t.sites, t.regions).select("chrom", "pos", "gene_id", "feature_type", "region_start", "region_end")


@register("interval_labels", """SELECT s.chrom, s.pos, coalesce(string_agg(DISTINCT r.feature_type, ';' ORDER BY r.feature_type), '') AS labels, count(r.gene_id) AS n_hits
FROM sites s LEFT JOIN regions r ON s.chrom = r.chrom AND s.pos >= r.region_start AND s.pos < r.region_end GROUP BY 1, 2""")
def _(t):
    return I.label_hits(t.sites, t.regions, "feature_type")


_PROBE = "SELECT DISTINCT CAST(1 + l_orderkey % 3 AS STRING) AS chrom, CAST(l_orderkey % 20000 AS BIGINT) AS pos FROM lineitem"


@register("interval_nearest", f"""WITH q AS ({_PROBE.replace('STRING', 'VARCHAR')}), g AS (SELECT DISTINCT chrom, gene_id, region_start, region_end FROM regions WHERE feature_type = 'exon'),
d AS (SELECT q.chrom, q.pos, gene_id, CASE WHEN pos >= region_start AND pos < region_end THEN 0 WHEN pos < region_start THEN region_start - pos ELSE -(pos - region_end + 1) END AS d FROM q JOIN g ON q.chrom = g.chrom),
k AS (SELECT *, row_number() OVER (PARTITION BY chrom, pos ORDER BY abs(d), gene_id) AS k FROM d) SELECT chrom, pos, gene_id, CAST(d AS BIGINT) AS distance FROM k WHERE k = 1""")
def _(t):
    probe = t.lineitem.select((1 + F.col("l_orderkey") % 3).cast("string").alias("chrom"), (F.col("l_orderkey") % 20000).alias("pos")).distinct()
    return I.nearest(probe, t.regions.where("feature_type = 'exon'").select("chrom", "gene_id", "region_start", "region_end"))


@register("interval_within", "SELECT s.chrom, s.pos, g.gene_start AS pos_b, g.g FROM sites s JOIN genes g ON s.chrom = g.chrom AND abs(s.pos - g.gene_start) <= 30")
def _(t):
    return I.within(t.sites, t.genes.select("chrom", F.col("gene_start").alias("pos_b"), "g"), 30)


@register("interval_introns", """SELECT chrom, gene_id, intron_start, intron_end FROM (SELECT chrom, gene_id, region_end AS intron_start, lead(region_start) OVER (PARTITION BY chrom, gene_id ORDER BY region_start) AS intron_end
FROM regions WHERE feature_type = 'exon') WHERE intron_end - intron_start >= 1""")
def _(t):
    return I.introns(t.regions.where("feature_type = 'exon'"))


_HITS = "h AS (SELECT s.chrom, s.pos, r.gene_id, r.feature_type, r.region_start, r.region_end FROM sites s JOIN regions r ON s.chrom = r.chrom AND s.pos >= r.region_start AND s.pos < r.region_end)"
_PRIO = "CASE feature_type WHEN 'promoter' THEN 1 WHEN 'exon' THEN 2 WHEN 'intron' THEN 3 WHEN 'gene_body' THEN 4 ELSE 5 END"
_ONE = f"WITH {_HITS}, x AS (SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY chrom, pos, gene_id ORDER BY {_PRIO}, region_start, region_end) AS k FROM h) WHERE k = 1)"


def exclusive(t):
    return I.exclusive_features(I.overlap(t.sites, t.regions).select("chrom", "pos", "gene_id", "feature_type", "region_start", "region_end"), ["chrom", "pos", "gene_id"])


@register("annotate_exclusive", _ONE + " SELECT * FROM x")
def _(t):
    return exclusive(t)


@register("annotate_feature_hits", _ONE + """ SELECT gene_id, count(*) FILTER (feature_type = 'promoter') AS promoter, count(*) FILTER (feature_type = 'exon') AS exon, count(*) FILTER (feature_type = 'intron') AS intron,
count(*) FILTER (feature_type = 'gene_body') AS gene_body, count(*) FILTER (feature_type = 'terminator') AS terminator FROM x GROUP BY gene_id""")
def _(t):
    return exclusive(t).groupBy("gene_id").pivot("feature_type", list(I.PRIORITY)).count().na.fill(0)


@register("annotate_best", f"WITH {_HITS} SELECT chrom, pos, gene_id, feature_type FROM (SELECT *, row_number() OVER (PARTITION BY chrom, pos ORDER BY {_PRIO}, region_end - region_start, gene_id, region_start) AS k FROM h) WHERE k = 1")
def _(t):
    h = I.overlap(t.sites, t.regions)
    rank = F.array_position(F.array(*[F.lit(p) for p in I.PRIORITY]), F.col("feature_type"))
    k = F.row_number().over(Window.partitionBy("chrom", "pos").orderBy(rank, F.col("region_end") - F.col("region_start"), "gene_id", "region_start"))
    return h.withColumn("k", k).where("k = 1").select("chrom", "pos", "gene_id", "feature_type")


@register("annotate_unmatched", "SELECT s.chrom, s.pos FROM sites s WHERE NOT EXISTS (SELECT 1 FROM regions r WHERE r.feature_type = 'exon' AND r.chrom = s.chrom AND s.pos >= r.region_start AND s.pos < r.region_end)")
def _(t):
    hit = I.overlap(t.sites, t.regions.where("feature_type = 'exon'")).select("chrom", "pos").distinct()
    return t.sites.join(hit, ["chrom", "pos"], "left_anti")


@register("chrom_names", "SELECT DISTINCT chrom, 'chr' || chrom AS name FROM sites")
def _(t):
    return t.sites.select("chrom", I.chrom_name(F.col("chrom")).alias("name")).distinct()


@register("pmd_load", """WITH l AS (SELECT sample_id, chrom, pos, CASE WHEN mC + uC > 0 THEN mC / CAST(mC + uC AS DOUBLE) ELSE 0 END AS x FROM site_counts WHERE mC + uC >= 5),
w AS (SELECT *, unnest(generate_series(greatest(CAST(floor((pos - 1000) / 500.0e0) AS BIGINT) + 1, 0), pos // 500)) * 500 AS window_start FROM l),
g AS (SELECT sample_id, chrom, window_start, avg(x) AS m FROM w GROUP BY ALL)
SELECT sample_id, count(*) AS n_windows, count(*) FILTER (m < 0.5) AS n_pmd, count(*) FILTER (m < 0.5) / CAST(count(*) AS DOUBLE) AS pmd_load FROM g GROUP BY sample_id""", "pmd_load")
def _(t):
    from ..operators import centroid as C

    rows = t.site_counts.where(C.coverage() >= 5).select("sample_id", "chrom", "pos", C.level().alias("x"))
    # A mean of one half whose last bits depend on the order of the sum is not below it.
    means = I.windows(rows, 1000, 500).groupBy("sample_id", "chrom", "window_start").agg(F.avg("x").alias("m"))
    return means.groupBy("sample_id").agg(F.count("*").alias("n_windows"), F.count_if(F.col("m") < 0.5 - 1e-12).alias("n_pmd")).withColumn("pmd_load", F.col("n_pmd") / F.col("n_windows"))
