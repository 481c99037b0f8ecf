"""Interval joins on genomic coordinates, 0-based and half-open."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed order in which one feature is chosen per gene and site.
PRIORITY = ("promoter", "exon", "intron", "gene_body", "terminator")


def chrom_name(c: Column) -> Column:
    """Lower-case name with the ``chr`` prefix."""
    low = F.lower(F.trim(c))
    return F.when(low.startswith("chr"), low).otherwise(F.concat(F.lit("chr"), low))


def overlap(sites: DataFrame, regions: DataFrame, bin_size: int = 64, how: str = "inner") -> DataFrame:
    """Pairs of site and region with start <= pos < end.

    Regions are listed once per bin they touch and joined on (chrom, bin); a position is in
    one bin, so no pair appears twice. ``bin_size`` should be near the usual region length.
    """
    tiles = regions.withColumn("__bin", F.explode(F.sequence(F.floor(F.col("region_start") / bin_size), F.floor((F.greatest("region_end", F.col("region_start") + 1) - 1) / bin_size))))
    points = sites.withColumn("__bin", F.floor(F.col("pos") / bin_size))
    a, b = points.alias("__s"), tiles.alias("__r")
    on = (F.col("__s.chrom") == F.col("__r.chrom")) & (F.col("__s.__bin") == F.col("__r.__bin")) & (F.col("pos") >= F.col("region_start")) & (F.col("pos") < F.col("region_end"))
    return a.join(b, on, how).select("__s.*", *[F.col(f"__r.`{c}`") for c in regions.columns if c not in sites.columns]).drop("__bin")


def label_hits(sites: DataFrame, track: DataFrame, label: str, bin_size: int = 64) -> DataFrame:
    """Each site with the sorted labels and number of track rows over it; none gives empty and 0."""
    hits = overlap(sites.select("chrom", "pos").distinct(), track, bin_size).groupBy("chrom", "pos").agg(
        F.array_join(F.array_sort(F.collect_set(label)), ";").alias("labels"), F.count("*").alias("n_hits"))
    return sites.join(hits, ["chrom", "pos"], "left").withColumns({"labels": F.coalesce("labels", F.lit("")), "n_hits": F.coalesce("n_hits", F.lit(0))})


def nearest(sites: DataFrame, regions: DataFrame, span: int = 1 << 16, bin_size: int = 64) -> DataFrame:
    """Each site with the nearest region of its chromosome and the signed distance; ties to the smaller id.

    Regions are disjoint by assumption of the look-around, else overlaps win with distance 0.
    Per window of ``span`` positions the last end before it and first start after it are
    carried over from a small table, so no window function runs over a whole chromosome.
    """
    ends = regions.select("chrom", F.col("region_end").alias("at"), F.struct(F.col("region_end").alias("e"), F.col("gene_id").alias("id")).alias("left"))
    starts = regions.select("chrom", F.col("region_start").alias("at"), F.struct(F.col("region_start").alias("s"), F.col("gene_id").alias("id")).alias("right"))
    marks = ends.groupBy("chrom", "at").agg(F.struct(F.first("at").alias("e"), F.min("left.id").alias("id")).alias("left")).unionByName(
        starts.groupBy("chrom", "at").agg(F.struct(F.first("at").alias("s"), F.min("right.id").alias("id")).alias("right")), allowMissingColumns=True)
    points = sites.select("chrom", F.col("pos").alias("at")).distinct().withColumn("is_site", F.lit(True))
    rows = marks.unionByName(points, allowMissingColumns=True).withColumn("cell", F.floor(F.col("at") / span))
    # A region's end e is left of pos when e <= pos; its start s is right of pos when s > pos.
    order = Window.partitionBy("chrom", "cell").orderBy("at", F.col("is_site").isNotNull())
    back = Window.partitionBy("chrom", "cell").orderBy(F.desc("at"), F.desc(F.col("is_site").isNotNull()))
    rows = rows.withColumn("l", F.last("left", True).over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn(
        "r", F.last("right", True).over(back.rowsBetween(Window.unboundedPreceding, 0)))
    cells = rows.groupBy("chrom", "cell").agg(F.max("left").alias("cl"), F.min("right").alias("cr"))
    ups, downs = (Window.partitionBy("chrom").orderBy(o).rowsBetween(Window.unboundedPreceding, -1) for o in (F.asc("cell"), F.desc("cell")))
    cells = cells.select("chrom", "cell", F.last("cl", True).over(ups).alias("cl"), F.last("cr", True).over(downs).alias("cr"))
    found = rows.where("is_site").join(cells, ["chrom", "cell"]).select("chrom", F.col("at").alias("pos"), F.coalesce("l", "cl").alias("l"), F.coalesce("r", "cr").alias("r"))
    inside = overlap(sites.select("chrom", "pos").distinct(), regions.select("chrom", "region_start", "region_end", "gene_id"), bin_size).groupBy("chrom", "pos").agg(F.min("gene_id").alias("over"))
    dl, dr = F.col("pos") - F.col("l.e") + 1, F.col("r.s") - F.col("pos")
    return found.join(inside, ["chrom", "pos"], "left").select(
        "chrom", "pos",
        F.when(F.col("over").isNotNull(), F.col("over")).when(dr.isNull() | (dl < dr) | ((dl == dr) & (F.col("l.id") < F.col("r.id"))), F.col("l.id")).otherwise(F.col("r.id")).alias("gene_id"),
        F.when(F.col("over").isNotNull(), F.lit(0)).when(dr.isNull() | (dl < dr) | ((dl == dr) & (F.col("l.id") < F.col("r.id"))), -dl).otherwise(dr).alias("distance"))


def within(a: DataFrame, b: DataFrame, distance: int) -> DataFrame:
    """Pairs of rows (chrom, pos) and (chrom, pos_b) at most ``distance`` apart: join on this and both next bins."""
    width = distance + 1
    left = a.withColumn("__bin", F.explode(F.array(*[F.floor(F.col("pos") / width) + d for d in (-1, 0, 1)])))
    return left.join(b.withColumn("__bin", F.floor(F.col("pos_b") / width)), ["chrom", "__bin"]).where(F.abs(F.col("pos") - F.col("pos_b")) <= distance).drop("__bin")


def introns(exons: DataFrame, min_size: int = 1) -> DataFrame:
    """Gaps between consecutive exons of a transcript of at least ``min_size``."""
    w = Window.partitionBy("chrom", "gene_id").orderBy("region_start", "region_end")
    gap = exons.select("chrom", "gene_id", F.col("region_end").alias("intron_start"), F.lead("region_start").over(w).alias("intron_end"))
    return gap.where(F.col("intron_end") - F.col("intron_start") >= min_size)


def exclusive_features(hits: DataFrame, by: list[str]) -> DataFrame:
    """One row per gene and site: the feature of highest priority, so that a site counts once."""
    order = F.array_position(F.array(*[F.lit(p) for p in PRIORITY]), F.col("feature_type"))
    rank = F.when(order > 0, order).otherwise(len(PRIORITY) + 1)
    best = F.min_by(F.struct(*[c for c in hits.columns if c not in by]), F.struct(rank, "region_start", "region_end"))
    return hits.groupBy(*by).agg(best.alias("__best")).select(*by, "__best.*")


def windows(sites: DataFrame, size: int, step: int) -> DataFrame:
    """Rows listed once per sliding window start (multiple of ``step``) that covers them."""
    last = F.floor(F.col("pos") / step)
    first = F.greatest(F.floor((F.col("pos") - size) / step) + 1, F.lit(0))
    return sites.withColumn("window_start", F.explode(F.transform(F.sequence(first, last), lambda k: k * step)))
