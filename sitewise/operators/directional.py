"""Directional scores of samples: how far levels lie from one half, in the direction of the sites' effects, by region and by gene."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .centroid import KEY, coverage, level


def _panel(sites: DataFrame, *by: str, region_weight: str | None) -> DataFrame:
    """(comparison, by, site, sign, weight) of the usable sites: an effect that is a number other than 0, and a weight above 0."""
    weight = F.abs(F.col("effect_size")) * (F.greatest(F.coalesce(F.col(region_weight), F.lit(1.0)), F.lit(0.0)) if region_weight else F.lit(1.0))
    rows = sites.where(F.col("effect_size").isNotNull() & ~F.isnan(F.col("effect_size").cast("double")))
    return rows.select("comparison", *by, *KEY, F.signum("effect_size").alias("__sign"), weight.alias("__w")).where("__w > 0")


def _levels(counts: DataFrame) -> DataFrame:
    return counts.where(coverage() > 0).select("sample_id", *KEY, (level() - 0.5).alias("__x"))


def _directional() -> Column:
    return F.sum(F.col("__sign") * F.col("__w") * F.col("__x")) / F.sum("__w")


def region_scores(counts: DataFrame, sites: DataFrame, regions: list[str] | None = None, min_loci: int = 1, region_weight: str | None = "region_weight") -> DataFrame:
    """(sample_id, comparison, feature_type, score, n_loci): the weighted mean of sign * (level - 1/2) over the sites of each region type.

    ``sites`` holds (comparison, site, feature_type, effect_size) and the column named by
    ``region_weight``, null weights counting 1. Region types with fewer than ``min_loci`` sites
    of a comparison have no score, nor has a sample without a covered site. A site in several
    rows counts in each. One shuffle by site and one aggregate.
    """
    rows = _panel(sites.where("feature_type is not null and feature_type <> 'unknown'"), "feature_type", region_weight=region_weight)
    if regions is not None:
        rows = rows.where(F.col("feature_type").isin(regions))
    enough = rows.groupBy("comparison", "feature_type").agg(F.count_distinct(*KEY).alias("n")).where(F.col("n") >= min_loci).select("comparison", "feature_type")
    j = _levels(counts).join(rows.join(enough, ["comparison", "feature_type"]), KEY)
    return j.groupBy("sample_id", "comparison", "feature_type").agg(_directional().alias("score"), F.count("*").alias("n_loci"))


def gene_scores(counts: DataFrame, sites: DataFrame, genes: DataFrame, importance_only: bool = False, region_weight: str | None = "region_weight") -> DataFrame:
    """(sample_id, comparison, score, observed_fraction, iqr, sign_agreement) over the genes of each comparison's panel.

    ``genes`` holds (comparison, gene, importance, support, prior): a gene weighs importance
    times the root of its support, or importance alone, and nothing below 0. Of a sample's
    directional values by gene, ``score`` is the weighted mean, ``iqr`` the interquartile range
    of all of them (null below two), ``observed_fraction`` the share of the panel that has one,
    and ``sign_agreement`` the weighted share with the sign of the gene's prior, among genes
    whose prior is not 0. Every sample has a row for every comparison with a panel.
    """
    rows = _panel(sites.where("gene is not null"), "gene", region_weight=region_weight)
    by_gene = _levels(counts).join(rows, KEY).groupBy("sample_id", "comparison", "gene").agg(_directional().alias("d"))
    importance, support = (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in ("importance", "support"))
    weight = importance if importance_only else F.when((importance > 0) & (support > 0), importance * F.sqrt(support)).otherwise(F.lit(0.0))
    panel = genes.select("comparison", "gene", F.greatest(weight, F.lit(0.0)).alias("w"), F.signum(F.coalesce(F.col("prior").cast("double"), F.lit(0.0))).alias("p"))
    sizes = panel.groupBy("comparison").agg(F.count("*").alias("size"))
    known = by_gene.join(panel, ["comparison", "gene"])
    sides = F.when(F.col("p") != 0, F.col("w"))
    g = known.groupBy("sample_id", "comparison").agg(
        F.count("*").alias("n"), F.sum("w").alias("sw"), F.sum(F.col("w") * F.col("d")).alias("swd"), F.percentile("d", [0.25, 0.75]).alias("q"),
        F.sum(sides).alias("sp"), F.sum(F.when(F.signum("d") == F.col("p"), sides).otherwise(F.when(F.col("p") != 0, F.lit(0.0)))).alias("sa"))
    # Comparisons are few, each with a row of its size.
    every = counts.select("sample_id").distinct().crossJoin(sizes)
    out = every.join(g, ["sample_id", "comparison"], "left")
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b))
    return out.select(
        "sample_id", "comparison", share("swd", "sw").alias("score"), (F.coalesce("n", F.lit(0)) / F.col("size")).alias("observed_fraction"),
        F.when(F.col("n") >= 2, F.element_at("q", 2) - F.element_at("q", 1)).alias("iqr"), share("sa", "sp").alias("sign_agreement"))
