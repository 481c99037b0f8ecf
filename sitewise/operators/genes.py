"""Gene roll-ups of site results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import special
from ..functions.incomplete import chi2_sf

#: Default biology weights, feature to (hyper, hypo).
FEATURE_WEIGHTS = {"promoter": (2.0, 1.0), "exon": (1.5, 1.0), "intron": (0.5, 0.7), "gene_body": (1.0, 1.0), "terminator": (0.5, 0.5)}


def feature_weight(feature: str = "feature_type", sign: str = "sign") -> Column:
    """Weight of a feature by direction; the mean of both where the sign is 0."""
    out = F.lit(1.0)
    for name, (hyper, hypo) in FEATURE_WEIGHTS.items():
        out = F.when(F.col(feature) == name, F.when(F.col(sign) > 0, hyper).when(F.col(sign) < 0, hypo).otherwise((hyper + hypo) / 2)).otherwise(out)
    return out


def roll_up(hits: DataFrame) -> DataFrame:
    """Counts and summary statistics of a gene's sites; input has p_value, q_value, effect_size."""
    return hits.groupBy("gene_id").agg(
        F.count("*").alias("n_hits"), F.countDistinct("chrom", "pos").alias("n_sites"), F.min("p_value").alias("min_p"), F.avg("p_value").alias("mean_p"),
        F.min("q_value").alias("min_q"), F.sum("effect_size").alias("sum_effect"), F.max("effect_size").alias("max_effect"), F.avg("effect_size").alias("mean_effect"))


def importance(hits: DataFrame) -> DataFrame:
    """Biology-weighted importance: sum of |weighted effects| * coherence * sqrt(mean frequency)."""
    w = F.col("frequency") * feature_weight()
    rows = hits.withColumn("term", w * F.abs(F.col("effect_size"))).withColumn("signed", F.col("term") * F.col("sign"))
    g = rows.groupBy("gene_id").agg(F.sum("term").alias("sum_abs"), F.sum("signed").alias("sum_signed"), F.avg(F.least(F.greatest(F.col("frequency"), F.lit(0.0)), F.lit(1.0))).alias("mean_frequency"))
    coherence = F.when(F.col("sum_abs") > 0, F.abs(F.col("sum_signed")) / F.col("sum_abs")).otherwise(F.lit(0.0))
    return g.select("gene_id", "sum_abs", coherence.alias("coherence"), (F.col("sum_abs") * coherence * F.sqrt("mean_frequency")).alias("gene_importance"))


def stouffer(df: DataFrame, by: list[str], p: str = "p_value", weight: str = "w", sign: str = "sign") -> DataFrame:
    """Signed weighted Stouffer: z of half the two-sided p clipped to 8, two-sided combined p."""
    clean = df.withColumn("__h", F.greatest(F.least(F.col(p), F.lit(1 - 1e-15)), F.lit(1e-300)) / 2)
    z = F.least(-F.expr(special.norm_ppf("__h")), F.lit(8.0)) * F.col(sign)
    g = clean.withColumn("__z", z).groupBy(*by).agg((F.sum(F.col(weight) * F.col("__z")) / F.sqrt(F.sum(F.col(weight) * F.col(weight)))).alias("z"))
    return g.withColumn("p_combined", F.expr(f"least(1E0, 2 * {special.norm_sf('abs(z)')})"))


def combine_p(df: DataFrame, by: list[str], p: str = "p_value") -> DataFrame:
    """Combined p-values of each group: Fisher, Lancaster, Tippett, Simes, mean-z Stouffer, Edgington and Mudholkar-George.

    Edgington is the beta approximation below 20 values and the normal one from there. Lancaster
    has one degree for each value and no weights, so it is Fisher's value by the general
    chi-square tail; with degrees and weights it is ``fit_tests.lancaster``.
    """
    from pyspark.sql import Window

    clean = df.withColumn("__p", F.greatest(F.least(F.col(p), F.lit(1 - 1e-15)), F.lit(1e-300)))
    w = Window.partitionBy(*by).orderBy("__p")
    rows = clean.withColumn("__i", F.row_number().over(w)).withColumn("__k", F.count("*").over(Window.partitionBy(*by))).withColumn("__z", -F.expr(special.norm_ppf("__p")))
    rows = rows.withColumn("__q", 1 - F.pow("__p", 1 / F.col("__k"))).withColumn("__mg", F.expr(special.norm_ppf("greatest(least(__q, 1E0 - 1E-15), 1E-300)")))
    g = rows.groupBy(*by).agg(
        F.count("*").alias("k"), (-2 * F.sum(F.log("__p"))).alias("fisher_stat"), F.min("__p").alias("p_min"),
        F.least(F.min(F.col("__k") * F.col("__p") / F.col("__i")), F.lit(1.0)).alias("simes"), F.avg("__z").alias("mean_z"), F.sum("__p").alias("sum_p"), F.sum("__mg").alias("sum_mg"))
    few = 1 - F.pow(F.least("sum_p", F.lit(1.0)), F.col("k"))
    edgington = F.when(F.col("k") < 20, few).otherwise(F.expr(special.norm_sf("((sum_p - k / 2E0) / sqrt(k / 12E0))")))
    fisher = F.expr(special.chi2_sf_even("fisher_stat", "k"))
    lancaster = chi2_sf(F.col("fisher_stat"), 2 * F.col("k"))
    g = g.withColumns({"fisher": fisher, "lancaster": lancaster, "edgington": edgington, "mudholkar_george": F.expr(special.norm_sf("(sum_mg / sqrt(k))"))})
    return g.select(*by, "k", "fisher_stat", (1 - F.pow(1 - F.col("p_min"), F.col("k"))).alias("tippett"), "simes", F.expr(special.norm_sf("mean_z")).alias("stouffer"), "fisher", "lancaster", "edgington", "mudholkar_george")
