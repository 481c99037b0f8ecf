"""Cohort statistics per site: build, merge, filter, coverage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import materialize
from .running import quantiles

KEY = ["chrom", "context", "pos"]
BINS = 20
STATS = ["N", "Sx", "Sx2", "Sm", "Su", "Sc2", "Swx2"]


def coverage() -> Column:
    return F.col("mC") + F.col("uC")


def level() -> Column:
    """Methylation level; 0 where nothing was covered."""
    return F.when(coverage() > 0, F.col("mC") / coverage()).otherwise(F.lit(0.0))


def level_bin(bins: int = BINS) -> Column:
    """Right-open bin of the level by exact integers; a level of 1 is in the last bin."""
    return F.when(coverage() > 0, F.least(F.expr(f"(mC * {bins}) div (mC + uC)"), F.lit(bins - 1))).otherwise(0).cast("int")


def clamp_zero_coverage(counts: DataFrame) -> DataFrame:
    """Rows without coverage get one unmethylated count."""
    return counts.withColumn("uC", F.when(coverage() == 0, F.lit(1).cast("long")).otherwise(F.col("uC")))


def build(counts: DataFrame, by: list[str] | None = None, bins: int = BINS) -> DataFrame:
    """Sufficient statistics and histogram over samples for each group, one partial and one final aggregate."""
    by = by or KEY
    rows = counts.select(*by, "mC", "uC", level().alias("x"), coverage().alias("c"), level_bin(bins).alias("bin"))
    return rows.groupBy(*by).agg(
        F.count("*").alias("N"), F.sum("x").alias("Sx"), F.sum(F.col("x") * F.col("x")).alias("Sx2"),
        F.sum("mC").alias("Sm"), F.sum("uC").alias("Su"), F.sum(F.col("c") * F.col("c")).alias("Sc2"),
        F.sum(F.col("c") * F.col("x") * F.col("x")).alias("Swx2"),
        F.array(*[F.count_if(F.col("bin") == k) for k in range(bins)]).alias("bin_counts"),
    )


def merge(parts: list[tuple[DataFrame, int]], by: list[str] | None = None, bins: int = BINS) -> DataFrame:
    """Adds (sign 1) and removes (sign -1) stored statistics; sites without samples vanish."""
    by = by or KEY
    def times(df: DataFrame, sign: int) -> DataFrame:
        return df.select(*by, *[(F.col(c) * sign).alias(c) for c in STATS], F.transform("bin_counts", lambda v: v * sign).alias("bin_counts"))

    signed = reduce(DataFrame.unionByName, [times(df, sign) for df, sign in parts])
    return signed.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in STATS],
        F.array(*[F.sum(F.element_at("bin_counts", k + 1)) for k in range(bins)]).alias("bin_counts"),
    ).where("N > 0")


def mean() -> Column:
    return F.col("Sx") / F.col("N")


def variance() -> Column:
    """Unbiased, with the divisor at least 1, floored at 1e-12."""
    return F.greatest((F.col("Sx2") - F.col("Sx") * F.col("Sx") / F.col("N")) / F.greatest(F.col("N") - 1, F.lit(1)), F.lit(1e-12))


def weighted_mean() -> Column:
    total = F.col("Sm") + F.col("Su")
    return F.when(total > 0, F.col("Sm") / total)


def weighted_variance() -> Column:
    total = F.col("Sm") + F.col("Su")
    return F.when(total > 0, F.greatest(F.col("Swx2") / total - F.pow(F.col("Sm") / total, F.lit(2)), F.lit(0.0)))


def mean_coverage() -> Column:
    return (F.col("Sm") + F.col("Su")) / F.col("N")


def moments(centroid: DataFrame) -> DataFrame:
    return centroid.select("*", mean().alias("mean"), variance().alias("variance"), weighted_mean().alias("weighted_mean"),
                           weighted_variance().alias("weighted_variance"), mean_coverage().alias("mean_coverage"))


def filter_cohort(centroid: DataFrame, min_samples: int, min_coverage: int) -> DataFrame:
    """At least so many samples, and so much coverage over all of them."""
    return centroid.where((F.col("N") >= min_samples) & (F.col("Sm") + F.col("Su") >= min_coverage))


def coverage_summary(counts: DataFrame, by: list[str], iqr_multiplier: float = 1.5) -> DataFrame:
    """Exact median, mean and quartiles of coverage, and the fence and cap above the third quartile."""
    c = coverage().cast("double")
    q = counts.groupBy(*by).agg(F.percentile(c, 0.5).alias("median"), F.avg(c).alias("mean"), F.percentile(c, 0.25).alias("q1"), F.percentile(c, 0.75).alias("q3"))
    fence = F.col("q3") + iqr_multiplier * (F.col("q3") - F.col("q1"))
    return q.withColumn("fence", fence).withColumn("n_cap", F.greatest(F.floor(fence), F.lit(1)).cast("long"))


def coverage_outliers(counts: DataFrame, threshold: float = 3.5) -> DataFrame:
    """Robust z of each sample's median coverage against the cohort's, and its flag."""
    per = counts.groupBy("sample_id").agg(F.percentile(coverage().cast("double"), 0.5).alias("median"))
    centre = per.agg(F.percentile("median", 0.5).alias("centre"))
    dev = per.crossJoin(F.broadcast(centre))  # one row
    mad = dev.agg(F.percentile(F.abs(F.col("median") - F.col("centre")), 0.5).alias("mad"))
    z = F.when(F.col("mad") > 0, 0.6745 * (F.col("median") - F.col("centre")) / F.col("mad")).otherwise(F.lit(0.0))
    return dev.crossJoin(F.broadcast(mad)).select("sample_id", "median", z.alias("robust_z"), (F.abs(z) > threshold).alias("is_outlier"))


def validate_pair(a: DataFrame, b: DataFrame, trim: float = 0.1) -> DataFrame:
    """Medians of two cohorts' means and the mean absolute difference without its lowest tenth."""
    both = a.select(*KEY, mean().alias("m1")).join(b.select(*KEY, mean().alias("m2")), KEY).withColumn("d", F.abs(F.col("m1") - F.col("m2")))
    both = materialize(both, "pair")  # read four times
    ends = [quantiles(both, c, {n: p}) for c, n, p in (("d", "cut", trim), ("m1", "median1", 0.5), ("m2", "median2", 0.5))]
    row = reduce(lambda x, y: x.crossJoin(F.broadcast(y)), ends)  # one row each
    return both.crossJoin(F.broadcast(row)).groupBy("median1", "median2").agg(
        F.count("*").alias("n_common"), F.avg(F.when(F.col("d") >= F.col("cut"), F.col("d"))).alias("trimmed_delta")).select("n_common", "median1", "median2", "trimmed_delta")


def heterogeneity() -> Column:
    """DerSimonian-Laird between-sample variance from the stored weighted sums, floored at 0."""
    w = F.greatest((F.col("Sm") + F.col("Su")).cast("double"), F.lit(1e-12))
    q = F.col("Swx2") - F.col("Sm") * F.col("Sm") / w
    spread = F.greatest(w - F.col("Sc2") / w, F.lit(1e-12))
    return F.greatest((q - F.greatest(F.col("N") - 1, F.lit(0))) / spread, F.lit(0.0))
