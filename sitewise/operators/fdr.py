"""False-discovery control without a one-partition sort.

Equal p-values share a q-value, so the work runs on distinct p. They are cut into buckets
of about 1.6 % relative width for small p and of 1 / 65,536 above 1 / 64; only bucket totals
are ranked in one window per group, and ranks and running minima inside a bucket are added
to those of the buckets around it. All frames start at the first row, so each is linear.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .running import running

#: Fixed λ grids of the two estimators.
PAIR_LAMBDAS = [0.05 * k for k in range(1, 20)]
LIBRARY_LAMBDAS = [0.01 + 0.94 * k / 99 for k in range(100)]
MIN_P = 1e-300


def pi0(df: DataFrame, p: str, by: list[str], lambdas: list[float], centre: str) -> DataFrame:
    """(by, m, pi0): mean or median over λ of the share of p above λ, at most 1. One conditional count per λ."""
    shares = df.groupBy(*by).agg(F.count(p).alias("m"), F.array(*[F.count_if(F.col(p) > v) / (1 - v) for v in lambdas]).alias("above"))
    value = F.aggregate("above", F.lit(0.0), lambda s, x: s + x) / len(lambdas)
    if centre == "median":
        ordered, n = F.array_sort("above"), len(lambdas)
        value = (F.element_at(ordered, (n + 1) // 2) + F.element_at(ordered, n // 2 + 1)) / 2
    return shares.select(*by, "m", F.least(value / F.col("m"), F.lit(1.0)).alias("pi0"))


def q_values(df: DataFrame, p: str, by: list[str], scale: DataFrame, clip: bool = True, to: str = "q_value") -> DataFrame:
    """Adds the smallest of pi0 * m * p / rank over this and all larger p of the group; null p gives null q."""
    small = F.floor(F.log(F.greatest(F.col("__p"), F.lit(MIN_P))) * 64)  # below 0, so before the others
    bucket = F.when(F.col("__p") < 1 / 64, small).otherwise(F.floor(F.col("__p") * 65_536))
    distinct = df.where(F.col(p).isNotNull()).groupBy(*by, F.col(p).alias("__p")).agg(F.count("*").alias("__n")).withColumn("__b", bucket)
    totals = distinct.groupBy(*by, "__b").agg(F.sum("__n").alias("__t"))
    order = Window.partitionBy(*by).orderBy("__b") if by else Window.orderBy("__b")  # bucket totals only
    before = totals.withColumn("__off", F.sum("__t").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__t")).drop("__t")
    backwards = (Window.partitionBy(*by) if by else Window).orderBy(F.desc("__b"))
    inside, upwards = Window.partitionBy(*by, "__b").orderBy("__p"), Window.partitionBy(*by, "__b").orderBy(F.desc("__p"))
    scale = scale.select(*by, F.col("m").alias("__m"), F.col("pi0").alias("__pi0"))
    joined = distinct.join(before, [*by, "__b"])
    joined = joined.join(scale, by) if by else joined.crossJoin(F.broadcast(scale))  # one row
    rank = F.col("__off") + F.sum("__n").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    ratio = joined.withColumn("__r", F.col("__pi0") * F.col("__m") * F.col("__p") / rank)
    least = ratio.groupBy(*by, "__b").agg(F.min("__r").alias("__min"))
    later = least.select(*by, "__b", F.min("__min").over(backwards.rowsBetween(Window.unboundedPreceding, -1)).alias("__later"))
    q = F.least(F.min("__r").over(upwards.rowsBetween(Window.unboundedPreceding, 0)), F.coalesce("__later", F.lit(float("inf"))))
    table = ratio.join(later, [*by, "__b"]).select(*[F.col(c).alias(f"__g_{c}") for c in by], F.col("__p"), (F.least(q, F.lit(1.0)) if clip else q).alias(to))
    match = [F.col(c).eqNullSafe(F.col(f"__g_{c}")) for c in by] + [F.col(p) == F.col("__p")]
    return df.join(table, match, "left").drop("__p", *[f"__g_{c}" for c in by])


def storey_pair(df: DataFrame, p: str, by: list[str]) -> DataFrame:
    return q_values(df, p, by, pi0(df, p, by, PAIR_LAMBDAS, "mean"))


def storey_library(df: DataFrame, p: str, by: list[str]) -> DataFrame:
    return q_values(df, p, by, pi0(df, p, by, LIBRARY_LAMBDAS, "median"), clip=False)


def benjamini_hochberg(df: DataFrame, p: str, by: list[str]) -> DataFrame:
    one = df.groupBy(*by).agg(F.count(p).alias("m")).withColumn("pi0", F.lit(1.0))
    return q_values(df, p, by, one)


def average_rank(df: DataFrame, value: str, by: list[str], to: str) -> DataFrame:
    """Rank with ties averaged, from counts of distinct values: (values below) + (ties + 1) / 2."""
    counts = df.groupBy(*by, F.col(value).alias("__v")).agg(F.count("*").alias("__n"))
    ranks = running(counts, by, ["__v"], {"__c": "__n"}).withColumn(to, F.col("__c") - F.col("__n") + (F.col("__n") + 1) / 2)
    ranks = ranks.select(*[F.col(c).alias(f"__g_{c}") for c in by], "__v", to)
    match = [F.col(c).eqNullSafe(F.col(f"__g_{c}")) for c in by] + [F.col(value).eqNullSafe(F.col("__v"))]
    return df.join(ranks, match, "left").drop("__v", *[f"__g_{c}" for c in by])


def fraction_rank(df: DataFrame, value: str, by: list[str], to: str) -> DataFrame:
    """(average rank - 0.5) / n of the group."""
    n = df.groupBy(*by).agg(F.count(value).alias("__size"))
    ranked = average_rank(df, value, by, "__rank")
    ranked = ranked.join(n, by) if by else ranked.crossJoin(F.broadcast(n))  # one row
    return ranked.withColumn(to, (F.col("__rank") - 0.5) / F.col("__size")).drop("__rank", "__size")


def significant(q: str, alpha: float) -> Column:
    return F.coalesce(F.col(q) <= alpha, F.lit(False))
