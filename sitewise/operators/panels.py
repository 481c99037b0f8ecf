"""Panels of sites: choice, merging, expansion to regions, and the features of samples on them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .centroid import KEY, level
from .intervals import overlap
from .running import running

SITE = ["chrom", "pos"]


def strongest(rows: DataFrame, key: list[str], value: str, ties: list[str]) -> DataFrame:
    """The row of largest |value| of each key, null as 0, ties by the named columns."""
    size = F.abs(F.coalesce(F.col(value), F.lit(0.0)))
    best = F.max_by(F.struct(*[c for c in rows.columns if c not in key]), F.struct(size, *ties))
    return rows.groupBy(*key).agg(best.alias("__b")).select(*key, "__b.*")


def merge_comparisons(rows: DataFrame, labels: list[str], key: list[str], columns: tuple[str, ...] = ("effect_size", "delta_mean")) -> DataFrame:
    """One wide row per site over comparisons: number and names of comparisons, sum, max and mean of their effects, and each one's values, 0 where it has none."""
    one = strongest(rows, [*key, "label"], "effect_size", ["tie"])
    wide = [F.coalesce(F.max(F.when(F.col("label") == n, F.col(c))), F.lit(0.0)).alias(f"{c}__{n}") for c in columns for n in labels]
    return one.groupBy(*key).agg(
        F.countDistinct("label").alias("comparison_count"), F.array_join(F.array_sort(F.collect_set("label")), "|").alias("comparison_labels"),
        F.sum("effect_size").alias("effect_size_sum"), F.max("effect_size").alias("effect_size_max"), F.avg("effect_size").alias("effect_size_mean"), *wide)


def expand_ranges(observed: DataFrame, ranges: DataFrame, base: DataFrame) -> DataFrame:
    """(chrom, pos, weight): the base panel and all observed sites in weighted ranges, the largest weight of each site."""
    inside = overlap(observed.select(*SITE).distinct(), ranges).select(*SITE, "weight")
    return base.select(*SITE, "weight").unionByName(inside).groupBy(*SITE).agg(F.max("weight").alias("weight"))


def gene_values(counts: DataFrame, loci: DataFrame) -> DataFrame:
    """Level of each sample and gene: weighted over its loci (gene, site, w), plain where no weight is above 0."""
    j = counts.select("sample_id", *KEY, level().alias("x")).join(loci, KEY)
    w = F.when(F.col("w") > 0, F.col("w")).otherwise(F.lit(0.0))
    return j.groupBy("sample_id", "gene").agg(F.count("*").alias("n_loci"), F.when(F.sum(w) > 0, F.sum(w * F.col("x")) / F.sum(w)).otherwise(F.avg("x")).alias("value"))


def class_anchors(counts: DataFrame, label: str, classes: list) -> DataFrame:
    """Mean level of each class at each site that all of them have."""
    g = counts.groupBy(*KEY).agg(*[F.avg(F.when(F.col(label) == k, level())).alias(f"m{i}") for i, k in enumerate(classes)])
    return g.na.drop()


def panel_features(counts: DataFrame, anchors: DataFrame, n_classes: int, weight: Column) -> DataFrame:
    """Weighted mean, deviation, skewness, kurtosis and quartiles of a sample's levels on a panel, with cosine and mean absolute difference to each class's anchor.

    Central moments come from raw power sums around 0.5, so one pass over the counts is enough.
    """
    j = counts.select("sample_id", *KEY, level().alias("x")).join(anchors, KEY).withColumn("w", weight).withColumn("d", F.col("x") - 0.5)
    sums = [F.sum(F.col("w") * F.pow("d", F.lit(k))).alias(f"s{k}") for k in range(5)]
    near = [x for k in range(n_classes) for x in (
        (F.sum(F.col("w") * F.col("x") * F.col(f"m{k}")) / F.sqrt(F.sum(F.col("w") * F.col("x") * F.col("x")) * F.sum(F.col("w") * F.col(f"m{k}") * F.col(f"m{k}")))).alias(f"cosine{k}"),
        (F.sum(F.col("w") * F.abs(F.col("x") - F.col(f"m{k}"))) / F.sum("w")).alias(f"mae{k}"))]
    g = j.groupBy("sample_id").agg(F.count("*").alias("n_loci"), *sums, *[F.percentile("x", q).alias(n) for n, q in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))], *near)
    a, b, c, d = (F.col(f"s{k}") / F.col("s0") for k in (1, 2, 3, 4))
    var, third, fourth = b - a * a, c - 3 * a * b + 2 * a * a * a, d - 4 * a * c + 6 * a * a * b - 3 * a * a * a * a
    shaped = lambda m, p: F.when(var > 1e-12, m / F.pow(var, F.lit(p))).otherwise(F.lit(0.0))
    return g.select("sample_id", "n_loci", (a + 0.5).alias("mean"), F.sqrt(F.greatest(var, F.lit(0.0))).alias("sd"), shaped(third, 1.5).alias("skew"), shaped(fourth, 2.0).alias("kurtosis"),
                    "q25", "q50", "q75", *[f"{n}{k}" for k in range(n_classes) for n in ("cosine", "mae")])


def effect_trim(rows: DataFrame, value: str, by: list[str], relaxation: float = 1.0, least: int = 10) -> DataFrame:
    """(by, cutoff, n_kept): cut at the value nearest to the corner of rank and size, both scaled to 0..1.

    Ranks start at the largest value. Up to ``least`` rows, or equal values, keep all.
    """
    counts = rows.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("v")).agg(F.count("*").alias("n"))
    placed = running(counts, by, [F.desc("v")], {"upto": "n"})
    whole = placed.groupBy(*by).agg(F.max("upto").alias("all"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    j = placed.join(whole, by)
    x, y = (F.col("upto") - F.col("n")) / F.greatest(F.col("all") - 1, F.lit(1)), (F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo"))
    j = j.withColumn("d", F.when((F.col("all") > least) & (F.col("hi") > F.col("lo")), F.round(x * x + y * y, 12)))
    cut = j.groupBy(*by).agg(F.coalesce(F.min_by("v", F.struct("d", F.col("upto"))) * relaxation, F.min("v")).alias("c"), F.count("d").alias("cuts"), F.min("v").alias("lo"))
    cut = cut.select(*by, F.when(F.col("cuts") > 0, F.col("c")).otherwise(F.col("lo")).alias("cutoff"))
    return placed.join(cut, by).groupBy(*by, "cutoff").agg(F.sum(F.when(F.col("v") >= F.col("cutoff"), F.col("n")).otherwise(0)).alias("n_kept"))


def choose_lambda(rows: DataFrame, lambdas: list[float], target: str) -> DataFrame:
    """(lambda_var, correlation, chosen): rank correlation of the effect size under each variance penalty with a target; the smaller penalty on ties."""
    from . import fdr

    every = rows.withColumn("lambda_var", F.explode(F.array(*[F.lit(v) for v in lambdas])))
    clipped = F.least(F.greatest(F.col("overlap"), F.lit(0.0)), F.lit(1.0))
    spread = F.sqrt(F.greatest(F.col("var1"), F.lit(0.0))) + F.sqrt(F.greatest(F.col("var2"), F.lit(0.0)))
    every = every.withColumn("e", F.round(F.abs(F.col("mean1") - F.col("mean2")) * (1 - clipped) * F.exp(-F.col("lambda_var") * spread), 9))
    ranked = fdr.average_rank(fdr.average_rank(every, "e", ["lambda_var"], "re"), target, ["lambda_var"], "rt")
    g = ranked.groupBy("lambda_var").agg(F.corr("re", "rt").alias("correlation"))
    best = g.agg(F.max(F.struct(F.round("correlation", 9), -F.col("lambda_var"))).alias("b"))
    return g.crossJoin(F.broadcast(best)).select("lambda_var", "correlation", (F.col("lambda_var") == -F.col("b.col2")).alias("chosen"))  # one row


def fit_covariates(values: DataFrame, covariates: DataFrame, columns: list[str], by: list[str] | None = None, y: str = "m") -> DataFrame:
    """(by, n, intercept, one slope per column): least squares on several covariates for each site, complete cases only.

    The sums are one aggregate; each site's small system is solved inside a task. Covariates are
    centred by their means first. A site without full rank has nulls: one where a covariate's
    variance is at most 1e-12, or the determinant of the covariates' correlations at most 1e-8,
    as with no more samples than covariates.
    """
    by, p = by or KEY, len(columns)
    known = covariates.select("sample_id", *columns).na.drop()
    means = known.agg(*[F.avg(c).alias(f"__a{i}") for i, c in enumerate(columns)])
    centred = known.crossJoin(F.broadcast(means)).select("sample_id", *[(F.col(c) - F.col(f"__a{i}")).alias(f"__x{i}") for i, c in enumerate(columns)], *[f"__a{i}" for i in range(p)])
    x = [F.lit(1.0), *[F.col(f"__x{i}") for i in range(p)]]
    j = values.where(F.col(y).isNotNull()).join(centred, "sample_id")
    sums = [F.sum(x[a] * x[b]) for a in range(p + 1) for b in range(p + 1)] + [F.sum(a * F.col(y)) for a in x]
    g = j.groupBy(*by).agg(F.count("*").alias("n"), F.array(*sums).alias("__s"), F.array(*[F.max(f"__a{i}") for i in range(p)]).alias("__m"))

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        k = p + 1
        for b in batches:
            s = np.array(b["__s"].tolist(), float).reshape(len(b), -1)
            if not len(b):
                continue
            matrix, right = s[:, :k * k].reshape(-1, k, k), s[:, k * k:]
            n = matrix[:, 0, 0]
            mean, my = matrix[:, 0, 1:] / n[:, None], right[:, 0] / n
            cov = matrix[:, 1:, 1:] / n[:, None, None] - mean[:, :, None] * mean[:, None, :]
            with_y = right[:, 1:] / n[:, None] - mean * my[:, None]
            var = np.einsum("nii->ni", cov)
            full = (var > 1e-12).all(1)
            sd = np.sqrt(np.where(full[:, None], var, 1.0))
            full &= np.linalg.det(cov / (sd[:, :, None] * sd[:, None, :])) > 1e-8
            slopes = np.full((len(b), p), np.nan)
            slopes[full] = np.linalg.solve(cov[full], with_y[full][:, :, None])[..., 0]
            out = b.drop(columns=["__s", "__m"])
            out["intercept"] = my - (slopes * (mean + np.array(b["__m"].tolist(), float).reshape(len(b), p))).sum(1)
            for i, c in enumerate(columns):
                out[f"slope_{c}"] = slopes[:, i]
            yield out

    kinds = ", ".join(f"{c} {g.schema[c].dataType.simpleString()}" for c in [*by, "n"])
    solved = g.mapInPandas(solve, f"{kinds}, intercept double, {', '.join(f'slope_{c} double' for c in columns)}")
    return solved.withColumns({c: F.when(F.isnan(c), F.lit(None)).otherwise(F.col(c)) for c in ["intercept", *[f"slope_{c}" for c in columns]]})


def residualize_on(values: DataFrame, covariates: DataFrame, coefficients: DataFrame, columns: list[str], by: list[str] | None = None, y: str = "m") -> DataFrame:
    """y minus the fitted part where the site and all covariates are known, else y as it was."""
    j = values.join(covariates.select("sample_id", *[F.col(c).alias(f"__{c}") for c in columns]), "sample_id", "left").join(coefficients.drop("n"), by or KEY, "left")
    fitted = sum((F.col(f"slope_{c}") * F.col(f"__{c}") for c in columns), F.col("intercept"))
    return j.select(*values.columns, F.coalesce(F.col(y) - fitted, F.col(y)).alias("residual"))


def stage_coverage(stages: DataFrame, sets: DataFrame, top: int) -> DataFrame:
    """Share of each term's genes that are among the ``top`` entities of each stage, and among all of it."""
    ranked = stages.withColumn("rank", F.row_number().over(Window.partitionBy("stage_index").orderBy(F.desc("score"), "entity")))
    size = sets.groupBy("library", "term").agg(F.countDistinct("gene").alias("term_size"))
    hits = sets.distinct().join(ranked.select("stage_index", F.col("entity").alias("gene"), "rank"), "gene").groupBy("stage_index", "library", "term").agg(
        F.count("*").alias("n_all"), F.count_if(F.col("rank") <= top).alias("n_top"))
    return hits.join(size, ["library", "term"]).select("stage_index", "library", "term", "term_size", "n_all", "n_top", (F.col("n_all") / F.col("term_size")).alias("share_all"), (F.col("n_top") / F.col("term_size")).alias("share_top"))


def write_split(train: DataFrame, test: DataFrame, path: str) -> DataFrame:
    """Both design matrices as Parquet below ``path``, and a manifest row: rows of each and samples in both."""
    train.write.parquet(f"{path}/train")
    test.write.parquet(f"{path}/test")
    a, b = (train.sparkSession.read.schema(d.schema).parquet(f"{path}/{n}") for d, n in ((train, "train"), (test, "test")))
    shared = a.select("sample_id").distinct().join(b.select("sample_id").distinct(), "sample_id").agg(F.count("*").alias("n_overlap"))
    return a.agg(F.count("*").alias("n_train")).crossJoin(F.broadcast(b.agg(F.count("*").alias("n_test")))).crossJoin(F.broadcast(shared))  # one row each
