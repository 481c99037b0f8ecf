"""How well the levels of a site follow a Normal or a Beta distribution, and p-values combined with degrees and weights."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import special
from ..functions.incomplete import beta_grid, chi2_sf, normal_grid

GRID = 256


def _largest_gaps(hist: np.ndarray, mean: np.ndarray, variance: np.ndarray, a: np.ndarray, b: np.ndarray, grid: int) -> tuple[np.ndarray, np.ndarray]:
    """(Normal, Beta): largest difference to the interpolated distribution of each row's histogram at even points of [0, 1]."""
    x, bins = np.linspace(0.0, 1.0, grid), hist.shape[1]
    edges = np.concatenate([np.zeros((len(hist), 1)), np.cumsum(hist, 1)], 1) / np.maximum(hist.sum(1, keepdims=True), 1e-20)
    at = np.minimum((x * bins).astype(int), bins - 1)
    seen = edges[:, at] + (x * bins - at) * (edges[:, at + 1] - edges[:, at])
    sd = np.sqrt(np.maximum(variance, 1e-12))[:, None]
    low, high = normal_grid(-mean[:, None] / sd), normal_grid((1 - mean[:, None]) / sd)
    normal = np.where(high > low, (normal_grid((x[None, :] - mean[:, None]) / sd) - low) / np.where(high > low, high - low, 1.0), x[None, :] >= mean[:, None])
    beta = beta_grid(x, np.maximum(a, 1e-12), np.maximum(b, 1e-12))
    return np.abs(seen - normal).max(1), np.abs(seen - beta).max(1)


def fit_distances(centroid: DataFrame, hist: str = "bin_counts", mean: str = "mean", variance: str = "variance", a: str = "a", b: str = "b", n: str = "N", grid: int = GRID) -> DataFrame:
    """Adds ks_normal, ks_beta, their p-values and the closer of both.

    The Normal is cut to [0, 1]; where the variance is 0 or not finite it has no distance. The
    p-values are those of Kolmogorov's distribution for n samples. Sites are compared in Arrow
    batches; one of ties is the Beta. A row without counts has nulls.
    """
    @F.pandas_udf("struct<normal: double, beta: double>")
    def gaps(h: pd.Series, m: pd.Series, v: pd.Series, alpha: pd.Series, beta: pd.Series) -> pd.DataFrame:
        if not len(h):
            return pd.DataFrame({"normal": pd.Series([], dtype=float), "beta": pd.Series([], dtype=float)})
        counts = np.stack(h.to_list()).astype(float)
        normal, other = _largest_gaps(counts, m.to_numpy(float), v.to_numpy(float), alpha.to_numpy(float), beta.to_numpy(float), grid)
        empty = counts.sum(1) <= 0
        usable = np.isfinite(v.to_numpy(float)) & (v.to_numpy(float) > 0)
        return pd.DataFrame({"normal": np.where(empty | ~usable, np.nan, normal), "beta": np.where(empty, np.nan, other)})

    found = gaps(hist, *[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in (mean, variance, a, b)])
    clean = lambda c: F.when(F.isnan(c), F.lit(None)).otherwise(c)
    out = centroid.withColumn("__gap", found).withColumns({"ks_normal": clean(F.col("__gap.normal")), "ks_beta": clean(F.col("__gap.beta"))}).drop("__gap")
    p = lambda c: F.expr(special.kolmogorov_sf(f"(sqrt(CAST({n} AS DOUBLE)) * {c})"))
    return out.withColumns({
        "p_normal": F.when(F.col("ks_normal").isNotNull(), p("ks_normal")), "p_beta": F.when(F.col("ks_beta").isNotNull(), p("ks_beta")),
        "closest": F.when(F.col("ks_beta").isNull(), F.lit(None)).when(F.col("ks_normal") < F.col("ks_beta"), "normal").otherwise("beta")})


def lancaster(df: DataFrame, by: list[str], p: str = "p_value", degrees: Column | None = None, weight: Column | None = None) -> DataFrame:
    """(by, k, statistic, degrees, p_combined): p-values combined with degrees and weights of their own.

    Without weights the statistic is the sum of -2 ln p / degrees with twice the sum of the
    degrees; with weights, scaled to sum 1 in each group, both are weighted sums. Degrees are 1
    where none are given. Rows without a p-value do not count; a group whose weights sum to 0
    has nulls. One partial and one final aggregate.
    """
    one = F.lit(1.0)
    rows = df.where(F.col(p).isNotNull()).select(*by, F.greatest(F.least(F.col(p), F.lit(1 - 1e-15)), F.lit(1e-300)).alias("__p"), (degrees if degrees is not None else one).cast("double").alias("__d"), (weight if weight is not None else one).cast("double").alias("__w"))
    g = rows.groupBy(*by).agg(F.count("*").alias("k"), F.sum("__w").alias("__sw"), F.sum(F.col("__w") * -2 * F.log("__p") / F.col("__d")).alias("__s"), F.sum(F.col("__w") * F.col("__d")).alias("__sd"))
    scale = F.when(F.col("__sw") > 0, F.col("__sw")) if weight is not None else one
    g = g.select(*by, "k", (F.col("__s") / scale).alias("statistic"), (2 * F.col("__sd") / scale).alias("degrees"))
    return g.withColumn("p_combined", F.when(F.col("statistic").isNotNull(), chi2_sf(F.col("statistic"), F.col("degrees"))))
