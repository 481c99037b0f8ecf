"""Weights of sites by how their Beta distributions differ in mean, asymmetry and entropy, and samples weighted by them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.incomplete import _digamma, _let, lbeta


def beta_entropy(a: Column, b: Column) -> Column:
    """Differential entropy of Beta(a, b), in nats."""
    psi = lambda x: _let({"x": x}, lambda v: _digamma(v["x"]))
    return lbeta(a, b) - (a - 1) * psi(a) - (b - 1) * psi(b) + (a + b - 2) * psi(a + b)


def beta_asymmetry(a: Column, b: Column) -> Column:
    """(a - b) / (a + b): above 0 where most of the mass lies high."""
    return (a - b) / (a + b)


def _shape(a: Column, b: Column, low: float) -> tuple[Column, Column, Column]:
    """(mean, asymmetry, entropy); below the concentration ``low`` those of a normal of variance mean (1 - mean) / (a + b)."""
    mean = a / (a + b)
    variance = F.greatest(mean * (1 - mean) / (a + b), F.lit(1e-12))
    few = a + b < low
    return mean, F.when(few, (mean - 0.5) / F.sqrt(variance)).otherwise(beta_asymmetry(a, b)), F.when(few, 0.5 * F.log(2 * math.pi * math.e * variance)).otherwise(beta_entropy(a, b))


def distortion(a1: Column, b1: Column, a2: Column, b2: Column, gamma: float = 1.0, clip: float | None = None, low_concentration: float = 5.0) -> Column:
    """Difference of means * (1 + |difference of asymmetries|) * exp(-gamma |difference of entropies|), of the second against the first."""
    (m1, s1, h1), (m2, s2, h2) = _shape(a1, b1, low_concentration), _shape(a2, b2, low_concentration)
    t = (m2 - m1) * (1 + F.abs(s2 - s1)) * F.exp(-gamma * F.abs(h2 - h1))
    return t if clip is None else F.greatest(F.least(t, F.lit(clip)), F.lit(-clip))


def apply_distortion(levels: DataFrame, weights: DataFrame, key: list[str], norm: str | None = "l2") -> DataFrame:
    """(sample_id, key, value): each level times its site's weight ``t``, scaled for each sample.

    ``norm`` is l1, l2, minmax, zscore or None. The sample's scale is an aggregate that is joined
    back, so no task holds a sample. A sample without spread, or with all values 0, is divided by
    1e-12. Sites without a weight are left out.
    """
    rows = levels.join(weights.select(*key, "t"), key).select("sample_id", *key, (F.col("x") * F.col("t")).alias("v"))
    if norm is None:
        return rows.withColumnRenamed("v", "value")
    zero = F.lit(0.0)
    scales = {
        "l2": (zero, F.sqrt(F.sum(F.col("v") * F.col("v")))), "l1": (zero, F.sum(F.abs("v"))),
        "minmax": (F.min("v"), F.max("v") - F.min("v")), "zscore": (F.avg("v"), F.stddev_samp("v"))}
    if norm not in scales:
        raise ValueError("norm is l1, l2, minmax, zscore or None")
    shift, size = scales[norm]
    g = rows.groupBy("sample_id").agg(F.first(shift).alias("__a") if norm in ("l1", "l2") else shift.alias("__a"), size.alias("__s"))
    return rows.join(g, "sample_id").select("sample_id", *key, ((F.col("v") - F.col("__a")) / F.greatest(F.coalesce("__s", F.lit(0.0)), F.lit(1e-12))).alias("value"))
