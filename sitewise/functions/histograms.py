"""Functions of histogram arrays over [0, 1] with equal bins."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

GRID = 256


def total(h: Column) -> Column:
    return F.aggregate(h, F.lit(0.0), lambda s, x: s + x)


def shares(h: Column) -> Column:
    """The histogram scaled to sum 1."""
    zero = F.struct(F.lit(0.0).alias("t"))
    whole = F.aggregate(h, zero, lambda s, x: F.struct((s["t"] + x).alias("t")))
    return F.transform(F.arrays_zip(h.alias("h")), lambda x: x["h"] / F.greatest(whole["t"], F.lit(1e-20)))


def cdf_edges(h: Column, bins: int = 20) -> Column:
    """Cumulative shares at the bins' edges, 0 first."""
    zero = F.struct(F.lit(0.0).alias("t"), F.array(F.lit(0.0)).alias("e"))
    return F.aggregate(
        h, zero, lambda s, x: F.struct((s["t"] + x).alias("t"), F.concat(s["e"], F.array(s["t"] + x)).alias("e")),
        lambda s: F.transform(s["e"], lambda v: v / F.greatest(s["t"], F.lit(1e-20))))


def _pairs(h1: Column, h2: Column) -> Column:
    return F.zip_with(shares(h1), shares(h2), lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def _constant(values: list[float], k: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), k + 1)


def ks_statistic(h1: Column, h2: Column, bins: int = 20, grid: int = GRID) -> Column:
    """Largest |F1 - F2| at ``grid`` even points of the linearly interpolated distributions.

    The difference is linear inside a bin, so its first and last grid point there suffice.
    """
    low = [math.ceil(k * (grid - 1) / bins) * bins / (grid - 1) - k for k in range(bins)]
    high = [math.floor((k + 1) * (grid - 1) / bins) * bins / (grid - 1) - k for k in range(bins)]
    zero = F.struct(F.lit(0).alias("k"), F.lit(0.0).alias("d"), F.lit(0.0).alias("best"))

    def step(s: Column, x: Column) -> Column:
        rise = x["a"] - x["b"]
        ends = [F.abs(s["d"] + _constant(t, s["k"]) * rise) for t in (low, high)]
        return F.struct((s["k"] + 1).alias("k"), (s["d"] + rise).alias("d"), F.greatest(s["best"], *ends).alias("best"))

    return F.aggregate(_pairs(h1, h2), zero, step, lambda s: s["best"])


def bhattacharyya(h1: Column, h2: Column, bins: int = 20, grid: int = GRID) -> Column:
    """Sum of sqrt(p1 p2) over the cells of an even grid on the interpolated distributions, at most 1.

    A cell lies in one bin, or in two with fixed parts, so 2 * bins terms give the whole sum.
    """
    width, cells = bins / (grid - 1), grid - 1
    full = [float(math.floor((k + 1) * cells / bins) - math.ceil(k * cells / bins)) for k in range(bins)]
    left = [k * cells / bins - math.floor(k * cells / bins) for k in range(bins)]
    zero = F.struct(F.lit(0).alias("k"), F.lit(0.0).alias("a"), F.lit(0.0).alias("b"), F.lit(0.0).alias("sum"))

    def step(s: Column, x: Column) -> Column:
        f = _constant(left, s["k"])
        split = F.when(f > 0, F.sqrt((f * s["a"] + (1 - f) * x["a"]) * (f * s["b"] + (1 - f) * x["b"]))).otherwise(F.lit(0.0))
        return F.struct((s["k"] + 1).alias("k"), x["a"].alias("a"), x["b"].alias("b"),
                        (s["sum"] + width * (_constant(full, s["k"]) * F.sqrt(x["a"] * x["b"]) + split)).alias("sum"))

    return F.least(F.aggregate(_pairs(h1, h2), zero, step, lambda s: s["sum"]), F.lit(1.0))


def overlap_min(h1: Column, h2: Column) -> Column:
    """Shared mass of two normalised histograms."""
    t1, t2 = F.greatest(total(h1), F.lit(1e-20)), F.greatest(total(h2), F.lit(1e-20))
    return F.aggregate(F.zip_with(h1, h2, lambda a, b: F.least(a / t1, b / t2)), F.lit(0.0), lambda s, x: s + x)


def mann_whitney_u(h1: Column, h2: Column) -> Column:
    """Pairs with group 1 in a larger bin, half for equal bins."""
    zero = F.struct(F.lit(0.0).alias("below"), F.lit(0.0).alias("u"))
    return F.aggregate(
        F.zip_with(h1, h2, lambda a, b: F.struct(a.cast("double").alias("a"), b.cast("double").alias("b"))), zero,
        lambda s, x: F.struct((s["below"] + x["b"]).alias("below"), (s["u"] + x["a"] * (s["below"] + 0.5 * x["b"])).alias("u")),
        lambda s: s["u"])


def tie_sum(h1: Column, h2: Column) -> Column:
    ties = F.zip_with(h1, h2, lambda a, b: (a + b).cast("double"))
    return F.aggregate(ties, F.lit(0.0), lambda s, t: s + t * (t * t - 1))


def jensen_shannon(h1: Column, h2: Column) -> Column:
    """Jensen-Shannon divergence in bits of two normalised histograms."""
    t1, t2 = F.greatest(total(h1), F.lit(1e-20)), F.greatest(total(h2), F.lit(1e-20))

    def term(a: Column, b: Column) -> Column:
        p, q = a / t1, b / t2
        m = (p + q) / 2
        part = lambda x: F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))
        return (part(p) + part(q)) / 2

    return F.aggregate(F.zip_with(h1, h2, term), F.lit(0.0), lambda s, x: s + x)


def wasserstein(h1: Column, h2: Column, bins: int = 20) -> Column:
    """Sum of |F1 - F2| over bins times the bin width."""
    d = F.zip_with(cdf_edges(h1, bins), cdf_edges(h2, bins), lambda a, b: F.abs(a - b))
    return F.aggregate(d, F.lit(0.0), lambda s, x: s + x) / bins


def hellinger(h1: Column, h2: Column) -> Column:
    t1, t2 = F.greatest(total(h1), F.lit(1e-20)), F.greatest(total(h2), F.lit(1e-20))
    bc = F.aggregate(F.zip_with(h1, h2, lambda a, b: F.sqrt(a / t1 * b / t2)), F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(F.greatest(1 - bc, F.lit(0.0)))
