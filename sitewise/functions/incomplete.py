"""Regularised incomplete gamma and beta functions and the tails that follow from them.

``gamma_sf``, ``beta_cdf`` and what builds on them are Column expressions; ``beta_grid`` is the
same continued fraction in numpy, for whole grids inside a task. Series and continued fractions
(modified Lentz) run a number of steps that grows with the square root of the parameters; above
LARGE the incomplete beta is the published cube-root normal approximation (error below 1e-4 there).
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import special

_TINY = 1e-300
#: a + b from which the incomplete beta is approximated.
LARGE = 20_000.0


def _let(fields: dict[str, Column], body) -> Column:
    """``body`` of a struct whose fields are computed once."""
    return F.element_at(F.transform(F.array(F.struct(*[c.cast("double").alias(n) for n, c in fields.items()])), body), 1)


def _lgamma(x: Column) -> Column:
    """Log gamma of x > 0 by Stirling's series at x + 8."""
    def series(v: Column) -> Column:
        y = v["x"] + 8
        product = v["x"]
        for k in range(1, 8):
            product = product * (v["x"] + k)
        inner = (1 / 12 - (1 / 360 - (1 / 1260 - (1 / 1680 - F.lit(1 / 1188) / (y * y)) / (y * y)) / (y * y)) / (y * y)) / y
        return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + inner - F.log(product)

    return _let({"x": x}, series)


def lbeta(a: Column, b: Column) -> Column:
    return _lgamma(a) + _lgamma(b) - _lgamma(a + b)


def _steps(n: Column) -> Column:
    return F.sequence(F.lit(1), n.cast("int"))


def _away(x: Column) -> Column:
    return F.when(F.abs(x) < _TINY, F.lit(_TINY)).otherwise(x)


def gamma_sf(a: Column, x: Column) -> Column:
    """Upper regularised incomplete gamma Q(a, x) for a > 0; 1 for x <= 0."""
    def series(v: Column) -> Column:
        start = F.struct((1 / v["a"]).alias("t"), (1 / v["a"]).alias("s"))
        step = lambda s, n: _let({"t": s["t"] * v["x"] / (v["a"] + n), "s": s["s"]}, lambda u: F.struct(u["t"].alias("t"), (u["s"] + u["t"]).alias("s")))
        return 1 - v["front"] * F.aggregate(_steps(60 + 10 * F.sqrt(v["a"])), start, step, lambda s: s["s"])

    def fraction(v: Column) -> Column:
        b0 = v["x"] + 1 - v["a"]
        start = F.struct(F.lit(1 / _TINY).alias("c"), (1 / b0).alias("d"), (1 / b0).alias("h"))

        def step(s: Column, n: Column) -> Column:
            an, b = n * (v["a"] - n), b0 + 2 * n
            return _let({"c": _away(b + an / s["c"]), "d": 1 / _away(an * s["d"] + b), "h": s["h"]}, lambda u: F.struct(u["c"].alias("c"), u["d"].alias("d"), (u["h"] * u["c"] * u["d"]).alias("h")))

        return v["front"] * F.aggregate(_steps(100 + 10 * F.sqrt(v["a"])), start, step, lambda s: s["h"])

    front = F.exp(a * F.log(F.greatest(x, F.lit(_TINY))) - x - _lgamma(a))
    body = lambda v: F.when(v["x"] <= 0, F.lit(1.0)).when(v["x"] < v["a"] + 1, series(v)).otherwise(fraction(v))
    return F.least(F.greatest(_let({"a": a, "x": x, "front": front}, body), F.lit(0.0)), F.lit(1.0))


def chi2_sf(x: Column, degrees: Column) -> Column:
    """Upper tail of chi-square for any degrees above 0."""
    return gamma_sf(degrees.cast("double") / 2, x / 2)


def _beta_fraction(v: Column) -> Column:
    """The continued fraction of I_x(a, b) for x below (a + 1) / (a + b + 2)."""
    a, b, x = v["a"], v["b"], v["x"]
    d0 = 1 / _away(1 - (a + b) * x / (a + 1))
    start = F.struct(F.lit(1.0).alias("c"), d0.alias("d"), d0.alias("h"))

    def half(s: Column, coefficient: Column) -> Column:
        u = {"c": _away(1 + coefficient / s["c"]), "d": 1 / _away(1 + coefficient * s["d"]), "h": s["h"]}
        return _let(u, lambda w: F.struct(w["c"].alias("c"), w["d"].alias("d"), (w["h"] * w["c"] * w["d"]).alias("h")))

    def step(s: Column, m: Column) -> Column:
        even = half(s, m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)))
        return F.element_at(F.transform(F.array(even), lambda e: half(e, -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)))), 1)

    return F.aggregate(_steps(30 + 8 * F.sqrt(F.greatest(a, b))), start, step, lambda s: s["h"])


def _large_beta(v: Column) -> Column:
    w1, w2 = F.cbrt(v["b"] * v["x"]), F.cbrt(v["a"] * v["y"])
    z = 3 * (w1 * (1 - 1 / (9 * v["b"])) - w2 * (1 - 1 / (9 * v["a"]))) / F.sqrt(w1 * w1 / v["b"] + w2 * w2 / v["a"])
    half = _normal_tail(F.abs(z))
    return F.when(z > 0, 1 - half).otherwise(half)


def _normal_tail(t: Column) -> Column:
    """Upper tail of the standard normal at t >= 0, by the published rational approximation."""
    def horner(coefficients: tuple[float, ...], x: Column) -> Column:
        out = F.lit(coefficients[0])
        for c in coefficients[1:]:
            out = out * x + c
        return out

    def body(v: Column) -> Column:
        e = F.exp(-v["t"] * v["t"] / 2)
        tail = v["t"] + 0.65
        for k in (4, 3, 2, 1):
            tail = v["t"] + k / tail
        return F.when(v["t"] > 37, F.lit(0.0)).when(v["t"] < 7.07106781186547, e * horner(special._NUM, v["t"]) / horner(special._DEN, v["t"])).otherwise(e / tail / 2.506628274631)

    return _let({"t": t}, body)


def beta_cdf(x: Column, a: Column, b: Column) -> Column:
    """Regularised incomplete beta I_x(a, b) for a, b > 0; 0 below 0 and 1 above 1."""
    def body(v: Column) -> Column:
        front = F.exp(v["a"] * F.log(v["x"]) + v["b"] * F.log(v["y"]) - v["l"])
        direct = front * _beta_fraction(v) / v["a"]
        swapped = 1 - front * _let({"a": v["b"], "b": v["a"], "x": v["y"]}, _beta_fraction) / v["b"]
        exact = F.when(v["x"] < (v["a"] + 1) / (v["a"] + v["b"] + 2), direct).otherwise(swapped)
        return F.when(v["x"] <= 0, F.lit(0.0)).when(v["y"] <= 0, F.lit(1.0)).when(v["a"] + v["b"] > LARGE, _large_beta(v)).otherwise(exact)

    return F.least(F.greatest(_let({"x": x, "y": 1 - x, "a": a, "b": b, "l": lbeta(a, b)}, body), F.lit(0.0)), F.lit(1.0))


def t_p_value(t: Column, degrees: Column) -> Column:
    """Two-sided p of Student's t."""
    return beta_cdf(degrees / (degrees + t * t), degrees.cast("double") / 2, F.lit(0.5))


def f_sf(f: Column, d1: Column, d2: Column) -> Column:
    """Upper tail of the F distribution."""
    return F.when(f <= 0, F.lit(1.0)).otherwise(beta_cdf(d2 / (d2 + d1 * f), d2.cast("double") / 2, d1.cast("double") / 2))


def beta_log_density(x: Column, a: Column, b: Column) -> Column:
    """Log density of Beta(a, b) at 0 < x < 1."""
    return (a - 1) * F.log(x) + (b - 1) * F.log(1 - x) - lbeta(a, b)


def trigamma(x: Column) -> Column:
    """Trigamma of x > 0 by its asymptotic series at x + 8."""
    def series(v: Column) -> Column:
        y = v["x"] + 8
        steps = 1 / (v["x"] * v["x"])
        for k in range(1, 8):
            steps = steps + 1 / ((v["x"] + k) * (v["x"] + k))
        y2 = y * y
        return 1 / y + 0.5 / y2 + (1 / 6 - (1 / 30 - (1 / 42 - F.lit(1 / 30) / y2) / y2) / y2) / (y2 * y) + steps

    return _let({"x": x}, series)


def beta_llr_moments(a: Column, b: Column, da: Column, db: Column) -> tuple[Column, Column]:
    """Mean and variance, under Beta(a, b), of da log X + db log(1 - X)."""
    psi = lambda v: _let({"x": v}, lambda s: _digamma(s["x"]))
    s = a + b
    mean = da * (psi(a) - psi(s)) + db * (psi(b) - psi(s))
    ts = trigamma(s)
    var = da * da * (trigamma(a) - ts) + db * db * (trigamma(b) - ts) - 2 * da * db * ts
    return mean, F.greatest(var, F.lit(1e-12))


def _digamma(x: Column) -> Column:
    y = x + 8
    steps = 1 / x
    for k in range(1, 8):
        steps = steps + 1 / (x + k)
    y2 = y * y
    return F.log(y) - 0.5 / y - (1 / 12 - (1 / 120 - (1 / 252 - F.lit(1 / 240) / y2) / y2) / y2) / y2 - steps


def beta_overlap(a1: Column, b1: Column, a2: Column, b2: Column) -> Column:
    """Overlap of two Beta distributions by the Bhattacharyya coefficient of normals of their means and variances, 0 to 1."""
    moments = lambda a, b: (a / (a + b), a * b / ((a + b) * (a + b) * (a + b + 1)))
    (m1, v1), (m2, v2) = moments(a1, b1), moments(a2, b2)
    total = v1 + v2
    bc = F.exp(-(m1 - m2) * (m1 - m2) / (2 * total)) * F.sqrt(2 * F.sqrt(v1 * v2) / total)
    return F.when(total == 0, F.lit(1.0)).otherwise(F.least(F.greatest(bc, F.lit(0.0)), F.lit(1.0)))


# -- whole grids inside a task -----------------------------------------------------
def _lgamma_np(x: np.ndarray) -> np.ndarray:
    y = x + 8
    product = np.ones_like(x)
    for k in range(8):
        product = product * (x + k)
    y2 = y * y
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + (1 / 12 - (1 / 360 - (1 / 1260 - (1 / 1680 - 1 / 1188 / y2) / y2) / y2) / y2) / y - np.log(product)


def beta_grid(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """I_x(a, b) of every row's a and b at every x in [0, 1]."""
    x, a, b = np.broadcast_arrays(x[None, :], a[:, None], b[:, None])
    large = a[:, 0] + b[:, 0] > LARGE
    if large.any():
        out = np.empty(x.shape)
        out[~large] = beta_grid(x[0], a[~large, 0], b[~large, 0])
        x, a, b = x[large], a[large], b[large]
        w1, w2 = np.cbrt(b * x), np.cbrt(a * (1 - x))
        out[large] = normal_grid(3 * (w1 * (1 - 1 / (9 * b)) - w2 * (1 - 1 / (9 * a))) / np.sqrt(w1 * w1 / b + w2 * w2 / a))
        return out
    swap = x >= (a + 1) / (a + b + 2)
    x, a, b = np.where(swap, 1 - x, x), np.where(swap, b, a), np.where(swap, a, b)
    away = lambda v: np.where(np.abs(v) < _TINY, _TINY, v)
    c, d = np.ones_like(x), 1 / away(1 - (a + b) * x / (a + 1))
    h = d.copy()
    for m in range(1, 30 + int(8 * math.sqrt(max(a.max(initial=1), b.max(initial=1))))):
        before = h
        for k in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            c, d = away(1 + k / c), 1 / away(1 + k * d)
            h = h * c * d
        if np.all(np.abs(h - before) <= 1e-15 * np.abs(h)):
            break
    with np.errstate(divide="ignore"):
        front = np.exp(a * np.log(x) + b * np.log1p(-x) - (_lgamma_np(a) + _lgamma_np(b) - _lgamma_np(a + b)))
    part = np.where(x <= 0, 0.0, front * h / a)
    return np.clip(np.where(swap, 1 - part, part), 0, 1)


def normal_grid(z: np.ndarray) -> np.ndarray:
    """The standard normal distribution function by the published rational approximation."""
    t = np.abs(z)
    e = np.exp(-t * t / 2)
    tail = t + 0.65
    for k in (4, 3, 2, 1):
        tail = t + k / tail
    upper = np.where(t > 37, 0.0, np.where(t < 7.07106781186547, e * np.polyval(special._NUM, t) / np.polyval(special._DEN, t), e / tail / 2.506628274631))
    return np.where(z > 0, 1 - upper, upper)
