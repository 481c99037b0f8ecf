"""Special functions as SQL expressions, for ``F.expr`` and, where wanted, a SQL twin.

Arguments are SQL expressions as text. Coefficients are published fixed values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Hart's rational approximation of the normal tail, as published by West (2005).
_NUM = (3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871, 221.213596169931, 220.206867912376)
_DEN = (8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752)
#: Acklam's rational approximation of the normal quantile; relative error below 1.2e-9.
_A = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02, 1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00)
_B = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02, 6.680131188771972e+01, -1.328068155288572e+01, 1.0)
_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00, -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00)
_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661907416e+00, 1.0)


def number(v: float) -> str:
    """A double literal in both dialects."""
    return f"CAST('{v!r}' AS DOUBLE)"


def poly(coefficients: tuple[float, ...], x: str) -> str:
    """Horner form, highest power first."""
    out = number(coefficients[0])
    for c in coefficients[1:]:
        out = f"({out} * {x} + {number(c)})"
    return out


def norm_sf(x: str) -> str:
    """Upper tail of the standard normal."""
    a = f"abs({x})"
    tail = a + " + 0.65E0"
    for k in (4, 3, 2, 1):
        tail = f"{a} + {k}E0 / ({tail})"
    lower = (
        f"CASE WHEN {a} > 37 THEN 0E0 WHEN {a} < 7.07106781186547E0 THEN exp(-({x}) * ({x}) / 2) * {poly(_NUM, a)} / {poly(_DEN, a)} "
        f"ELSE exp(-({x}) * ({x}) / 2) / ({tail}) / 2.506628274631E0 END"
    )
    return f"(CASE WHEN {x} > 0 THEN {lower} ELSE 1E0 - {lower} END)"


def norm_ppf(p: str) -> str:
    """Quantile of the standard normal for 0 < p < 1."""
    q, r = f"(({p}) - 0.5E0)", f"((({p}) - 0.5E0) * (({p}) - 0.5E0))"
    low, high = f"sqrt(-2E0 * ln({p}))", f"sqrt(-2E0 * ln(1E0 - ({p})))"
    return (
        f"(CASE WHEN ({p}) < 0.02425E0 THEN {poly(_C, low)} / {poly(_D, low)} "
        f"WHEN ({p}) > 0.97575E0 THEN -({poly(_C, high)} / {poly(_D, high)}) "
        f"ELSE {poly(_A, r)} * {q} / {poly(_B, r)} END)"
    )


def lgamma(x: str) -> str:
    """Log gamma for x > 0 by Stirling's series at x + 8."""
    y = f"(({x}) + 8E0)"
    product = " * ".join(f"(({x}) + {k}E0)" for k in range(8))
    series = f"(1E0 / 12 - (1E0 / 360 - (1E0 / 1260 - 1E0 / 1680 / ({y} * {y})) / ({y} * {y})) / ({y} * {y})) / {y}"
    return f"(({y} - 0.5E0) * ln({y}) - {y} + 0.91893853320467274178E0 + {series} - ln({product}))"


def digamma(x: str) -> str:
    """Digamma for x > 0 by its asymptotic series at x + 8."""
    y = f"(({x}) + 8E0)"
    steps = " + ".join(f"1E0 / (({x}) + {k}E0)" for k in range(8))
    series = f"(1E0 / 12 - (1E0 / 120 - (1E0 / 252 - 1E0 / 240 / ({y} * {y})) / ({y} * {y})) / ({y} * {y})) / ({y} * {y})"
    return f"(ln({y}) - 0.5E0 / {y} - {series} - ({steps}))"


def lbeta(a: str, b: str) -> str:
    return f"({lgamma(a)} + {lgamma(b)} - {lgamma(f'({a}) + ({b})')})"


def chi2_sf_even(x: str, k: str) -> str:
    """Upper tail of chi-square with 2 * k degrees, k whole: a Poisson sum of k terms, in Spark SQL."""
    h = f"(({x}) / 2E0)"
    log_term = f"i * ln({h}) - {h} - {lgamma('(i + 1E0)')}"
    return f"(CASE WHEN ({x}) <= 0 THEN 1E0 ELSE least(1E0, aggregate(transform(sequence(0, CAST(({k}) AS INT) - 1), i -> exp({log_term})), 0E0, (s, t) -> s + t)) END)"


def kolmogorov_sf(x: str, terms: int = 40) -> str:
    """Tail of the Kolmogorov distribution by its alternating series; 1 below 0.2."""
    total = " + ".join(f"{'-' if k % 2 == 0 else ''}exp(-2E0 * {k * k} * ({x}) * ({x}))" for k in range(1, terms + 1)).replace("+ -", "- ")
    return f"(CASE WHEN ({x}) < 0.2E0 THEN 1E0 ELSE greatest(0E0, least(1E0, 2E0 * ({total}))) END)"


def col(expression: str) -> Column:
    return F.expr(expression)
