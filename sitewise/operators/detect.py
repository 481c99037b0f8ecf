"""Two-cohort detection of differential sites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import histograms as H
from ..functions import special
from ..shared import materialize
from . import centroid, fdr
from .running import quantiles, running

KEY = centroid.KEY


def align(a: DataFrame, b: DataFrame, min_coverage: int = 1) -> DataFrame:
    """Sites that both cohorts have with enough total coverage; columns suffixed 1 and 2."""
    def side(df: DataFrame, k: int) -> DataFrame:
        ok = df.where(F.col("Sm") + F.col("Su") >= min_coverage)
        return ok.select(*KEY, centroid.mean().alias(f"mean{k}"), centroid.variance().alias(f"var{k}"), F.col("N").alias(f"n{k}"), F.col("bin_counts").alias(f"h{k}"))

    return side(a, 1).join(side(b, 2), KEY)


def gate(pairs: DataFrame, min_samples: int = 2, min_delta: float = 0.0) -> DataFrame:
    """Enough samples on both sides and a mean difference worth testing; stands before the array work."""
    return pairs.where((F.col("n1") >= min_samples) & (F.col("n2") >= min_samples) & (F.abs(F.col("mean1") - F.col("mean2")) >= min_delta))


def min_samples(cohort_size: int, absolute: int, percent: float) -> int:
    """The larger of an absolute number and a share of the cohort."""
    return max(absolute, int(percent * cohort_size))


def with_mann_whitney(pairs: DataFrame) -> DataFrame:
    """Adds u_stat, z_stat and the two-sided p_value with tie correction."""
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    n = n1 + n2
    ties = F.col("__ties") / F.greatest(n * F.greatest(n - 1, F.lit(0.0)), F.lit(1.0))
    var = n1 * n2 / 12 * F.greatest(n + 1 - ties, F.lit(0.0))
    rows = pairs.withColumn("u_stat", H.mann_whitney_u(F.col("h1"), F.col("h2"))).withColumn("__ties", H.tie_sum(F.col("h1"), F.col("h2"))).withColumn("__var", var)
    rows = rows.withColumn("z_stat", F.when(F.col("__var") > 0, (F.col("u_stat") - n1 * n2 / 2) / F.sqrt("__var")).otherwise(F.lit(0.0)))
    p = F.expr(f"CASE WHEN __var > 0 THEN greatest(least(2 * {special.norm_sf('abs(z_stat)')}, 1E0), 1E-300) ELSE 1E0 END")
    return rows.withColumn("p_value", p).drop("__ties", "__var")


def with_ks(pairs: DataFrame) -> DataFrame:
    """Adds ks_stat on the interpolated grid and ks_p at the harmonic mean of the sizes."""
    rows = pairs.withColumn("ks_stat", H.ks_statistic(F.col("h1"), F.col("h2")))
    return rows.withColumn("__x", F.sqrt(2 / (1 / F.greatest("n1", F.lit(1)) + 1 / F.greatest("n2", F.lit(1)))) * F.col("ks_stat")).withColumn(
        "ks_p", F.expr(special.kolmogorov_sf("__x"))).drop("__x")


def with_overlap(pairs: DataFrame) -> DataFrame:
    """Adds the Bhattacharyya overlap of the interpolated distributions."""
    return pairs.withColumn("overlap", H.bhattacharyya(F.col("h1"), F.col("h2")))


def mean_level_weight(level: Column, mode: str = "saturating", k: float = 0.08) -> Column:
    mu = F.least(F.greatest(level, F.lit(0.0)), F.lit(1.0))
    if mode == "sqrt":
        return F.sqrt(mu)
    if mode == "linear":
        return mu
    if mode == "saturating":
        return F.when(mu > 0, mu / (mu + k)).otherwise(F.lit(0.0))
    if mode == "boundary":
        return F.least(F.lit(1.0), mu / k) if k > 0 else F.lit(1.0)
    return F.lit(1.0)


def effect_size(delta: Column, overlap: Column, var1: Column, var2: Column, lambda_var: float = 2.0, weight: Column | None = None) -> Column:
    """|delta| * (1 - overlap) * exp(-lambda (sd1 + sd2)), optionally weighted, clipped to 0..1."""
    clipped = F.least(F.greatest(overlap, F.lit(0.0)), F.lit(1.0))
    value = F.abs(delta) * (1 - clipped) * F.exp(-lambda_var * (F.sqrt(F.greatest(var1, F.lit(0.0))) + F.sqrt(F.greatest(var2, F.lit(0.0)))))
    return F.least(F.greatest(value * weight if weight is not None else value, F.lit(0.0)), F.lit(1.0))


def compare(a: DataFrame, b: DataFrame, min_samples: int = 2, min_delta: float = 0.0, min_coverage: int = 1) -> DataFrame:
    """Tests every common site and controls discoveries within each (chrom, context)."""
    tested = with_overlap(with_mann_whitney(gate(align(a, b, min_coverage), min_samples, min_delta)))
    rows = tested.select(
        *KEY, "n1", "n2", "mean1", "mean2", F.abs(F.col("mean1") - F.col("mean2")).alias("delta_mean"),
        F.signum(F.col("mean2") - F.col("mean1")).alias("delta_sign"), "z_stat", "p_value", "overlap",
        effect_size(F.col("mean1") - F.col("mean2"), F.col("overlap"), F.col("var1"), F.col("var2")).alias("effect_size"))
    rows = materialize(rows, "tested")  # read three times by the steps of the q-values
    return fdr.storey_pair(rows, "p_value", ["chrom", "context"])


def select_by_mass(df: DataFrame, value: str, share: float, by: list[str]) -> DataFrame:
    """Rows of largest value, ties by site, up to and with the one that reaches the share of the group's total."""
    run = running(df, by, [F.desc(value), "chrom", "context", "pos"], {"__upto": value})
    whole = df.groupBy(*by).agg(F.sum(value).alias("__all"))
    run = run.join(whole, by) if by else run.crossJoin(F.broadcast(whole))  # one row
    return run.where(F.col("__upto") - F.col(value) < share * F.col("__all")).select(df.columns)


def regions(sites: DataFrame, q: str, threshold: float, max_gap: int) -> DataFrame:
    """Runs of significant sites with gaps of at most ``max_gap``, by chromosome and context."""
    w = Window.partitionBy("chrom", "context").orderBy("pos")
    hit = sites.where(F.col(q) <= threshold).withColumn("__new", F.coalesce((F.col("pos") - F.lag("pos").over(w) > max_gap).cast("int"), F.lit(1)))
    island = hit.withColumn("region", F.sum("__new").over(w))
    return island.groupBy("chrom", "context", "region").agg(
        F.min("pos").alias("region_start"), F.max("pos").alias("region_end"), F.count("*").alias("n_sites"), F.avg("delta_mean").alias("mean_delta"), F.min(q).alias("min_q"))


def elbow(df: DataFrame, value: str, by: list[str], log_eps: float | None = None) -> DataFrame:
    """Rank of the interior point farthest from the chord, on x and y scaled to 0..1; the first on ties."""
    y = F.log(F.col(value) + log_eps) if log_eps is not None else F.col(value).cast("double")
    counts = df.groupBy(*by, F.col(value)).agg(F.count("*").alias("__n"))
    placed = running(counts, by, [F.desc(value)], {"__last": "__n"}).withColumn("y", y)
    whole = placed.groupBy(*by).agg(F.max("__last").alias("n"), F.min("y").alias("lo"), F.max("y").alias("hi"))
    # On a run of equal values the distance is linear in the rank, so its two ends suffice.
    r = placed.join(whole, by).withColumn("rank", F.explode(F.array_distinct(F.array(F.col("__last") - F.col("__n") + 1, F.col("__last")))))
    lo, hi = F.col("lo"), F.col("hi")
    s = r.withColumn("x", (F.col("rank") - 1) / F.greatest(F.col("n") - 1, F.lit(1))).withColumn("ys", F.when(hi > lo, (F.col("y") - lo) / (hi - lo)).otherwise(F.lit(0.0)))
    ends = s.groupBy(*by).agg(F.max_by("ys", F.struct("x")).alias("y_last"), F.min_by("ys", F.struct("x")).alias("y_first"))
    d = s.join(ends, by).withColumn("d", F.abs((F.col("y_last") - F.col("y_first")) * F.col("x") - F.col("ys") + F.col("y_first")) / F.sqrt(1 + F.pow(F.col("y_last") - F.col("y_first"), F.lit(2))))
    inner = d.where((F.col("rank") > 1) & (F.col("rank") < F.col("n")))
    return inner.groupBy(*by).agg(F.max(F.struct(F.round("d", 12).alias("d"), (-F.col("rank")).alias("r"), F.col(value).alias("v"))).alias("m")).select(
        *by, (-F.col("m.r")).cast("long").alias("elbow_rank"), F.col("m.v").alias("cutoff"))


def funnel(df: DataFrame, passed: Column) -> DataFrame:
    """Entered, passed and retained share, in total, by chromosome and by context."""
    r = df.withColumn("__ok", F.coalesce(passed, F.lit(False))).rollup("chrom", "context").agg(F.count("*").alias("entered"), F.count_if("__ok").alias("passed"))
    return r.withColumn("retained", F.col("passed") / F.col("entered"))


def context_weights(df: DataFrame, value: str, trim: float = 0.1, inverse: bool = False) -> DataFrame:
    """Mean of each context without its lowest and highest shares, scaled to sum 1."""
    q = quantiles(df, value, {"lo": trim, "hi": 1 - trim}, ["context"])
    m = df.join(q, "context").where(F.col(value).between(F.col("lo"), F.col("hi"))).groupBy("context").agg(F.avg(value).alias("m"))
    w = (1 / F.greatest("m", F.lit(1e-12))) if inverse else F.col("m")
    total = m.agg(F.sum(w).alias("t"))
    return m.crossJoin(F.broadcast(total)).select("context", F.col("m").alias("trimmed_mean"), (w / F.col("t")).alias("weight"))
