"""Covariate adjustment, feature matrices, compositions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .centroid import KEY, level
from .running import quantiles


def fit_covariate(values: DataFrame, covariate: DataFrame, x: str, by: list[str] | None = None, y: str = "m") -> DataFrame:
    """Least-squares slope and intercept of y on one covariate for each site, complete cases only."""
    j = values.join(covariate.select("sample_id", F.col(x).alias("__x")), "sample_id").where("__x is not null")
    return j.groupBy(*(by or KEY)).agg(F.count("*").alias("n"), F.regr_slope(y, "__x").alias("slope"), F.regr_intercept(y, "__x").alias("intercept"))


def residualize(values: DataFrame, covariate: DataFrame, coefficients: DataFrame, x: str, by: list[str] | None = None, y: str = "m") -> DataFrame:
    """y minus intercept and slope * x where both are known, else y as it was."""
    j = values.join(covariate.select("sample_id", F.col(x).alias("__x")), "sample_id", "left").join(coefficients.select(*(by or KEY), "slope", "intercept"), by or KEY, "left")
    known = F.col("slope").isNotNull() & F.col("__x").isNotNull()
    return j.withColumn("residual", F.when(known, F.col(y) - F.col("intercept") - F.col("slope") * F.col("__x")).otherwise(F.col(y))).drop("__x", "slope", "intercept")


def cpm(features: DataFrame) -> DataFrame:
    """Counts per million of each sample and their log2 with one added."""
    total = features.groupBy("sample_id").agg(F.sum("value").alias("__t"))
    scaled = F.when(F.col("__t") > 0, F.col("value") / F.col("__t") * 1e6).otherwise(F.lit(0.0))
    return features.join(total, "sample_id").select("sample_id", "feature_id", "value", scaled.alias("cpm"), F.log2(scaled + 1).alias("logcpm"))


def median_normalize(features: DataFrame) -> DataFrame:
    """Values scaled so that all samples share the median of the samples' medians."""
    m = features.groupBy("sample_id").agg(F.percentile("value", 0.5).alias("__m"))
    g = m.agg(F.percentile("__m", 0.5).alias("__g"))
    return features.join(m.crossJoin(F.broadcast(g)), "sample_id").select("sample_id", "feature_id", F.when(F.col("__m") > 0, F.col("value") * F.col("__g") / F.col("__m")).otherwise(F.col("value")).alias("normalized"))


def quantile_normalize(features: DataFrame) -> DataFrame:
    """Each value replaced by the mean over samples of the values of its rank."""
    r = features.withColumn("rank", F.row_number().over(Window.partitionBy("sample_id").orderBy("value", "feature_id")))
    means = r.groupBy("rank").agg(F.avg("value").alias("normalized"))
    return r.join(means, "rank").select("sample_id", "feature_id", "normalized")


def complete(features: DataFrame, fill: str = "min") -> DataFrame:
    """All sample by feature pairs, the absent ones filled with 0, the feature's least or its mean."""
    samples = features.select("sample_id").distinct()
    of = features.groupBy("feature_id").agg(F.min("value").alias("min"), F.avg("value").alias("mean")).withColumn("zero", F.lit(0.0))
    grid = samples.crossJoin(of)  # the dense matrix that is asked for
    return grid.join(features, ["sample_id", "feature_id"], "left").select("sample_id", "feature_id", F.coalesce("value", fill).alias("value"), F.col("value").isNull().alias("filled"))


def differential(features: DataFrame, group: Column) -> DataFrame:
    """Welch t, log2 fold change and means of two groups for every feature."""
    g = features.withColumn("g", group).groupBy("feature_id").agg(*[
        f(F.when(F.col("g") == k, F.col("value"))).alias(f"{n}{k}") for k in (0, 1) for n, f in (("n", F.count), ("mean", F.avg), ("var", F.var_samp))])
    se = F.sqrt(F.col("var0") / F.col("n0") + F.col("var1") / F.col("n1"))
    return g.select("feature_id", "n0", "n1", "mean0", "mean1", F.log2((F.col("mean1") + 1) / (F.col("mean0") + 1)).alias("log2_fc"), F.when(se > 0, (F.col("mean1") - F.col("mean0")) / se).alias("welch_t"))


def min_max(features: DataFrame) -> DataFrame:
    """Values scaled to 0..1 by the feature's range."""
    r = features.groupBy("feature_id").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    return features.join(r, "feature_id").select("sample_id", "feature_id", F.when(F.col("hi") > F.col("lo"), (F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo"))).otherwise(F.lit(0.0)).alias("scaled"))


def log_ratios(composition: DataFrame, reference: str, pseudocount: float = 1e-6) -> DataFrame:
    """Additive log-ratios to a reference part and centred log-ratios of closed compositions."""
    w = Window.partitionBy("sample_id")
    c = composition.withColumn("s", F.col("share") + pseudocount)
    c = c.withColumn("s", F.col("s") / F.sum("s").over(w))
    ref = F.max(F.when(F.col("part") == reference, F.log("s"))).over(w)
    return c.select("sample_id", "part", (F.log("s") - ref).alias("alr"), (F.log("s") - F.avg(F.log("s")).over(w)).alias("clr"))


def standardize(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns with missing values at the median, centred and scaled by the population deviation."""
    med = reduce(lambda x, y: x.crossJoin(F.broadcast(y)), [quantiles(df, c, {f"__m_{c}": 0.5}) for c in columns])  # one row each
    filled = df.crossJoin(F.broadcast(med)).withColumns({c: F.coalesce(F.col(c), F.col(f"__m_{c}")) for c in columns}).drop(*[f"__m_{c}" for c in columns])
    st = filled.agg(*[x for c in columns for x in (F.avg(c).alias(f"__a_{c}"), F.stddev_pop(c).alias(f"__s_{c}"))])
    scaled = filled.crossJoin(F.broadcast(st))
    return scaled.withColumns({c: F.when(F.col(f"__s_{c}") > 0, (F.col(c) - F.col(f"__a_{c}")) / F.col(f"__s_{c}")).otherwise(F.lit(0.0)) for c in columns}).drop(*[f"__{k}_{c}" for k in "as" for c in columns])


def panel_score(counts: DataFrame, panel: DataFrame, intercept: float, min_share: float = 0.5) -> DataFrame:
    """Intercept + sum of weight * level over a panel's sites, with observed share and status."""
    size = panel.agg(F.count("*").alias("__n"))
    j = counts.select("sample_id", *KEY, level().alias("x")).join(panel, KEY)
    g = j.groupBy("sample_id").agg(F.count("*").alias("n_observed"), F.sum(F.col("w") * F.col("x")).alias("s")).crossJoin(F.broadcast(size))
    share = F.col("n_observed") / F.col("__n")
    return g.select("sample_id", "n_observed", (F.col("s") + intercept).alias("score"), share.alias("observed_share"), F.when(share >= min_share, "ok").otherwise("low_coverage").alias("status"))


def sample_size(delta: str, sd: str, z_alpha: float = 1.959963984540054, z_power: float = 0.8416212335729143) -> Column:
    """Samples per group for a two-sample comparison, normal approximation; Cohen's d clipped to 0.02..10."""
    d = F.least(F.greatest(F.abs(F.col(delta)) / F.col(sd), F.lit(0.02)), F.lit(10.0))
    return F.ceil(2 * F.pow((z_alpha + z_power) / d, F.lit(2)))
