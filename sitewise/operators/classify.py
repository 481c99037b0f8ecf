"""Classifiers from sums: cross-validated accuracy with folds taken out of the totals, and the discriminant direction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import materialize
from .running import running

#: Least variance of a feature in a class.
MIN_VARIANCE = 1e-6


def stratified_folds(labels: DataFrame, folds: int) -> DataFrame:
    """(sample_id, label, fold): samples of a label dealt in the order of the MD5 of their id."""
    hashed = labels.select("sample_id", "label", F.md5(F.col("sample_id").cast("string")).alias("__h"))
    dealt = running(hashed, ["label"], ["__h", "sample_id"], {"__k": F.lit(1)})
    return dealt.select("sample_id", "label", ((F.col("__k") - 1) % folds).cast("int").alias("fold"))


def cross_validate(values: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """(fold, n, balanced_accuracy) of a Gaussian classifier fitted without the fold's samples.

    ``values`` holds (sample_id, feature_id, value), ``labels`` (sample_id, label). All folds are
    fitted from one pass: count, sum and sum of squares by fold, label and feature; a fold's
    model is the total less its own sums. Features are independent within a class, with the
    class's share as prior; a value that is missing, or a feature that a class lacks, says
    nothing. Ties go to the smaller label. Balanced accuracy is the mean recall of the labels
    that the fold holds. Samples without a label or value do not count; fewer folds are made
    where a label has fewer samples than folds, and none where one has a single sample.
    """
    sizes = [r.n for r in labels.groupBy("label").agg(F.count("*").alias("n")).collect()]
    folds = min([folds, *sizes]) if sizes else 0
    schema = "fold int, n long, balanced_accuracy double"
    if folds < 2:
        return values.sparkSession.createDataFrame([], schema)
    dealt = materialize(stratified_folds(labels, folds), "folds")
    rows = values.where(F.col("value").isNotNull()).join(dealt, "sample_id")
    sums = materialize(rows.groupBy("fold", "label", "feature_id").agg(F.count("*").alias("n"), F.sum("value").alias("s"), F.sum(F.col("value") * F.col("value")).alias("q")), "fold-sums")
    total = sums.groupBy("label", "feature_id").agg(*[F.sum(c).alias(f"t{c}") for c in "nsq"])
    # A label that a fold lacks for a feature keeps the whole total there.
    every = total.crossJoin(F.broadcast(dealt.select("fold").distinct()))  # a row a fold, folds are few by the argument
    held = every.join(sums, ["fold", "label", "feature_id"], "left")
    left = lambda c: F.col(f"t{c}") - F.coalesce(c, F.lit(0))
    n = left("n")
    mean = left("s") / n
    variance = F.greatest(left("q") / n - mean * mean, F.lit(MIN_VARIANCE))
    model = held.where(n > 0).select("fold", "label", "feature_id", mean.alias("mean"), variance.alias("variance"))
    by_fold = dealt.groupBy("fold", "label").agg(F.count("*").alias("n"))
    prior = dealt.groupBy("label").agg(F.count("*").alias("t")).crossJoin(F.broadcast(dealt.select("fold").distinct())).join(by_fold, ["fold", "label"], "left")
    prior = prior.select("fold", F.col("label").alias("guess"), (F.col("t") - F.coalesce("n", F.lit(0))).alias("left")).where("left > 0").select("fold", "guess", F.log("left").alias("prior"))
    density = -0.5 * F.log(2 * np.pi * F.col("variance")) - F.pow(F.col("value") - F.col("mean"), F.lit(2)) / (2 * F.col("variance"))
    scored = rows.select("fold", "sample_id", F.col("label").alias("truth"), "feature_id", "value").join(model.withColumnRenamed("label", "guess"), ["fold", "feature_id"])
    scored = scored.groupBy("fold", "sample_id", "truth", "guess").agg(F.sum(density).alias("score")).join(prior, ["fold", "guess"])
    best = scored.groupBy("fold", "sample_id", "truth").agg(F.min(F.struct((-(F.col("score") + F.col("prior"))).alias("s"), "guess")).alias("b"))
    recall = best.groupBy("fold", "truth").agg(F.count("*").alias("n"), F.avg((F.col("b.guess") == F.col("truth")).cast("double")).alias("recall"))
    return recall.groupBy("fold").agg(F.sum("n").alias("n"), F.avg("recall").alias("balanced_accuracy"))


def scatter(rows: DataFrame, features: Column, label: Column) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """Count, sum and matrix of products of each label's complete feature vectors.

    Each task adds up its own rows; the shuffle holds one row of the matrix for each task, label
    and feature, and the driver one matrix a label.
    """
    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list] = {}
        for b in batches:
            for k, part in b.groupby("k"):
                x = np.stack(part["x"].to_list())
                x = x[np.isfinite(x).all(1)]
                aug = np.hstack([np.ones((len(x), 1)), x])
                held[int(k)] = held.get(int(k), 0) + aug.T @ aug
        for k, m in held.items():
            for i, row in enumerate(m):
                yield pd.DataFrame({"k": [k], "i": [i], "row": [row]})

    parts = rows.select(label.cast("int").alias("k"), features.cast("array<double>").alias("x")).where("k is not null and x is not null and not exists(x, v -> v is null)")
    long = parts.mapInPandas(add, "k int, i int, row array<double>").select("k", "i", F.posexplode("row").alias("j", "v"))
    out: dict[int, np.ndarray] = {}
    found = long.groupBy("k", "i", "j").agg(F.sum("v").alias("v")).toPandas()
    for k, part in found.groupby("k"):
        size = int(part["i"].max()) + 1
        m = np.zeros((size, size))
        m[part["i"], part["j"]] = part["v"]
        out[int(k)] = m
    return {k: (int(round(m[0, 0])), m[0, 1:], m[1:, 1:]) for k, m in out.items()}


def discriminant_direction(rows: DataFrame, features: Column, label: Column, ridge: float = 1e-6) -> np.ndarray:
    """Unit direction that parts label 1 from label 0: the inverse of the labels' summed covariances on the difference of means.

    Raises with fewer than two rows of a label or without any difference. Vectors with a null or
    infinite entry do not count.
    """
    found = scatter(rows, features, label)
    if any(found.get(k, (0,))[0] < 2 for k in (0, 1)):
        raise ValueError("each label needs two complete rows")
    mean = {k: s / n for k, (n, s, _) in found.items()}
    within = sum((m - n * np.outer(mean[k], mean[k])) / (n - 1) for k, (n, _, m) in found.items() if k in (0, 1))
    d = np.linalg.solve(within + ridge * np.eye(len(within)), mean[1] - mean[0])
    size = np.linalg.norm(d)
    if size < 1e-12:
        raise ValueError("the labels' means do not differ")
    return d / size


def project(rows: DataFrame, features: str, direction: np.ndarray, to: str = "projection", rest: str = "residual") -> DataFrame:
    """Adds each vector's coordinate along the direction, and the vector without it; null vectors give nulls."""
    d = F.array(*[F.lit(float(v)) for v in direction])
    dot = F.aggregate(F.zip_with(features, d, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    out = rows.withColumn(to, dot)
    return out.withColumn(rest, F.zip_with(features, d, lambda a, b: a - F.col(to) * b))
