"""Derived features of a sample against class centroids, by chromosome and over all, and their frozen schema."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import histograms as H
from .centroid import KEY, coverage, level, level_bin
from .running import quantiles

BINS = 20


def _shares(h: Column) -> Column:
    return H.shares(h)


def class_histograms(centroids: DataFrame, panel: DataFrame, label: str, classes: list[str], hist: str = "bin_counts", bins: int = BINS) -> DataFrame:
    """(chrom, site_weight, h0, h1, ...): mean bin shares of each class over the panel's sites of a chromosome.

    ``panel`` holds (site, weight). A site counts alike whatever its samples; a class without
    any site of a chromosome has null there. ``site_weight`` is the sum of the panel's weights.
    """
    j = centroids.where(H.total(F.col(hist)) > 0).select(*KEY, F.col(label).alias("__k"), F.posexplode(_shares(F.col(hist))).alias("__b", "__p")).join(panel.select(*KEY), KEY)
    of = lambda k: F.array(*[F.avg(F.when((F.col("__k") == k) & (F.col("__b") == b), F.col("__p"))) for b in range(bins)])
    g = j.groupBy("chrom").agg(*[of(c).alias(f"h{i}") for i, c in enumerate(classes)])
    g = g.select("chrom", *[F.when(F.element_at(f"h{i}", 1).isNotNull(), F.col(f"h{i}")).alias(f"h{i}") for i in range(len(classes))])
    weights = panel.groupBy("chrom").agg(F.sum(F.abs("weight")).alias("site_weight"))
    return weights.join(g, "chrom", "left")


def _binary_entropy(x: Column) -> Column:
    p = F.least(F.greatest(x, F.lit(1e-10)), F.lit(1 - 1e-10))
    return -(p * F.log2(p) + (1 - p) * F.log2(1 - p))


def _measures(bins: int, hypo: float, low: float, high: float) -> list[Column]:
    w, x = F.abs(F.col("weight")), F.col("x")
    share = lambda c: F.sum(F.when(c, w).otherwise(F.lit(0.0))) / F.sum(w)
    return [
        F.sum(w).alias("__w"), (F.sum(w * x) / F.sum(w)).alias("mean_beta"), (F.sum(w * _binary_entropy(x)) / F.sum(w)).alias("entropy"),
        share(x <= hypo).alias("hypo_fraction"), share(x.between(low, high)).alias("intermediate_fraction"),
        F.array(*[F.sum(F.when(F.col("bin") == b, w).otherwise(F.lit(0.0))) for b in range(bins)]).alias("__h")]


def chromosome_features(counts: DataFrame, panel: DataFrame, reference: DataFrame, classes: list[str], hypo: float = 0.2, low: float = 0.2, high: float = 0.8, bins: int = BINS) -> DataFrame:
    """(sample_id, chrom, measures, distances to each class) of each sample and chromosome, and over all with chrom '*'.

    Measures are weighted by the panel: mean level, entropy, shares of low and middle levels,
    and the share of the panel's weight that the sample covers. Distances are Hellinger,
    transport (Wasserstein) and Jensen-Shannon (square root, bits) between the sample's weighted
    histogram, which need not have the same mass, and the class's; ``js_margin`` is that to the
    first class less that to the second. Over all, a class's histogram is that of its chromosomes
    weighted by the panel. Uncovered rows do not count; where a class has no histogram its
    distances are null. One aggregate by (sample, chromosome), then one by sample over its few rows.
    """
    rows = counts.where(coverage() > 0).select("sample_id", *KEY, level().alias("x"), level_bin(bins).alias("bin")).join(panel.select(*KEY, F.abs(F.col("weight")).alias("weight")), KEY).where("weight > 0")
    by_chrom = rows.groupBy("sample_id", "chrom").agg(*_measures(bins, hypo, low, high))
    weigh = lambda c: F.sum(F.col("__w") * F.col(c)) / F.sum("__w")
    names = ["mean_beta", "entropy", "hypo_fraction", "intermediate_fraction"]
    whole = by_chrom.groupBy("sample_id").agg(F.sum("__w").alias("__w"), *[weigh(c).alias(c) for c in names], F.array(*[F.sum(F.element_at("__h", b + 1)) for b in range(bins)]).alias("__h"))
    whole = whole.select("sample_id", F.lit("*").alias("chrom"), "__w", *names, "__h")
    pooled = lambda i: F.array(*[F.sum(F.when(F.col(f"h{i}").isNotNull(), F.col("site_weight") * F.element_at(f"h{i}", b + 1))) / F.sum(F.when(F.col(f"h{i}").isNotNull(), F.col("site_weight"))) for b in range(bins)])
    everywhere = reference.agg(F.sum("site_weight").alias("site_weight"), *[pooled(i).alias(f"h{i}") for i in range(len(classes))])
    everywhere = everywhere.select(F.lit("*").alias("chrom"), "site_weight", *[F.when(F.element_at(f"h{i}", 1).isNotNull(), F.col(f"h{i}")).alias(f"h{i}") for i in range(len(classes))])
    refs = reference.select("chrom", "site_weight", *[f"h{i}" for i in range(len(classes))]).unionByName(everywhere)
    j = by_chrom.select("sample_id", "chrom", "__w", *names, "__h").unionByName(whole).join(refs, "chrom")
    distances = {}
    for i, c in enumerate(classes):
        h = F.col(f"h{i}")
        for name, value in (("hellinger", H.hellinger(F.col("__h"), h)), ("wasserstein", H.wasserstein(F.col("__h"), h, bins)), ("js", F.sqrt(F.greatest(H.jensen_shannon(F.col("__h"), h), F.lit(0.0))))):
            distances[f"{name}_{c}"] = F.when(h.isNotNull(), value)
    out = j.select("sample_id", "chrom", *names, (F.col("__w") / F.col("site_weight")).alias("observed_fraction"), *[v.alias(n) for n, v in distances.items()])
    return out.withColumn("js_margin", F.col(f"js_{classes[0]}") - F.col(f"js_{classes[1]}")) if len(classes) > 1 else out


def long_features(features: DataFrame) -> DataFrame:
    """(sample_id, feature, value): one row a measure, named ``chromosome::measure``."""
    names = [c for c in features.columns if c not in ("sample_id", "chrom")]
    pairs = F.array(*[F.struct(F.concat(F.col("chrom"), F.lit(f"::{c}")).alias("feature"), F.col(c).cast("double").alias("value")) for c in names])
    return features.select("sample_id", F.explode(pairs).alias("__p")).select("sample_id", "__p.*")


@dataclass
class FrozenSchema:
    """A fitted table (place, feature, fill, low, high): the features of the training rows in order, with medians and ranges."""

    table: DataFrame

    @classmethod
    def fit(cls, long: DataFrame) -> FrozenSchema:
        """Of (sample_id, feature, value): every feature that has a value in the training rows, by name."""
        known = long.where(F.col("value").isNotNull() & ~F.isnan("value"))
        ends = known.groupBy("feature").agg(F.min("value").alias("low"), F.max("value").alias("high"))
        table = quantiles(known, "value", {"fill": 0.5}, ["feature"]).join(ends, "feature")
        # One row for each feature of one sample: a short table.
        from pyspark.sql import Window

        return cls(table.select((F.row_number().over(Window.orderBy("feature")) - 1).cast("int").alias("place"), "feature", "fill", "low", "high"))

    def write(self, path: str) -> None:
        self.table.coalesce(1).write.mode("errorifexists").parquet(path)

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> FrozenSchema:
        return cls(spark.read.schema("place int, feature string, fill double, low double, high double").parquet(path))

    def apply(self, long: DataFrame) -> DataFrame:
        """(sample_id, features, n_filled, n_clipped, n_unknown) of each sample, without fitting anything.

        ``features`` has the schema's order. A feature that a sample lacks, or has null or not a
        number, gets the training median; a value outside the training range its nearer end;
        a feature that training did not have is left out and counted. A feature given twice
        counts once, with its least value.
        """
        once = long.groupBy("sample_id", "feature").agg(F.min("value").alias("value"))
        known = once.join(self.table.select("feature", F.lit(True).alias("__known")), "feature", "left")
        unknown = known.groupBy("sample_id").agg(F.count_if(F.col("__known").isNull()).alias("n_unknown"))
        # Each sample gets every feature of the schema: dense by nature, the schema is what one sample has.
        grid = once.select("sample_id").distinct().crossJoin(self.table)
        j = grid.join(once, ["sample_id", "feature"], "left")
        usable = F.col("value").isNotNull() & ~F.isnan("value")
        value = F.when(usable, F.least(F.greatest(F.col("value"), F.col("low")), F.col("high"))).otherwise(F.col("fill"))
        g = j.groupBy("sample_id").agg(
            F.transform(F.sort_array(F.collect_list(F.struct("place", value.alias("v")))), lambda s: s["v"]).alias("features"),
            F.count_if(~usable).alias("n_filled"), F.count_if(usable & ((F.col("value") < F.col("low")) | (F.col("value") > F.col("high")))).alias("n_clipped"))
        return g.join(unknown, "sample_id")
