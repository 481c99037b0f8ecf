"""Clusters of samples around K centroids of Beta-distributed sites: assign by likelihood, update by sums."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.incomplete import lbeta
from ..shared import materialize
from .centroid import KEY, coverage, level

EDGE = 1e-6


@dataclass
class Clusters:
    """``samples``: (sample_id, cluster, weights, log_likelihoods); ``centroids``: (site, a, b) with an entry a cluster; ``history``: the total after each round."""

    samples: DataFrame
    centroids: DataFrame
    history: list[float] = field(default_factory=list)


def beta_centroids(levels: DataFrame, weights: DataFrame, k: int, min_variance: float = 1e-3) -> DataFrame:
    """(site, a, b): moments of each cluster's weighted levels as Beta parameters; null where it has no weight at a site.

    ``levels`` holds (sample_id, site, x), ``weights`` (sample_id, weights) with an entry a cluster.
    One partial and one final aggregate of three sums a cluster.
    """
    j = levels.join(weights, "sample_id")
    w = lambda c: F.element_at("weights", c + 1)
    g = j.groupBy(*KEY).agg(*[x for c in range(k) for x in (F.sum(w(c)).alias(f"n{c}"), F.sum(w(c) * F.col("x")).alias(f"s{c}"), F.sum(w(c) * F.col("x") * F.col("x")).alias(f"q{c}"))])

    def parameters(c: int) -> tuple[Column, Column]:
        n = F.when(F.col(f"n{c}") > 1e-9, F.col(f"n{c}"))
        mean = F.least(F.greatest(F.col(f"s{c}") / n, F.lit(EDGE)), F.lit(1 - EDGE))
        variance = F.greatest(F.col(f"q{c}") / n - F.pow(F.col(f"s{c}") / n, F.lit(2)), F.lit(min_variance))
        size = F.greatest(mean * (1 - mean) / variance - 1, F.lit(1e-3))
        known = n.isNotNull()
        return F.when(known, F.greatest(mean * size, F.lit(1e-3))), F.when(known, F.greatest((1 - mean) * size, F.lit(1e-3)))

    both = [parameters(c) for c in range(k)]
    return g.select(*KEY, F.array(*[a for a, _ in both]).alias("a"), F.array(*[b for _, b in both]).alias("b"))


def log_likelihoods(levels: DataFrame, centroids: DataFrame, k: int) -> DataFrame:
    """(sample_id, n_sites, log_likelihoods): mean Beta log density over the covered sites that a cluster has, null where it has none.

    Normalisers are worked out once a site, not once a row.
    """
    ready = centroids.withColumn("l", F.transform(F.arrays_zip("a", "b"), lambda v: F.when(v["a"].isNotNull(), lbeta(v["a"], v["b"]))))
    x = F.least(F.greatest(F.col("x"), F.lit(EDGE)), F.lit(1 - EDGE))
    j = levels.select("sample_id", *KEY, F.log(x).alias("lx"), F.log(1 - x).alias("ly")).join(ready, KEY)
    at = lambda c, k: F.element_at(c, k + 1)
    density = lambda c: (at("a", c) - 1) * F.col("lx") + (at("b", c) - 1) * F.col("ly") - at("l", c)
    g = j.groupBy("sample_id").agg(F.count("*").alias("n_sites"), *[F.avg(density(c)).alias(f"l{c}") for c in range(k)])
    return g.select("sample_id", "n_sites", F.array(*[F.col(f"l{c}") for c in range(k)]).alias("log_likelihoods"))


def assign(likelihoods: DataFrame, soft: bool = False, temperature: float = 1.0) -> DataFrame:
    """Adds (cluster, weights): the cluster of largest likelihood, ties to the lower number, and its indicator or, if ``soft``, the softmax at the temperature.

    A sample with no likelihood at all has cluster null and weights 0.
    """
    value = F.transform("log_likelihoods", lambda x: F.coalesce(x, F.lit(-1e300)))
    top = F.array_max(value)
    known = F.exists("log_likelihoods", lambda x: x.isNotNull())
    out = likelihoods.withColumns({"__v": value, "__top": top}).withColumn("cluster", F.when(known, (F.array_position("__v", F.col("__top")) - 1).cast("int")))
    if soft:
        parts = F.transform("__v", lambda x: F.exp((x - F.col("__top")) / temperature))
        total = F.aggregate(parts, F.lit(0.0), lambda s, x: s + x)
        share = F.transform(parts, lambda p: p / total)
    else:
        share = F.transform("__v", lambda x, i: F.when(i == F.col("cluster"), F.lit(1.0)).otherwise(F.lit(0.0)))
    return out.withColumn("weights", F.when(known, share).otherwise(F.transform("__v", lambda x: F.lit(0.0)))).drop("__v", "__top")


def balance(assigned: DataFrame, k: int, min_size: int = 1) -> DataFrame:
    """Moves samples until each cluster has ``min_size`` of them: rescue of empty clusters and a least size.

    A cluster that lacks samples takes those that lose least by the move, from clusters that can
    spare them. One without a centroid takes those that fit worst where they are. Ties go by
    sample. Raises where there are fewer than k * min_size samples with a cluster.
    """
    own = F.expr("log_likelihoods[cluster]")
    for target in range(k):
        sizes = {r.cluster: r.n for r in assigned.where("cluster is not null").groupBy("cluster").agg(F.count("*").alias("n")).collect()}
        need = min_size - sizes.get(target, 0)
        if need <= 0:
            continue
        spare = {c: n - min_size for c, n in sizes.items() if c != target and n > min_size}
        if sum(spare.values()) < need:
            raise ValueError(f"{sum(sizes.values())} samples do not fill {k} clusters of {min_size}")
        gain = F.coalesce(F.col("log_likelihoods")[target] - own, -own)
        order = [F.desc("__gain"), "sample_id"]
        donors = assigned.where(F.col("cluster").isin(list(spare))).select("sample_id", "cluster", gain.alias("__gain"))
        limit = F.element_at(F.create_map(*[F.lit(v) for kv in spare.items() for v in kv]), F.col("cluster"))
        ranked = donors.withColumn("__r", F.row_number().over(Window.partitionBy("cluster").orderBy(*order))).where((F.col("__r") <= limit) & (F.col("__r") <= need))
        moved = ranked.orderBy(*order).limit(need).select("sample_id", F.lit(True).alias("__moves"))
        one = F.transform("weights", lambda x, i: F.when(i == target, F.lit(1.0)).otherwise(F.lit(0.0)))
        j = assigned.join(moved, "sample_id", "left")
        assigned = materialize(j.withColumns({"weights": F.when(F.col("__moves"), one).otherwise(F.col("weights")), "cluster": F.when(F.col("__moves"), F.lit(target)).otherwise(F.col("cluster"))}).drop("__moves"), "balanced")
    return assigned


def cluster_samples(counts: DataFrame, start: DataFrame, k: int, soft: bool = False, temperature: float = 1.0, min_size: int = 1, min_variance: float = 1e-3, rounds: int = 50) -> Clusters:
    """Clusters of the samples of (sample_id, site, mC, uC), from the first clusters in ``start`` (sample_id, cluster).

    A round fits the centroids to the clusters and assigns every sample anew. The total of the
    samples' likelihoods under their clusters is kept; a round that would lower it is not taken,
    and ends the job, as does one that changes no cluster (hard) or raises the total by less
    than 1e-9 (soft). So the history never falls. Still changing after ``rounds`` rounds raises.
    Sites without coverage do not count; samples without any have no cluster. Each round is
    written to the shared folder.
    """
    levels = materialize(counts.where(coverage() > 0).select("sample_id", *KEY, level().alias("x")), "levels")
    first = F.array(*[F.when(F.col("cluster") == c, F.lit(1.0)).otherwise(F.lit(0.0)) for c in range(k)])
    weights = start.select("sample_id", first.alias("weights"))
    best: Clusters | None = None
    history: list[float] = []
    for _ in range(rounds):
        centroids = materialize(beta_centroids(levels, weights, k, min_variance), "cluster-centroids")
        found = materialize(assign(log_likelihoods(levels, centroids, k), soft, temperature), "clusters")
        found = balance(found, k, min_size)
        terms = F.aggregate(F.zip_with("weights", "log_likelihoods", lambda w, x: F.when(w > 0, w * F.coalesce(x, F.lit(0.0))).otherwise(F.lit(0.0))), F.lit(0.0), lambda s, x: s + x)
        total = found.agg(F.coalesce(F.sum(terms), F.lit(0.0))).first()[0]
        if best is not None and total < history[-1] - 1e-12:
            return best
        same = best is not None and (total - history[-1] < 1e-9 if soft else not found.join(best.samples.select("sample_id", F.col("cluster").alias("__c")), "sample_id").where(~F.col("cluster").eqNullSafe(F.col("__c"))).take(1))
        history.append(total)
        best = Clusters(found, centroids, history)
        if same:
            return best
        weights = found.select("sample_id", "weights")
    raise RuntimeError(f"clusters still change after {rounds} rounds")
