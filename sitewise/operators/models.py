"""Fusion of scores, pair distances, concordance, and models of Spark ML."""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.incomplete import chi2_sf
from ..shared import materialize
from .running import add_up, deal, quantiles


def softmax(values: Column) -> Column:
    top = F.array_max(values)
    e = F.transform(F.arrays_zip(values.alias("v")), lambda x: F.exp(x["v"] - top))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda s, y: s + y))


def geometric_mean(long: DataFrame, by: list[str], p: str = "p") -> DataFrame:
    """Geometric mean of several experts' probabilities."""
    return long.groupBy(*by).agg(F.exp(F.avg(F.log(F.greatest(F.col(p), F.lit(1e-12))))).alias("p"), F.count("*").alias("n_experts"))


def weighted_mean(long: DataFrame, by: list[str], p: str, w: str) -> DataFrame:
    """Weighted mean of probabilities; even weights where they add up to 0."""
    total = F.sum(w)
    return long.groupBy(*by).agg(F.when(total > 0, F.sum(F.col(p) * F.col(w)) / total).otherwise(F.avg(p)).alias("p"))


def block_mean(scores: DataFrame, size: int, shrink: float = 1.0) -> DataFrame:
    """Mean over blocks of neighbouring ranks, each block's mean by root weights and shrunk by its size."""
    b = scores.groupBy("sample_id", F.floor(F.col("rank") / size).alias("block")).agg(F.count("*").alias("n"), (F.sum(F.sqrt("w") * F.col("score")) / F.sum(F.sqrt("w"))).alias("m"))
    return b.groupBy("sample_id").agg(F.count("*").alias("n_blocks"), F.avg(F.col("m") * F.col("n") / (F.col("n") + shrink)).alias("score"))


def pair_distances(counts: DataFrame, key: list[str]) -> DataFrame:
    """Mean absolute difference of levels over common sites, for every pair of samples once.

    Sites meet by an equi-join on the site, so the pairs of a site are those of the samples
    that cover it.
    """
    a = counts.select(*key, F.col("sample_id").alias("a"), F.col("x").alias("xa"))
    b = counts.select(*key, F.col("sample_id").alias("b"), F.col("x").alias("xb"))
    return a.join(b, key).where("a < b").groupBy("a", "b").agg(F.count("*").alias("n_common"), F.avg(F.abs(F.col("xa") - F.col("xb"))).alias("distance"))


def assign_medoids(distances: DataFrame, medoids: list[str]) -> DataFrame:
    """Nearest medoid of every sample, the smaller name on ties; a medoid is its own."""
    both = distances.select(F.col("a").alias("s"), F.col("b").alias("m"), "distance").unionByName(distances.select(F.col("b").alias("s"), F.col("a").alias("m"), "distance"))
    own = both.select(F.col("s")).where(F.col("s").isin(medoids)).distinct().select("s", F.col("s").alias("m"), F.lit(0.0).alias("distance"))
    return both.where(F.col("m").isin(medoids)).unionByName(own).groupBy("s").agg(F.min(F.struct("distance", "m")).alias("x")).select(F.col("s").alias("sample_id"), F.col("x.m").alias("medoid"), F.col("x.distance").alias("distance"))


def farthest_seeds(distances: DataFrame, k: int) -> list[str]:
    """k samples: the smallest name, then each time the one farthest from the chosen, the smaller name on ties. One row a step reaches the driver."""
    both = materialize(distances.select(F.col("a").alias("s"), F.col("b").alias("m"), "distance").unionByName(distances.select(F.col("b").alias("s"), F.col("a").alias("m"), "distance")), "pairs")
    first = both.agg(F.min("s").alias("s")).first()
    seeds = [first.s] if first.s is not None else []
    while seeds and len(seeds) < k:
        near = both.where(F.col("m").isin(seeds) & ~F.col("s").isin(seeds)).groupBy("s").agg(F.min("distance").alias("d"))
        row = near.orderBy(F.desc(F.round("d", 12)), "s").first()
        if row is None:
            break
        seeds.append(row.s)
    return seeds


def k_medoids(distances: DataFrame, k: int, rounds: int = 50) -> DataFrame:
    """(sample_id, medoid, distance): farthest seeds, then assignment and the member of least total distance in turn until medoids stay.

    Each round is a join and two grouped sums; the k medoids reach the driver. Medoids that still
    move after ``rounds`` rounds raise.
    """
    distances = materialize(distances, "distances")
    both = distances.select(F.col("a").alias("s"), F.col("b").alias("o"), "distance").unionByName(distances.select(F.col("b").alias("s"), F.col("a").alias("o"), "distance"))
    medoids = farthest_seeds(distances, k)
    for _ in range(rounds):
        of = materialize(assign_medoids(distances, medoids), "medoids")
        inside = both.join(of.select(F.col("sample_id").alias("s"), F.col("medoid").alias("c")), "s").join(of.select(F.col("sample_id").alias("o"), F.col("medoid").alias("co")), "o").where("c = co")
        cost = inside.groupBy("c", "s").agg(F.round(F.sum("distance"), 12).alias("t"))
        moved = {r.c: r.s for r in cost.groupBy("c").agg(F.min_by("s", F.struct("t", "s")).alias("s")).collect()}
        new = sorted(moved.get(m, m) for m in medoids)
        if new == sorted(medoids):
            break
        medoids = new
    else:
        raise RuntimeError(f"medoids still move after {rounds} rounds")
    return assign_medoids(distances, medoids)


def distance_statistics(distances: DataFrame) -> DataFrame:
    """Number, mean, deviation, ends and quartiles of all pair distances."""
    q = quantiles(distances, "distance", {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    g = distances.agg(F.count("*").alias("n"), F.avg("distance").alias("mean"), F.stddev_samp("distance").alias("sd"), F.min("distance").alias("min"), F.max("distance").alias("max"))
    return g.crossJoin(F.broadcast(q))  # one row


def silhouette(distances: DataFrame, labels: DataFrame) -> DataFrame:
    """Silhouette of each sample from pair distances."""
    both = distances.select(F.col("a").alias("s"), F.col("b").alias("o"), "distance").unionByName(distances.select(F.col("b").alias("s"), F.col("a").alias("o"), "distance"))
    j = both.join(labels.select(F.col("sample_id").alias("s"), F.col("label").alias("ls")), "s").join(labels.select(F.col("sample_id").alias("o"), F.col("label").alias("lo")), "o")
    m = j.groupBy("s", "ls", "lo").agg(F.avg("distance").alias("d"))
    g = m.groupBy("s").agg(F.min(F.when(F.col("ls") == F.col("lo"), F.col("d"))).alias("in"), F.min(F.when(F.col("ls") != F.col("lo"), F.col("d"))).alias("out"))
    return g.select(F.col("s").alias("sample_id"), F.when(F.col("in").isNull() | F.col("out").isNull(), 0.0).otherwise((F.col("out") - F.col("in")) / F.greatest("in", "out")).alias("silhouette"))


def concordance(rows: DataFrame, buckets: int = 512) -> DataFrame:
    """Harrell's C from counts instead of pairs.

    Risks are cut into buckets by quantile. Pairs in different buckets come from running
    sums over a grid of distinct times by buckets, so times should be whole units such as days.
    Inside a bucket risks are numbered, and pairs are counted where their numbers' highest
    differing bit lies: a row costs one entry a bit, and no pair is built.
    """
    cuts = rows.select(F.percentile_approx("risk", [k / buckets for k in range(1, buckets)], 100_000).alias("c"))
    b = materialize(rows.crossJoin(F.broadcast(cuts)).select("time", "event", "risk", F.size(F.filter("c", lambda v: v < F.col("risk"))).alias("b")), "concordance")
    cells = b.groupBy("time", "b").agg(F.count("*").alias("n"), F.sum("event").alias("d"))
    every = b.select("time").distinct().withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    grid = every.join(cells, ["time", "b"], "left").na.fill(0, ["n", "d"])
    later = F.sum("n").over(Window.partitionBy("b").orderBy(F.desc("time")).rowsBetween(Window.unboundedPreceding, -1))
    grid = grid.withColumn("later", F.coalesce(later, F.lit(0)))
    lower = F.sum("later").over(Window.partitionBy("time").orderBy("b").rowsBetween(Window.unboundedPreceding, -1))
    grid = grid.withColumn("lower", F.coalesce(lower, F.lit(0))).withColumn("others", F.sum("later").over(Window.partitionBy("time")) - F.col("later"))
    far = grid.agg(F.sum(F.col("d") * F.col("lower")).cast("double").alias("good"), F.sum(F.col("d") * F.col("others")).alias("every"))
    numbered = materialize(b.withColumn("r", F.dense_rank().over(Window.partitionBy("b").orderBy("risk"))), "concordance-ranks")
    bits = (numbered.agg(F.max("r")).first()[0] or 1).bit_length()

    def later_of(rows: DataFrame, by: list[str], low: Column, high: Column) -> DataFrame:
        """(times, pairs): for each event of ``high`` the ``low`` rows of its group with a later time."""
        g = rows.groupBy(*by, "time").agg(F.sum(low.cast("long")).alias("l"), F.sum(F.when(high, F.col("event")).otherwise(0)).alias("d"))
        w = Window.partitionBy(*by).orderBy(F.desc("time")).rowsBetween(Window.unboundedPreceding, -1)
        return g.select((F.col("d") * F.coalesce(F.sum("l").over(w), F.lit(0))).cast("double").alias("pairs")).agg(F.coalesce(F.sum("pairs"), F.lit(0.0)).alias("pairs"))

    level = numbered.select("*", F.explode(F.array(*[F.lit(k) for k in range(bits)])).alias("bit")).withColumn("prefix", F.expr("shiftright(r, bit + 1)")).withColumn("one", F.expr("shiftright(r, bit) & 1") == 1)
    always = F.lit(True)
    higher = later_of(level, ["b", "bit", "prefix"], ~F.col("one"), F.col("one"))
    equal = later_of(numbered, ["b", "r"], always, always)
    inside = later_of(numbered, ["b"], always, always)
    near = higher.withColumnRenamed("pairs", "h").crossJoin(F.broadcast(equal.withColumnRenamed("pairs", "q"))).crossJoin(F.broadcast(inside)).select((F.col("h") + 0.5 * F.col("q")).alias("good"), F.col("pairs").cast("long").alias("every"))  # one row each
    return far.unionByName(near).agg((F.sum("good") / F.sum("every")).alias("c_index"), F.sum("every").cast("long").alias("n_pairs"))


def cox_fit(rows: DataFrame, columns: list[str], steps: int = 12, ridge: float = 1e-6) -> tuple[np.ndarray, float]:
    """Coefficients and log likelihood of the Breslow partial likelihood by Newton steps.

    Each step is one Spark job: sums per time, running sums from the last time back, and a
    gradient and matrix of the size of the coefficients for the driver.
    """
    p = len(columns)
    beta, value = np.zeros(p), 0.0
    dealt = deal(rows.select("time", "event", *columns), [], [F.desc("time")])
    for _ in range(steps):
        eta = sum((F.col(c) * float(b) for c, b in zip(columns, beta)), F.lit(0.0))
        r = dealt.select("__part", "time", "event", *columns, F.exp(eta).alias("e"))
        first = [F.sum(F.col("e") * F.col(c)).alias(f"s{i}") for i, c in enumerate(columns)]
        second = [F.sum(F.col("e") * F.col(columns[i]) * F.col(columns[j])).alias(f"s{i}_{j}") for i in range(p) for j in range(i + 1)]
        deaths = [F.sum(F.col("event") * F.col(c)).alias(f"d{i}") for i, c in enumerate(columns)]
        g = r.groupBy("__part", "time").agg(F.sum("e").alias("s"), F.sum("event").alias("d"), F.sum(F.col("event") * F.log("e")).alias("de"), *first, *second, *deaths)
        names = ["s", *[f"s{i}" for i in range(p)], *[f"s{i}_{j}" for i in range(p) for j in range(i + 1)]]
        totals = add_up(g, [], [F.desc("time")], {f"r_{n}": n for n in names})
        q = totals.select("d", "de", *[f"d{i}" for i in range(p)], *[F.col(f"r_{n}").alias(n) for n in names]).where("d > 0")
        grad = [F.sum(F.col(f"d{i}") - F.col("d") * F.col(f"s{i}") / F.col("s")) for i in range(p)]
        info = [F.sum(F.col("d") * (F.col(f"s{i}_{j}") / F.col("s") - F.col(f"s{i}") * F.col(f"s{j}") / (F.col("s") * F.col("s")))) for i in range(p) for j in range(i + 1)]
        out = [float(x) for x in q.agg(F.sum(F.col("de") - F.col("d") * F.log("s")), *grad, *info).first()]
        value, gradient, matrix = out[0], np.array(out[1:1 + p]), np.zeros((p, p))
        for k, (i, j) in enumerate((i, j) for i in range(p) for j in range(i + 1)):
            matrix[i, j] = matrix[j, i] = out[1 + p + k]
        move = np.linalg.solve(matrix + ridge * np.eye(p), gradient)
        beta = beta + move
        if np.abs(move).max() < 1e-9:
            break
    return beta, value


def nested_test(rows: DataFrame, full: list[str], reduced: list[str]) -> DataFrame:
    """(statistic, degrees, p_value): likelihood-ratio test of a Cox model against one with fewer of its columns.

    One row; the statistic is not below 0. Raises unless ``reduced`` is a proper part of ``full``.
    """
    if not set(reduced) < set(full):
        raise ValueError("the reduced model has some of the full model's columns, not all")
    log = {k: cox_fit(rows, c)[1] if c else cox_null(rows) for k, c in (("full", full), ("reduced", reduced))}
    one = rows.sparkSession.range(1).select(F.lit(max(2 * (log["full"] - log["reduced"]), 0.0)).alias("statistic"), F.lit(len(full) - len(reduced)).alias("degrees"))
    return one.withColumn("p_value", chi2_sf(F.col("statistic"), F.col("degrees")))


def cox_null(rows: DataFrame) -> float:
    """Log partial likelihood of a model without columns."""
    g = deal(rows.select("time", "event"), [], [F.desc("time")]).groupBy("__part", "time").agg(F.count("*").alias("s"), F.sum("event").alias("d"))
    return float(add_up(g, [], [F.desc("time")], {"r": "s"}).where("d > 0").agg(F.coalesce(-F.sum(F.col("d") * F.log("r")), F.lit(0.0))).first()[0])


def deconvolve(levels: DataFrame, basis: DataFrame, parts: list[str], rounds: int = 2000) -> DataFrame:
    """Shares of the parts of each sample's mixture: least squares on the simplex.

    The products MtM and Mty are sums in Spark; each sample's small problem is solved by
    projected gradient inside a task.
    """
    j = levels.join(basis, ["chrom", "context", "pos"])
    k = len(parts)
    sums = [F.sum(F.col(a) * F.col(b)) for a in parts for b in parts] + [F.sum(F.col(a) * F.col("x")) for a in parts]
    g = j.groupBy("sample_id").agg(F.array(*sums).alias("s"))

    def solve(batches):
        for b in batches:
            rows = []
            for sample, s in zip(b["sample_id"], b["s"]):
                s = np.array(s)
                m, y = s[:k * k].reshape(k, k), s[k * k:]
                w, rate = np.full(k, 1 / k), 1 / max(np.linalg.eigvalsh(m)[-1], 1e-12)
                for _ in range(rounds):
                    v = w - rate * (m @ w - y)
                    u = np.sort(v)[::-1]
                    c = (np.cumsum(u) - 1) / np.arange(1, k + 1)
                    w = np.maximum(v - c[np.flatnonzero(u > c)[-1]], 0)
                rows += [(sample, p, float(x)) for p, x in zip(parts, w)]
            yield b.__class__(rows, columns=["sample_id", "part", "share"])

    return g.mapInPandas(solve, "sample_id string, part string, share double")


def assemble(df: DataFrame, columns: list[str], label: str | None = None) -> DataFrame:
    keep = [c for c in ("id", "sample_id") if c in df.columns]
    out = VectorAssembler(inputCols=columns, outputCol="features").transform(df)
    return out.select(*keep, "features", *([F.col(label).cast("double").alias("label")] if label else []))


def logistic(train: DataFrame, test: DataFrame, ridge: float = 0.01) -> DataFrame:
    """Probability of class 1 by a regularised logistic fit on the assembled columns."""
    model = LogisticRegression(regParam=ridge, standardization=True).fit(train)
    return model.transform(test).withColumn("p1", vector_to_array("probability")[1]).drop("rawPrediction", "probability", "prediction")


def compare_classifiers(train: DataFrame, test: DataFrame, seed: int = 13) -> DataFrame:
    """Test accuracy of three tabular methods."""
    methods = {"logistic": LogisticRegression(regParam=0.01), "forest": RandomForestClassifier(numTrees=30, maxDepth=5, seed=seed), "boosted": GBTClassifier(maxIter=15, maxDepth=3, seed=seed)}
    parts = [m.fit(train).transform(test).agg(F.lit(n).alias("method"), F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"), F.count("*").alias("n")) for n, m in methods.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def calibrate(scores: DataFrame, fit_on: Column) -> DataFrame:
    """Isotonic and logistic calibration of p1, fitted on the marked rows."""
    rows = scores.withColumn("label", F.col("y_true").cast("double")).withColumn("features", array_to_vector(F.array("p1")))
    iso = IsotonicRegression().fit(rows.where(fit_on)).transform(rows).withColumnRenamed("prediction", "isotonic")
    platt = LogisticRegression().fit(rows.where(fit_on)).transform(iso)
    return platt.select("id", "y_true", "p1", "isotonic", vector_to_array("probability")[1].alias("platt"))


def latent_gaussian(train: DataFrame, test: DataFrame, dims: int) -> DataFrame:
    """Class posterior under diagonal Gaussians on principal components; variances at least 1e-6."""
    pca = PCA(k=dims, inputCol="features", outputCol="z").fit(train)
    z = pca.transform(train).select("label", vector_to_array("z").alias("z"))
    stats = z.select("label", F.posexplode("z").alias("i", "v")).groupBy("label", "i").agg(F.avg("v").alias("m"), F.greatest(F.var_pop("v"), F.lit(1e-6)).alias("s"), F.count("*").alias("n"))
    t = pca.transform(test).select("id", F.col("label").alias("y_true"), F.posexplode(vector_to_array("z")).alias("i", "v"))
    ll = t.join(stats, "i").groupBy("id", "y_true", "label").agg((F.sum(-0.5 * (F.log("s") + F.pow(F.col("v") - F.col("m"), F.lit(2)) / F.col("s"))) + F.log(F.max("n"))).alias("l"))  # stats: classes by dims
    w = ll.groupBy("id", "y_true").agg(F.max(F.when(F.col("label") == 1, F.col("l"))).alias("l1"), F.max(F.when(F.col("label") == 0, F.col("l"))).alias("l0"))
    return w.select("id", "y_true", (1 / (1 + F.exp(F.col("l0") - F.col("l1")))).alias("p1"))


def strata(df: DataFrame, ks: list[int], seed: int = 13) -> DataFrame:
    """k-means strata with the number of clusters of the best silhouette."""
    best = None
    for k in ks:
        out = KMeans(k=k, seed=seed).fit(df).transform(df)
        score = ClusteringEvaluator().evaluate(out)
        if best is None or score > best[0]:
            best = (score, k, out)
    return best[2].select("sample_id", F.col("prediction").alias("stratum"), F.lit(best[1]).alias("k"))
