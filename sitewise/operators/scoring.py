"""Evaluation of predictions, likelihood scoring, survival."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import fdr
from .running import running
from .stability import mixed31

CELLS = ("tp", "fp", "tn", "fn")


def confusion(pred: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Cells of a two-class confusion matrix per group."""
    y, p = F.col("y_true") == 1, F.col("y_pred") == 1
    return pred.groupBy(*(by or [])).agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(~y & ~p).alias("tn"), F.count_if(y & ~p).alias("fn"))


def wilson(successes: Column, total: Column, z: float = 1.96) -> tuple[Column, Column]:
    """Bounds of the Wilson interval; always at z = 1.96 by default."""
    p = F.when(total > 0, successes / total)
    centre, denom = p + z * z / (2 * total), 1 + z * z / total
    half = z * F.sqrt(p * (1 - p) / total + z * z / (4 * total * total))
    return F.greatest((centre - half) / denom, F.lit(0.0)), F.least((centre + half) / denom, F.lit(1.0))


def rates(cells: DataFrame) -> DataFrame:
    """Sensitivity, specificity, predictive values, accuracy, balanced accuracy and F1 from the cells."""
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    tp, fp, tn, fn = (F.col(c) for c in CELLS)
    sens, spec = ratio(tp, tp + fn), ratio(tn, tn + fp)
    lo, hi = wilson(tp, tp + fn)
    return cells.select("*", sens.alias("sensitivity"), spec.alias("specificity"), ratio(tp, tp + fp).alias("ppv"), ratio(tn, tn + fn).alias("npv"),
                        ratio(tp + tn, tp + fp + tn + fn).alias("accuracy"), ((sens + spec) / 2).alias("balanced_accuracy"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
                        lo.alias("sensitivity_low"), hi.alias("sensitivity_high"))


def per_class(pred: DataFrame, classes: str = "y_true", guess: str = "y_pred") -> DataFrame:
    """Support, precision, recall and F1 of every class, from counts of (true, predicted)."""
    m = pred.groupBy(classes, guess).agg(F.count("*").alias("n"))
    true = m.groupBy(F.col(classes).alias("class")).agg(F.sum("n").alias("support"), F.sum(F.when(F.col(classes) == F.col(guess), F.col("n")).otherwise(0)).alias("hit"))
    said = m.groupBy(F.col(guess).alias("class")).agg(F.sum("n").alias("predicted"))
    j = true.join(said, "class", "left")
    precision, recall = F.when(F.col("predicted") > 0, F.col("hit") / F.col("predicted")).otherwise(F.lit(0.0)), F.col("hit") / F.col("support")
    f1 = F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).otherwise(F.lit(0.0))
    return j.select("class", "support", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"))


def calibration(pred: DataFrame, p: str = "p1", bins: int = 15) -> DataFrame:
    """Log loss, Brier score and expected calibration error with equal bins, the last one closed."""
    q = F.least(F.greatest(F.col(p), F.lit(1e-15)), F.lit(1 - 1e-15))
    r = pred.select("y_true", F.col(p).alias("p"), F.least(F.floor(F.col(p) * bins), F.lit(bins - 1)).alias("bin"),
                    (-F.when(F.col("y_true") == 1, F.log(q)).otherwise(F.log(1 - q))).alias("nll"), F.pow(F.col(p) - F.col("y_true"), F.lit(2)).alias("brier"))
    b = r.groupBy("bin").agg(F.count("*").alias("n"), F.sum("nll").alias("nll"), F.sum("brier").alias("brier"), F.abs(F.avg("p") - F.avg("y_true")).alias("gap"))
    return b.agg((F.sum("nll") / F.sum("n")).alias("nll"), (F.sum("brier") / F.sum("n")).alias("brier"), (F.sum(F.col("n") * F.col("gap")) / F.sum("n")).alias("ece"))


def rank_auc(pred: DataFrame, score: str = "p1", by: list[str] | None = None) -> DataFrame:
    """Area under the curve from average ranks of the scores."""
    by = by or []
    g = fdr.average_rank(pred, score, by, "rank").groupBy(*by).agg(
        F.count_if(F.col("y_true") == 1).alias("n1"), F.count_if(F.col("y_true") != 1).alias("n0"), F.sum(F.when(F.col("y_true") == 1, F.col("rank"))).alias("s"))
    auc = F.when((F.col("n1") > 0) & (F.col("n0") > 0), (F.col("s") - F.col("n1") * (F.col("n1") + 1) / 2) / (F.col("n1") * F.col("n0")))
    return g.select(*by, "n1", "n0", auc.alias("auc"))


def bootstrap(pred: DataFrame, draws: int, seed: int = 13) -> DataFrame:
    """Quantiles of balanced accuracy over stratified resamples of each class.

    Only whether a drawn row was predicted rightly counts, so a class is its size and its
    number of right rows, put first: pick i of a draw takes place hash(draw, i) modulo the
    size and is right below that number. Picks are a range that tasks share out; no row is
    sorted, numbered or joined, and the resamples do not depend on partitions or engine.
    """
    cells = confusion(pred).first()
    sizes = {1: (cells.tp + cells.fn, cells.tp), 0: (cells.tn + cells.fp, cells.tn)}
    parts = []
    for label, (n, right) in sizes.items():
        pick = pred.sparkSession.range(draws * n).select((F.col("id") / F.lit(max(n, 1))).cast("long").alias("draw"), (F.col("id") % max(n, 1) + 1).alias("i"))
        place = mixed31(F.col("i"), F.col("draw") + 1, seed) % max(n, 1)
        parts.append(pick.groupBy("draw").agg(F.avg((place < right).cast("double")).alias(f"rate{label}")))
    b = parts[0].join(parts[1], "draw").select(((F.col("rate1") + F.col("rate0")) / 2).alias("b"))
    return b.agg(F.count("*").alias("draws"), F.avg("b").alias("mean"), F.percentile("b", 0.025).alias("low"), F.percentile("b", 0.975).alias("high"))


def bootstrap_metrics(pred: DataFrame, draws: int, seed: int = 13) -> DataFrame:
    """(metric, point, n_valid, mean, sd, low, high): the hold-out metrics of all rows and their spread over stratified resamples.

    Metrics are accuracy, balanced accuracy, sensitivity, specificity, F1 of class 1 and the
    mean F1 of both; all follow from a draw's four cells. Draws are those of ``bootstrap``; a
    class without rows has no draws of its own, and a metric that a draw lacks does not count.
    """
    cells = confusion(pred).first()
    sizes = {1: (cells.tp + cells.fn, cells.tp), 0: (cells.tn + cells.fp, cells.tn)}
    spark = pred.sparkSession
    right = spark.range(draws).select(F.col("id").alias("draw"))
    for label, (n, good) in sizes.items():
        pick = spark.range(draws * n).select((F.col("id") / F.lit(max(n, 1))).cast("long").alias("draw"), (F.col("id") % max(n, 1) + 1).alias("i"))
        hits = pick.groupBy("draw").agg(F.count_if(mixed31(F.col("i"), F.col("draw") + 1, seed) % max(n, 1) < good).alias(f"r{label}"))
        right = right.join(hits, "draw", "left").withColumn(f"r{label}", F.coalesce(f"r{label}", F.lit(0)))
    whole = spark.range(1).select(F.lit(-1).cast("long").alias("draw"), F.lit(cells.tp).cast("long").alias("r1"), F.lit(cells.tn).cast("long").alias("r0"))
    n1, n0 = sizes[1][0], sizes[0][0]
    share = lambda a, b: F.when(b > 0, a / b)
    tp, tn = F.col("r1"), F.col("r0")
    fp, fn = n0 - tn, n1 - tp
    sens, spec = share(tp, F.lit(n1)), share(tn, F.lit(n0))
    f1 = lambda hit, wrong: F.coalesce(share(2.0 * hit, 2 * hit + wrong), F.lit(0.0))
    metrics = {"accuracy": share(tp + tn, F.lit(n1 + n0)), "balanced_accuracy": (sens + spec) / 2, "sensitivity": sens, "specificity": spec, "f1": f1(tp, fp + fn), "macro_f1": (f1(tp, fp + fn) + f1(tn, fp + fn)) / 2}
    long = right.unionByName(whole).select("draw", F.explode(F.array(*[F.struct(F.lit(k).alias("metric"), v.alias("v")) for k, v in metrics.items()])).alias("m")).select("draw", "m.*")
    drawn = F.when(F.col("draw") >= 0, F.col("v"))
    return long.groupBy("metric").agg(
        F.max(F.when(F.col("draw") < 0, F.col("v"))).alias("point"), F.count(drawn).alias("n_valid"), F.avg(drawn).alias("mean"), F.stddev_pop(drawn).alias("sd"),
        F.percentile(drawn, 0.025).alias("low"), F.percentile(drawn, 0.975).alias("high"))


def time_dependent_auc(rows: DataFrame, horizons: list[float]) -> DataFrame:
    """(horizon, n1, n0, auc): how well ``risk`` tells those with an event by each horizon from those still there after it.

    Who left before without an event counts for neither; a horizon without one side has a null area.
    """
    times = F.array(*[F.lit(float(h)) for h in horizons])
    long = rows.select("time", "event", "risk", F.explode(times).alias("horizon"))
    case, control = (F.col("time") <= F.col("horizon")) & (F.col("event") > 0), F.col("time") > F.col("horizon")
    sided = long.where(case | control).select("horizon", "risk", F.when(case, 1).otherwise(0).alias("y_true"))
    found = rank_auc(sided, "risk", ["horizon"])
    every = rows.sparkSession.createDataFrame([(float(h),) for h in horizons], "horizon double")
    return every.join(found, "horizon", "left").select("horizon", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n1", "n0")], "auc")


def decide(pred: DataFrame, p: str, margin: float, confidence: float) -> DataFrame:
    """control, disease or indeterminate, with the reason."""
    best, gap = F.greatest(F.col(p), 1 - F.col(p)), F.abs(2 * F.col(p) - 1)
    reason = F.when(gap < margin, "low_margin").when(best < confidence, "low_confidence").otherwise("ok")
    return pred.withColumn("reason", reason).withColumn("decision", F.when(F.col("reason") != "ok", "indeterminate").when(F.col(p) >= 0.5, "disease").otherwise("control"))


def abstain(scores: DataFrame, observed: str, expected: str, min_fraction: float, p: str = "p1") -> DataFrame:
    """Class -1 and an even probability where too few loci were observed."""
    enough = F.col(observed) >= min_fraction * F.col(expected)
    return scores.withColumn("y_pred", F.when(enough, (F.col(p) >= 0.5).cast("int")).otherwise(-1)).withColumn(p, F.when(enough, F.col(p)).otherwise(F.lit(0.5)))


def histogram_scores(counts: DataFrame, panel: DataFrame, temperature: float = 1.0, floor: float = -20.0, bins: int = 20) -> DataFrame:
    """Posterior of the second class for each sample from the panel's two histograms per site.

    ``panel`` has the site, a weight and bin arrays h1, h2. The densities are bin shares
    times the number of bins; log densities are floored; the weighted mean difference is
    scaled by temperature * sqrt(effective number of sites), capped at 10.
    """
    from .centroid import KEY, level_bin

    j = counts.select("sample_id", *KEY, (level_bin(bins) + 1).alias("b")).join(panel, KEY)

    def log_density(h: str) -> Column:
        total = F.aggregate(F.col(h), F.lit(0.0), lambda s, x: s + x)
        return F.greatest(F.log(F.greatest(F.element_at(h, F.col("b")) / F.greatest(total, F.lit(1e-20)) * bins, F.lit(1e-300))), F.lit(floor))

    r = j.withColumn("d", log_density("h2") - log_density("h1"))
    g = r.groupBy("sample_id").agg(F.count("*").alias("n_loci"), (F.sum(F.col("w") * F.col("d")) / F.sum("w")).alias("mean_llr"), (F.pow(F.sum("w"), F.lit(2)) / F.sum(F.col("w") * F.col("w"))).alias("n_eff"))
    scaled = F.col("mean_llr") * F.least(temperature * F.sqrt("n_eff"), F.lit(10.0))
    return g.select("sample_id", "n_loci", "mean_llr", (1 / (1 + F.exp(-scaled))).alias("p1"))


def prefix_search(scores: DataFrame, target: float) -> DataFrame:
    """Balanced accuracy of every panel size k from per-locus scores (sample_id, y_true, rank, score).

    A sample is called positive at k where the sum of its scores of the first k loci is above
    0. Each sample gives a +1 or -1 at the ranks where its call changes, and running totals
    of these by rank give the cells of every k, so only rows that exist are read. ``chosen``
    marks the smallest k that reaches the target.
    """
    run = Window.partitionBy("sample_id").orderBy("rank")
    called = scores.withColumn("call", (F.sum("score").over(run.rowsBetween(Window.unboundedPreceding, 0)) > 0).cast("int"))
    moved = called.withColumn("move", F.col("call") - F.coalesce(F.lag("call").over(run), F.lit(0)))
    steps = moved.groupBy("rank").agg(F.sum(F.when(F.col("y_true") == 1, F.col("move")).otherwise(0)).alias("m1"), F.sum(F.when(F.col("y_true") == 1, 0).otherwise(F.col("move"))).alias("m0"))
    sizes = scores.groupBy("sample_id").agg(F.max("y_true").alias("y")).agg(F.count_if(F.col("y") == 1).alias("n1"), F.count_if(F.col("y") != 1).alias("n0"))
    cells = running(steps, [], ["rank"], {"tp": "m1", "fp": "m0"}).crossJoin(F.broadcast(sizes))  # one row
    b = rates(cells.select("rank", "tp", "fp", (F.col("n0") - F.col("fp")).alias("tn"), (F.col("n1") - F.col("tp")).alias("fn")))
    b = b.select(F.col("rank").alias("k"), "balanced_accuracy", (F.col("balanced_accuracy") >= target).alias("reached"))
    least = b.where("reached").agg(F.min("k").alias("__least"))
    return b.crossJoin(F.broadcast(least)).select("k", "balanced_accuracy", "reached", F.coalesce(F.col("k") == F.col("__least"), F.lit(False)).alias("chosen"))


def kaplan_meier(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Survival at each event time, from counts per time."""
    by = by or []
    g = rows.groupBy(*by, "time").agg(F.count("*").alias("n"), F.sum("event").alias("d"))
    r = running(g, by, [F.desc("time")], {"at_risk": "n"}).where("d > 0")
    step = F.when(F.col("d") < F.col("at_risk"), F.log(1 - F.col("d") / F.col("at_risk"))).otherwise(F.lit(-1e9))
    return running(r, by, ["time"], {"log_s": step}).select(*by, "time", "at_risk", "d", F.exp("log_s").alias("survival"))


def log_rank(rows: DataFrame, group: Column) -> DataFrame:
    """Observed and expected events of group 1 and the chi-square statistic, from counts per time."""
    g = rows.withColumn("g", group.cast("int")).groupBy("time").agg(F.count("*").alias("n"), F.sum("g").alias("n1"), F.sum("event").alias("d"), F.sum(F.col("event") * F.col("g")).alias("d1"))
    r = running(g, [], [F.desc("time")], {"r": "n", "r1": "n1"}).where("d > 0")
    e = F.col("d") * F.col("r1") / F.col("r")
    v = F.when(F.col("r") > 1, e * (1 - F.col("r1") / F.col("r")) * (F.col("r") - F.col("d")) / (F.col("r") - 1)).otherwise(F.lit(0.0))
    s = r.agg(F.sum("d1").alias("observed"), F.sum(e).alias("expected"), F.sum(v).alias("variance"))
    return s.select("observed", "expected", F.when(F.col("variance") > 0, F.pow(F.col("observed") - F.col("expected"), F.lit(2)) / F.col("variance")).otherwise(F.lit(0.0)).alias("chi2"))


def pool_cells(cells: DataFrame, by: str) -> DataFrame:
    """Sum of the cells over splits and mean of the splits' balanced accuracies."""
    r = rates(cells)
    return r.agg(F.countDistinct(by).alias("n_splits"), *[F.sum(c).alias(c) for c in CELLS], F.avg("balanced_accuracy").alias("mean_balanced_accuracy"))
