"""Per-sample measures: genome-wide levels, read patterns, haplotypes, fragments, quality control."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .centroid import coverage, level


def binary_entropy(p: Column) -> Column:
    q = F.least(F.greatest(p, F.lit(1e-12)), F.lit(1 - 1e-12))
    return -(q * F.log2(q) + (1 - q) * F.log2(1 - q))


def genome_measures(counts: DataFrame, low: float = 0.2, high: float = 0.8) -> DataFrame:
    """Coverage-weighted mean level, mean entropy, shares of low and middle sites, coverage of each sample."""
    r = counts.select("sample_id", coverage().alias("c"), level().alias("x")).where("c > 0")
    return r.groupBy("sample_id").agg(
        (F.sum(F.col("c") * F.col("x")) / F.sum("c")).alias("mean_beta"), (F.sum(F.col("c") * binary_entropy(F.col("x"))) / F.sum("c")).alias("entropy"),
        F.avg((F.col("x") < low).cast("double")).alias("hypo_fraction"), F.avg(F.col("x").between(low, high).cast("double")).alias("middle_fraction"),
        F.avg("c").alias("mean_coverage"), F.percentile(F.col("c").cast("double"), 0.5).alias("median_coverage"))


def relative_coverage(counts: DataFrame) -> DataFrame:
    """(median - cohort median) / cohort median of coverage, by sample and chromosome."""
    per = counts.groupBy("sample_id", "chrom").agg(F.percentile(coverage().cast("double"), 0.5).alias("median"))
    cohort = per.groupBy("chrom").agg(F.percentile("median", 0.5).alias("cohort"))
    return per.join(cohort, "chrom").select("sample_id", "chrom", "median", F.when(F.col("cohort") > 0, (F.col("median") - F.col("cohort")) / F.col("cohort")).alias("deviation"))


def adjacent_disagreement(counts: DataFrame, by: list[str], max_gap: int = 2, threshold: float = 0.5, min_coverage: int = 1) -> DataFrame:
    """Share of neighbouring covered sites within ``max_gap`` whose levels differ by more than the threshold."""
    w = Window.partitionBy(*by, "chrom").orderBy("pos")
    r = counts.where(coverage() >= min_coverage).select(*by, "chrom", "pos", level().alias("x"))
    r = r.withColumn("gap", F.col("pos") - F.lag("pos").over(w)).withColumn("d", F.abs(F.col("x") - F.lag("x").over(w)))
    near = r.where(F.col("gap") <= max_gap)
    return near.groupBy(*by).agg(F.count("*").alias("n_pairs"), F.avg((F.col("d") > threshold).cast("double")).alias("disagreement"))


def tile_patterns(reads: DataFrame, k: int = 4) -> DataFrame:
    """Counts of k-site patterns per sample and tile; the first site is the highest bit."""
    r = reads.withColumn("tile", F.floor(F.col("i") / k)).groupBy("sample_id", "read_id", "tile").agg(
        F.sum(F.col("meth") * F.pow(F.lit(2), k - 1 - F.col("i") % k).cast("long")).alias("pattern"), F.count("*").alias("n")).where(F.col("n") == k)
    return r.groupBy("sample_id", "tile", "pattern").agg(F.count("*").alias("cnt"))


def pattern_measures(patterns: DataFrame, k: int = 4) -> DataFrame:
    """Entropy / k, epipolymorphism and share of mixed patterns of each tile."""
    n = F.sum("cnt").over(Window.partitionBy("sample_id", "tile"))
    p = patterns.withColumn("n", n).withColumn("p", F.col("cnt") / F.col("n"))
    mixed = ~F.col("pattern").isin(0, 2**k - 1)
    return p.groupBy("sample_id", "tile").agg(
        F.max("n").alias("n_reads"), (-F.sum(F.col("p") * F.log2("p")) / k).alias("entropy"), (1 - F.sum(F.col("p") * F.col("p"))).alias("epipolymorphism"),
        F.sum(F.when(mixed, F.col("p")).otherwise(0.0)).alias("discordant"))


def tile_divergence(patterns: DataFrame, group: Column) -> DataFrame:
    """Jensen-Shannon divergence, in bits, of two groups' pattern distributions in common tiles."""
    g = patterns.withColumn("g", group).groupBy("g", "tile", "pattern").agg(F.sum("cnt").alias("cnt"))
    g = g.withColumn("p", F.col("cnt") / F.sum("cnt").over(Window.partitionBy("g", "tile")))
    wide = g.groupBy("tile", "pattern").agg(F.sum(F.when(F.col("g") == 0, F.col("p"))).alias("p"), F.sum(F.when(F.col("g") == 1, F.col("p"))).alias("q"))
    both = wide.withColumns({"p": F.coalesce("p", F.lit(0.0)), "q": F.coalesce("q", F.lit(0.0))}).withColumn("m", (F.col("p") + F.col("q")) / 2)
    part = lambda c: F.when(F.col(c) > 0, F.col(c) * F.log2(F.col(c) / F.col("m"))).otherwise(F.lit(0.0))
    return both.groupBy("tile").agg(F.sum((part("p") + part("q")) / 2).alias("jsd"))


def haplotype_load(reads: DataFrame, block: int) -> DataFrame:
    """Methylated haplotype load per sample and block of ``block`` sites.

    A run of r methylated sites holds r - k + 1 fully methylated stretches of length k, and
    a read of n sites holds n - k + 1 of any kind; weights of length k are k / sum of k.
    """
    r = reads.withColumn("block", F.floor(F.col("i") / block))
    w = Window.partitionBy("sample_id", "read_id", "block").orderBy("i")
    run = r.withColumn("island", F.row_number().over(w) - F.sum("meth").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    runs = run.where("meth = 1").groupBy("sample_id", "read_id", "block", "island").agg(F.count("*").alias("len"))
    full = runs.withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), "len"))).groupBy("sample_id", "block", "k").agg(F.sum(F.col("len") - F.col("k") + 1).alias("full"))
    sizes = r.groupBy("sample_id", "read_id", "block").agg(F.count("*").alias("n"))
    every = sizes.withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), "n"))).groupBy("sample_id", "block", "k").agg(F.sum(F.col("n") - F.col("k") + 1).alias("every"))
    j = every.join(full, ["sample_id", "block", "k"], "left").withColumn("share", F.coalesce("full", F.lit(0)) / F.col("every"))
    return j.groupBy("sample_id", "block").agg((F.sum(F.col("k") * F.col("share")) / F.sum("k")).alias("mhl"))


def neighbour_r2(reads: DataFrame) -> DataFrame:
    """Squared correlation of neighbouring sites' calls over reads."""
    w = Window.partitionBy("sample_id", "read_id").orderBy("i")
    r = reads.withColumn("next", F.lead("meth").over(w)).where("next is not null")
    return r.groupBy("sample_id", "i").agg(F.count("*").alias("n"), F.corr(F.col("meth").cast("double"), F.col("next").cast("double")).alias("r")).select("sample_id", "i", "n", F.coalesce(F.col("r") * F.col("r"), F.lit(0.0)).alias("r2"))


def good_runs(pairs: DataFrame, by: list[str], at: str, good: Column, min_pairs: int) -> DataFrame:
    """Maximal runs of consecutive good neighbours with at least ``min_pairs`` of them."""
    w = Window.partitionBy(*by).orderBy(at)
    r = pairs.withColumn("__k", F.row_number().over(w)).where(good)
    r = r.withColumn("__island", F.col("__k") - F.row_number().over(w))
    return r.groupBy(*by, "__island").agg(F.min(at).alias("first"), F.max(at).alias("last"), F.count("*").alias("n_pairs")).where(F.col("n_pairs") >= min_pairs).drop("__island")


def end_motifs(ends: DataFrame, k: int = 4, by: str = "sample_id", seq: str = "seq") -> DataFrame:
    """Shares of the first k bases, upper case (ASCII only), motifs with other letters left out."""
    m = ends.select(by, F.translate(F.substring(seq, 1, k), "acgt", "ACGT").alias("motif")).where(F.col("motif").rlike(f"^[ACGT]{{{k}}}$"))
    g = m.groupBy(by, "motif").agg(F.count("*").alias("n"))
    return g.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(by)))


def fragment_bins(fragments: DataFrame, width: int) -> DataFrame:
    """Fragments by the bin of their midpoint."""
    mid = F.col("frag_start") + F.floor(F.col("isize") / 2)
    return fragments.groupBy("sample_id", "chrom", F.floor(mid / width).alias("bin")).agg(F.count("*").alias("n"))


def fragment_lengths(fragments: DataFrame, lo: int = 120, hi: int = 200) -> DataFrame:
    """Shares of short and long fragments and the most frequent length in a window, the smaller on ties."""
    per = fragments.groupBy("sample_id", "isize").agg(F.count("*").alias("n"))
    inside = F.when(F.col("isize").between(lo, hi), F.struct(F.col("n"), -F.col("isize")))
    return per.groupBy("sample_id").agg(
        F.sum("n").alias("n"), (F.sum(F.when(F.col("isize") <= 150, F.col("n")).otherwise(0)) / F.sum("n")).alias("short_share"),
        (F.sum(F.when(F.col("isize") > 220, F.col("n")).otherwise(0)) / F.sum("n")).alias("long_share"), F.max(inside).alias("peak")).select(
        "sample_id", "n", "short_share", "long_share", (-F.col("peak").getField("col2")).alias("mode_length"))


def guardrails(metrics: DataFrame, limits: DataFrame) -> DataFrame:
    """Each metric against its limit (op, value), and whether all of a sample's pass; limits are a small table.

    A value within 1e-12 of its limit's size is at the limit and passes, so the last bits of an
    average, which depend on the order of its sum, do not decide.
    """
    j = metrics.join(limits, "metric")
    near = 1e-12 * F.abs(F.col("limit_value"))
    ok = F.when(F.col("op") == "min", F.col("value") >= F.col("limit_value") - near).otherwise(F.col("value") <= F.col("limit_value") + near)
    return j.groupBy("sample_id").agg(F.count("*").alias("n_metrics"), F.count_if(~ok).alias("n_failed"), F.bool_and(ok).alias("passed"))


def suggest_limits(metrics: DataFrame) -> DataFrame:
    """Fifth, fiftieth and ninety-fifth percentiles of each metric over the cohort."""
    return metrics.groupBy("metric").agg(*[F.percentile("value", q).alias(n) for n, q in (("p5", 0.05), ("p50", 0.5), ("p95", 0.95))])


def quality_dips(cycles: DataFrame, limit: float) -> DataFrame:
    """Runs of consecutive cycles below the limit."""
    w = Window.partitionBy("sample_id").orderBy("cycle")
    bad = cycles.where(F.col("quality") < limit).withColumn("island", F.col("cycle") - F.row_number().over(w))
    return bad.groupBy("sample_id", "island").agg(F.min("cycle").alias("first_cycle"), F.max("cycle").alias("last_cycle"), F.min("quality").alias("lowest")).drop("island")


def dip_pattern(dips: DataFrame, n_cycles: int, edge: int = 10, broad: int = 12) -> DataFrame:
    """none, broad, multi, read_start, read_end or middle by the dips of a sample."""
    g = dips.groupBy("sample_id").agg(F.sum(F.col("last_cycle") - F.col("first_cycle") + 1).alias("n_bad"), F.count("*").alias("n_regions"), F.min("first_cycle").alias("a"), F.max("last_cycle").alias("b"))
    return g.select("sample_id", "n_bad", "n_regions", F.when(F.col("n_bad") >= broad, "broad").when(F.col("n_regions") >= 2, "multi").when(F.col("b") <= edge, "read_start")
                    .when(F.col("a") > n_cycles - edge, "read_end").otherwise("middle").alias("pattern"))


def compare_groups(metrics: DataFrame) -> DataFrame:
    """Differences of group means of each metric for all pairs of groups, over summaries only."""
    g = metrics.groupBy("metric", "grp").agg(F.avg("value").alias("mean"), F.count("*").alias("n"))
    a, b = (g.select("metric", *[F.col(c).alias(f"{c}{k}") for c in ("grp", "mean", "n")]) for k in "12")
    return a.join(b, "metric").where("grp1 < grp2").select("metric", "grp1", "grp2", "n1", "n2", (F.col("mean1") - F.col("mean2")).alias("difference"))
