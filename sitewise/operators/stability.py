"""Recurrence over repeated runs, splits and panel comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import fdr


def hash31(*parts: Column | int) -> Column:
    """An arithmetic hash of integers below 2**31, the same in any SQL engine."""
    primes = (48271, 69621, 16807)
    total = sum((F.lit(p) if isinstance(p, int) else p) * m for p, m in zip(parts, primes))
    return total % 2147483647


def mixed31(*parts: Column | int) -> Column:
    """``hash31`` squared twice: a linear hash of running numbers, taken modulo a size, only goes round."""
    x = hash31(*parts)
    for add in (11, 1009):
        x = (x + add) * (x + add) % 2147483647
    return x


def collapse_runs(runs: DataFrame, key: list[str]) -> DataFrame:
    """One row per run and locus: mean effect, exact median p, sign of the mean delta with 0 as +1."""
    return runs.groupBy("run_id", *key).agg(
        F.avg("effect_size").alias("effect_size"), F.percentile("p_value", 0.5).alias("p_value"),
        F.when(F.avg("delta_mean") < 0, -1).otherwise(1).alias("sign"))


def recurrence(runs: DataFrame, key: list[str]) -> DataFrame:
    """Frequency over runs, mean effect and signed Stouffer of each locus with its q-value."""
    per = collapse_runs(runs, key)
    n = per.agg(F.countDistinct("run_id").alias("n_runs"))
    from .genes import stouffer

    combined = stouffer(per.withColumn("w", F.lit(1.0)), key)
    g = per.groupBy(*key).agg(F.count("*").alias("n_present"), F.avg("effect_size").alias("effect_size"))
    rows = g.join(combined, key).crossJoin(F.broadcast(n)).withColumn("frequency", F.col("n_present") / F.col("n_runs"))  # n: one row
    return fdr.benjamini_hochberg(rows, "p_combined", [])


def split(samples: DataFrame, seeds: DataFrame, fraction: float, by: str = "cohort") -> DataFrame:
    """(run_id, sample, part): train takes max(1, floor(n * fraction)) per cohort, one less if that is all.

    Order within a cohort is by an arithmetic hash of (seed, id), so any engine and any
    partitioning gives the same split. Seeds are few; every sample is listed once per seed.
    """
    w = Window.partitionBy("run_id", by).orderBy("h", "sample_id")
    rows = samples.crossJoin(seeds).withColumn("h", hash31(F.col("sample_id").cast("long"), F.col("run_id")))
    n = F.count("*").over(Window.partitionBy("run_id", by))
    take = F.greatest(F.floor(n * fraction), F.lit(1))
    take = F.when((take >= n) & (n > 1), n - 1).otherwise(take)
    return rows.withColumn("part", F.when(F.row_number().over(w) <= take, "train").otherwise("test")).select("run_id", "sample_id", by, "part")


def jaccard(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """Sizes, overlap and Jaccard of two panels; two empty panels have 1."""
    both = a.select(*key, F.lit(1).alias("__a")).distinct().join(b.select(*key, F.lit(1).alias("__b")).distinct(), key, "full")
    g = both.agg(F.count("__a").alias("n_a"), F.count("__b").alias("n_b"), F.count_if(F.col("__a").isNotNull() & F.col("__b").isNotNull()).alias("n_shared"))
    union = F.col("n_a") + F.col("n_b") - F.col("n_shared")
    return g.select("n_a", "n_b", "n_shared", (F.col("n_a") - F.col("n_shared")).alias("only_a"), (F.col("n_b") - F.col("n_shared")).alias("only_b"),
                    F.when(union > 0, F.col("n_shared") / union).otherwise(F.lit(1.0)).alias("jaccard"))


def rank_agreement(a: DataFrame, b: DataFrame, key: list[str], value: str) -> DataFrame:
    """Spearman correlation of shared keys, from average ranks, and share of equal signs."""
    both = a.select(*key, F.col(value).alias("x")).join(b.select(*key, F.col(value).alias("y")), key)
    ranked = fdr.average_rank(fdr.average_rank(both, "x", [], "rx"), "y", [], "ry")
    return ranked.agg(F.count("*").alias("n_shared"), F.corr("rx", "ry").alias("spearman"), F.avg((F.signum("x") == F.signum("y")).cast("double")).alias("same_sign"))


def in_all(rows: DataFrame, member: str, key: list[str], share: float = 1.0, by: list[str] | None = None) -> DataFrame:
    """(by, key) of the keys that at least ``share`` of the members have, all of them by default; members with a null name do not count."""
    by = by or []
    known = rows.where(F.col(member).isNotNull())
    total = known.groupBy(*by).agg(F.countDistinct(member).alias("__all"))
    found = known.groupBy(*by, *key).agg(F.countDistinct(member).alias("__n"))
    both = found.join(total, by) if by else found.crossJoin(F.broadcast(total))  # one row
    return both.where(F.col("__n") >= share * F.col("__all")).select(*by, *key)


def convergence(runs: DataFrame, key: list[str], min_frequency: float, lag: int) -> DataFrame:
    """For each k: the panel of loci in at least that share of the first k runs, against the panel ``lag`` runs before.

    Between two runs that show it a locus's count stays, so it is in the panels of a span of k.
    Spans cost a row for each appearance; sizes and shared loci are sums of spans' beginnings and
    ends, those of a locus added up in a window of its own.
    """
    first = runs.select("run_id", *key).distinct()
    order = runs.select("run_id").distinct().withColumn("k", F.row_number().over(Window.orderBy("run_id")).cast("long"))  # one row per run
    last = order.agg(F.max("k").alias("last"))
    w = Window.partitionBy(*key).orderBy("k")
    rows = first.join(order, "run_id").crossJoin(F.broadcast(last))  # one row
    seen = rows.select(*key, F.col("k").alias("s"), F.row_number().over(w).cast("long").alias("n"), F.coalesce(F.lead("k").over(w) - 1, F.col("last")).alias("until"))
    # The last k with n >= share * k, whatever the rounding of the quotient.
    near = [F.floor(F.col("n") / min_frequency) + d for d in (1, 0, -1)]
    end = F.least(F.coalesce(*[F.when(F.col("n") >= min_frequency * k, k) for k in near], F.lit(0)), F.col("until"))
    spans = seen.withColumn("e", end).where("e >= s").select(*key, "s", "e")

    def steps(df: DataFrame, begin: str, after: str) -> DataFrame:
        return df.select(F.explode(F.array(F.struct(F.col(begin).alias("k"), F.lit(1).alias("d")), F.struct(F.col(after).alias("k"), F.lit(-1).alias("d")))).alias("x")).select("x.*")

    def at_each_run(changes: DataFrame, name: str) -> DataFrame:
        total = changes.groupBy("k").agg(F.sum("d").alias("d"))
        return order.select("k").join(total, "k", "left").select("k", F.sum(F.coalesce("d", F.lit(0))).over(Window.orderBy("k").rowsBetween(Window.unboundedPreceding, 0)).alias(name))

    size = at_each_run(steps(spans.withColumn("after", F.col("e") + 1), "s", "after"), "size")
    change = lambda k, a, b: F.struct(k.alias("k"), F.lit(a).alias("a"), F.lit(b).alias("b"))
    s, e = F.col("s"), F.col("e") + 1
    moves = spans.select(*key, F.explode(F.array(change(s, 1, 0), change(e, -1, 0), change(s + lag, 0, 1), change(e + lag, 0, -1))).alias("x")).groupBy(*key, F.col("x.k").alias("k")).agg(F.sum("x.a").alias("a"), F.sum("x.b").alias("b"))
    up_to = w.rowsBetween(Window.unboundedPreceding, 0)
    both = moves.select("k", F.sum("a").over(up_to).alias("in_now"), F.sum("b").over(up_to).alias("in_old"), F.lead("k").over(w).alias("after")).where("in_now > 0 and in_old > 0")
    shared = at_each_run(steps(both, "k", "after"), "shared")
    old = size.select((F.col("k") + lag).alias("k"), F.col("size").alias("old_size"))
    j = size.join(old, "k").join(shared, "k").where("size > 0 and old_size > 0")
    return j.select(F.col("k").cast("int").alias("k"), "size", (F.col("size") - F.col("old_size")).alias("delta"), (F.col("shared") / (F.col("size") + F.col("old_size") - F.col("shared"))).alias("jaccard"))


def summary(long: DataFrame, by: list[str], value: str = "value") -> DataFrame:
    """Mean, sd, min, max, 5, 50 and 95 % quantiles and the 95 % interval of the mean."""
    g = long.groupBy(*by).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"), F.min(value).alias("min"), F.max(value).alias("max"),
        F.percentile(value, 0.05).alias("p5"), F.percentile(value, 0.5).alias("p50"), F.percentile(value, 0.95).alias("p95"))
    half = 1.96 * F.col("sd") / F.sqrt("n")
    return g.select("*", (F.col("mean") - half).alias("ci_low"), (F.col("mean") + half).alias("ci_high"))


def constant_or_summary(long: DataFrame, by: list[str], value: str = "value") -> DataFrame:
    """The value where all runs agree, else null, with the number of distinct values."""
    return long.groupBy(*by).agg(F.countDistinct(value).alias("n_distinct"), F.min(value).alias("lo"), F.max(value).alias("hi")).select(
        *by, "n_distinct", F.when(F.col("n_distinct") == 1, F.col("lo")).alias("constant"), (F.col("hi") - F.col("lo")).alias("spread"))


def locus_categories(stages: DataFrame, key: list[str]) -> DataFrame:
    """core: in every stage; stage_specific_X: in one; partial otherwise."""
    total = stages.agg(F.countDistinct("stage_index").alias("all"))
    g = stages.groupBy(*key).agg(F.countDistinct("stage_index").alias("n"), F.min("stage_index").alias("first")).crossJoin(F.broadcast(total))
    return g.select(*key, F.when(F.col("n") == F.col("all"), F.lit("core")).when(F.col("n") == 1, F.concat(F.lit("stage_specific_"), F.col("first").cast("string"))).otherwise("partial").alias("category"))
