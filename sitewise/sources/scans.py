"""Scans of site counts and row functions on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import special

#: Schema of a table of per-sample counts.
SITE_COUNTS = T.StructType([T.StructField(n, k) for n, k in (
    ("sample_id", T.StringType()), ("chrom", T.StringType()), ("context", T.StringType()), ("pos", T.LongType()), ("mC", T.LongType()), ("uC", T.LongType()))])


def scan_sites(counts: DataFrame, samples: list[str] | None = None, chroms: list[str] | None = None, contexts: list[str] | None = None, start: int | None = None, end: int | None = None) -> DataFrame:
    """Plain conjunctive filters on a half-open position range, so that they reach the Parquet scan."""
    for c, values in (("sample_id", samples), ("chrom", chroms), ("context", contexts)):
        if values is not None:
            counts = counts.where(F.col(c).isin(values))
    if start is not None:
        counts = counts.where(F.col("pos") >= start)
    return counts if end is None else counts.where(F.col("pos") < end)


def scan_positions(counts: DataFrame, positions: DataFrame) -> DataFrame:
    """Rows at listed (chrom, pos); Spark broadcasts the list only while it is small."""
    return counts.join(positions.select("chrom", "pos").distinct(), ["chrom", "pos"], "left_semi").select(counts.columns)


def shards(counts: DataFrame, width: int) -> DataFrame:
    """Adds the number of the window of ``width`` positions, from each chromosome's first site."""
    first = counts.groupBy("chrom").agg(F.min("pos").alias("__lo"))
    return counts.join(first, "chrom").withColumn("shard", F.floor((F.col("pos") - F.col("__lo")) / width)).drop("__lo")


def decode_tnc(df: DataFrame, packed: str = "tnc") -> DataFrame:
    """Bits 0-4 trinucleotide, 5-6 context, 7 strand."""
    bits = lambda shift, mask: F.shiftright(F.col(packed), shift).bitwiseAND(F.lit(mask))
    context = F.element_at(F.array(*[F.lit(c) for c in ("CG", "CHG", "CHH", "UNKNOWN")]), (bits(5, 3) + 1).cast("int"))
    return df.select("*", bits(0, 31).alias("trinucleotide"), context.alias("context"), F.when(bits(7, 1) == 0, "+").otherwise("-").alias("strand"))


def write_by_context(df: DataFrame, path: str) -> None:
    """One folder per (chrom, context), sorted by position inside the files for range pruning."""
    df.repartition("chrom", "context", F.floor(F.col("pos") / 1_000_000)).sortWithinPartitions("chrom", "context", "pos").write.partitionBy("chrom", "context").parquet(path)


def beta_to_m(beta: Column, eps: float) -> Column:
    b = F.greatest(F.least(beta, F.lit(1 - eps)), F.lit(eps))
    return F.log2(b / (1 - b))


def m_to_beta(m: Column) -> Column:
    return 1 / (1 + F.pow(F.lit(2.0), -m))


def beta_moments(centroid: DataFrame) -> DataFrame:
    """Adds (a, b) of a Beta distribution by the method of moments, each at least 1e-3."""
    mu = F.least(F.greatest(F.col("Sx") / F.col("N"), F.lit(1e-6)), F.lit(1 - 1e-6))
    var = F.greatest((F.col("Sx2") - F.col("Sx") * F.col("Sx") / F.col("N")) / F.greatest(F.col("N") - 1, F.lit(1)), F.lit(1e-12))
    k = F.greatest(mu * (1 - mu) / var - 1, F.lit(1e-3))
    return centroid.select("*", F.greatest(mu * k, F.lit(1e-3)).alias("a"), F.greatest((1 - mu) * k, F.lit(1e-3)).alias("b"))


def beta_distances(pairs: DataFrame) -> DataFrame:
    """Adds Bhattacharyya distance, Hellinger distance, KL and Jeffreys divergence of Beta(a1, b1) and Beta(a2, b2)."""
    lb = special.lbeta
    l1, l2, lm = lb("a1", "b1"), lb("a2", "b2"), lb("(a1 + a2) / 2", "(b1 + b2) / 2")

    def kl(p: str, q: str) -> str:
        return (f"{lb('a' + q, 'b' + q)} - {lb('a' + p, 'b' + p)} + (a{p} - a{q}) * {special.digamma('a' + p)} + (b{p} - b{q}) * {special.digamma('b' + p)} "
                f"+ (a{q} - a{p} + b{q} - b{p}) * {special.digamma(f'(a{p} + b{p})')}")

    rows = pairs.withColumn("bhattacharyya", F.expr(f"({l1} + {l2}) / 2 - {lm}")).withColumn("kl", F.expr(kl("1", "2"))).withColumn("__kl21", F.expr(kl("2", "1")))
    return rows.withColumn("hellinger", F.sqrt(F.greatest(1 - F.exp(-F.col("bhattacharyya")), F.lit(0.0)))).withColumn("jeffreys", F.col("kl") + F.col("__kl21")).drop("__kl21")


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, n): rows that break each rule, counted in one pass."""
    counts = df.agg(*[F.count_if(r).alias(k) for k, r in rules.items()])
    pairs = F.array(*[F.struct(F.lit(k).alias("rule"), F.col(k).alias("n")) for k in rules])
    return counts.select(F.inline(pairs))
