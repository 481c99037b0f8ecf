"""Filters, lookups and selections on annotated genes, terms and panels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .running import running

#: Fixed order of evidence levels, weakest first.
EVIDENCE = ("none", "predicted", "weak", "moderate", "strong", "definitive")


def evidence_rank(level: Column) -> Column:
    """Place of a level in EVIDENCE, 0 for unknown ones."""
    return F.greatest(F.array_position(F.array(*[F.lit(e) for e in EVIDENCE]), F.lower(level)) - 1, F.lit(0))


def filter_genes(genes: DataFrame, **limits: float | None) -> DataFrame:
    """Rows within all given limits: ``min_<column>`` and ``max_<column>``; a null passes a maximum only."""
    tests = []
    for name, v in limits.items():
        if v is None:
            continue
        side, column = name.split("_", 1)
        c = F.col(column)
        tests.append(c >= v if side == "min" else c.isNull() | (c <= v))
    return genes.where(reduce(Column.__and__, tests)) if tests else genes


def any_hits(genes: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a hit in at least one of the columns."""
    return genes.where(reduce(Column.__or__, [F.col(c) > 0 for c in columns]))


def theme(df: DataFrame, term: str, patterns: DataFrame) -> DataFrame:
    """The theme of the first pattern, by order, found in the term; ``patterns`` is a short list."""
    hits = df.select(term).distinct().join(patterns, F.expr(f"rlike({term}, pattern)"))
    best = hits.groupBy(term).agg(F.min_by("theme", "priority").alias("theme"))
    return df.join(best, term, "left").withColumn("theme", F.coalesce("theme", F.lit("other")))


def tiles_with_sites(tiles: DataFrame, sites: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Tiles that hold at least one listed site, for each value of ``by``: their positions are exploded and looked up."""
    hit = tiles.select("chrom", "tile_start", F.explode("positions").alias("pos")).join(sites.select(*by, "chrom", "pos").distinct(), ["chrom", "pos"])
    return tiles.join(hit.select(*by, "chrom", "tile_start").distinct(), ["chrom", "tile_start"])


def annotate(sites: DataFrame, mapped: DataFrame, on: list[str], columns: list[str]) -> DataFrame:
    """Values of the mapper over the site's own ones, and whether it knew the site."""
    m = mapped.select(*on, *[F.col(c).alias(f"__{c}") for c in columns], F.lit(True).alias("matched")).dropDuplicates(on)
    j = sites.join(m, on, "left")
    return j.withColumns({c: F.coalesce(f"__{c}", c) for c in columns} | {"matched": F.coalesce("matched", F.lit(False))}).drop(*[f"__{c}" for c in columns])


def best_by_gene(evidence: DataFrame, text: str, term: str) -> DataFrame:
    """Per gene the row of best score among those whose text holds the term; ties to the smaller text."""
    rows = evidence.where(F.lower(F.col(text)).contains(term.lower()))
    return rows.groupBy("gene").agg(F.max("score").alias("score"), F.min_by(text, F.struct(-F.col("score"), F.col(text))).alias(text), F.count("*").alias("n_rows"))


def merge_sources(genes: DataFrame, sources: list[tuple[str, DataFrame]]) -> DataFrame:
    """Score of the first source, in order, that knows the gene, and that source's name."""
    out = genes
    for name, s in sources:
        out = out.join(s.select("gene", F.col("score").alias(f"__{name}")), "gene", "left")
    chosen = F.coalesce(*[F.when(F.col(f"__{n}").isNotNull(), F.lit(n)) for n, _ in sources], F.lit("none"))
    return out.select(*genes.columns, F.coalesce(*[F.col(f"__{n}") for n, _ in sources]).alias("score"), chosen.alias("source"))


def gene_recurrence(runs: DataFrame) -> DataFrame:
    """Share of runs with the gene, its mean effect, and its mean rank over the runs."""
    per = runs.groupBy("run_id", "gene_id").agg(F.avg("effect_size").alias("effect"))
    n = per.agg(F.countDistinct("run_id").alias("n_runs"))
    return per.groupBy("gene_id").agg(F.count("*").alias("n_present"), F.avg("effect").alias("effect")).crossJoin(F.broadcast(n)).withColumn("frequency", F.col("n_present") / F.col("n_runs"))


def tiers(panel: DataFrame, strict: float, relaxed: float) -> DataFrame:
    """Stable score effect * sqrt(frequency) with the tier by frequency; rows below both are left out."""
    tier = F.when(F.col("frequency") >= strict, "strict").when(F.col("frequency") >= relaxed, "relaxed")
    return panel.withColumn("stable_score", F.col("effect_size") * F.sqrt("frequency")).withColumn("tier", tier).where("tier is not null")


def gene_plateau(ranked: DataFrame, patience: int) -> DataFrame:
    """Smallest k after which ``patience`` further sites bring no new gene; input (rank, gene_id).

    Only the first rank of each gene is ordered.
    """
    first = ranked.groupBy("gene_id").agg(F.min("rank").alias("rank"))
    end = ranked.agg(F.max("rank").alias("end"))
    placed = running(first, [], ["rank"], {"n_genes": F.lit(1)})
    after = placed.select((F.col("n_genes") - 1).alias("n_genes"), F.col("rank").alias("next"))
    gaps = placed.join(after, "n_genes", "left").crossJoin(F.broadcast(end))  # one row
    flat = gaps.where(F.coalesce("next", F.col("end") + 1) - F.col("rank") > patience)
    return flat.agg(F.min("rank").alias("k"), F.min("n_genes").alias("n_genes"))


def expand_grid(axes: list[DataFrame]) -> DataFrame:
    """All combinations of short tables of parameter values."""
    return reduce(lambda a, b: a.crossJoin(b), axes)


def objective(metrics: DataFrame, weights: dict[str, float], gates: dict[str, float]) -> DataFrame:
    """Weighted sum of metrics with the rank among the rows that pass all minimum gates."""
    total = reduce(Column.__add__, [F.col(k) * v for k, v in weights.items()])
    ok = reduce(Column.__and__, [F.col(k) >= v for k, v in gates.items()])
    return metrics.withColumn("objective", total).withColumn("passed", ok).withColumn("rank", F.when(F.col("passed"), F.row_number().over(Window.partitionBy("passed").orderBy(F.desc("objective"), "id"))))  # a row per trial


def methylation_call(xm: Column, ref: Column, base: Column, conversion: Column) -> Column:
    """1 methylated, 0 not, null no call: by the XM letter where there is one, else by reference and base."""
    by_letter = F.when(xm.isin("Z", "X", "H"), 1).when(xm.isin("z", "x", "h"), 0)
    top = F.when((conversion == "CT") & (ref == "C"), F.when(base == "C", 1).when(base == "T", 0))
    bottom = F.when((conversion == "GA") & (ref == "G"), F.when(base == "G", 1).when(base == "A", 0))
    return F.coalesce(by_letter, top, bottom)
