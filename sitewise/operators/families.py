"""Families of modules over stages: each stage's modules are matched to the families seen before."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import materialize
from .running import running

#: Shares of the two similarities, and the floor for modules of one label.
GENE_SHARE, PATHWAY_SHARE, LABEL_FLOOR = 0.7, 0.3, 0.5


def similar_pairs(modules: DataFrame, families: DataFrame, threshold: float) -> DataFrame:
    """(module, family, similarity) of at least ``threshold``: 0.7 gene + 0.3 pathway Jaccard, at least 0.5 where labels agree.

    Both sides hold (key, label, genes, pathways). Pairs come from shared members and labels, so
    a threshold of 0 or less is not defined.
    """
    if threshold <= 0:
        raise ValueError("the threshold is above 0")

    def shared(column: str) -> DataFrame:
        side = lambda df, key: df.select(key, F.explode(F.array_distinct(column)).alias("v"))
        return side(modules, "module").join(side(families, "family"), "v").groupBy("module", "family").agg(F.count("*").alias(f"n_{column}"))

    labels = modules.where("label <> ''").select("module", "label").join(families.select("family", "label"), "label").select("module", "family", F.lit(True).alias("same"))
    pairs = shared("genes").join(shared("pathways"), ["module", "family"], "full").join(labels, ["module", "family"], "full")
    sizes = lambda df, key, p: df.select(key, *[F.size(F.array_distinct(F.coalesce(c, F.array()))).alias(f"{p}_{c}") for c in ("genes", "pathways")])
    j = pairs.join(sizes(modules, "module", "m"), "module").join(sizes(families, "family", "f"), "family")

    def jaccard(c: str):
        n = F.coalesce(f"n_{c}", F.lit(0))
        union = F.col(f"m_{c}") + F.col(f"f_{c}") - n
        return F.when(union > 0, n / union).otherwise(F.lit(0.0))

    sim = GENE_SHARE * jaccard("genes") + PATHWAY_SHARE * jaccard("pathways")
    return j.select("module", "family", F.when(F.col("same"), F.greatest(sim, F.lit(LABEL_FLOOR))).otherwise(sim).alias("similarity")).where(F.col("similarity") >= threshold)


def greedy_match(pairs: DataFrame, ranks: DataFrame) -> DataFrame:
    """(module, family): modules choose by rank, each its most similar family still free, ties to the lower family.

    ``pairs`` holds (module, family, similarity), ``ranks`` (module, rank). In each round every
    module asks for the best family it has left, a family holds the asker of best rank, and pairs
    of that family with worse ranks go. When none goes, what is held is the same as choosing one
    by one, for all families prefer the better rank. No order over all modules is needed.
    """
    left = materialize(pairs.join(ranks, "module").select("module", "family", "rank", "similarity"), "pairs")
    n = left.count()
    while True:
        asked = left.groupBy("module").agg(F.max_by(F.struct("family", "rank"), F.struct(F.col("similarity"), -F.col("family"))).alias("b")).select("module", "b.family", "b.rank")
        held = asked.groupBy("family").agg(F.min("rank").alias("held"))
        fewer = materialize(left.join(held, "family", "left").where(F.col("held").isNull() | (F.col("rank") <= F.col("held"))).select("module", "family", "rank", "similarity"), "pairs")
        m = fewer.count()
        if m == n:
            return asked.select("module", "family")
        left, n = fewer, m


def module_families(modules: DataFrame, threshold: float = 0.35) -> DataFrame:
    """(stage_index, module, rank, score, family, family_label, is_new) of every module.

    ``modules`` holds (stage_index, module, score, label, genes, pathways). Inside a stage
    modules rank by falling score, ties by name. A module joins a family that ``greedy_match``
    gives it, whose members and label then become the module's; else it starts a family, numbered
    on by rank. A family's label is that of its first module. Null lists are empty, null scores 0.
    """
    cols = ["stage_index", "module", F.coalesce("score", F.lit(0.0)).cast("double").alias("score"), F.coalesce("label", F.lit("")).alias("label"), *[F.coalesce(c, F.array().cast("array<string>")).alias(c) for c in ("genes", "pathways")]]
    ranked = running(modules.select(*cols), ["stage_index"], [F.desc("score"), "module"], {"rank": F.lit(1)}).withColumn("rank", F.col("rank").cast("long"))
    ranked = materialize(ranked, "modules")
    stages = [r.stage_index for r in ranked.select("stage_index").distinct().orderBy("stage_index").collect()]
    families: DataFrame | None = None
    out: DataFrame | None = None
    for stage in stages:
        now = ranked.where(F.col("stage_index") == stage)
        if families is None:
            matched = now.select("module", F.lit(None).cast("long").alias("family")).limit(0)
            known = 0
        else:
            matched = materialize(greedy_match(similar_pairs(now, families, threshold), now.select("module", "rank")), "matched")
            known = families.agg(F.max("family")).first()[0]
        fresh = running(now.join(matched.select("module"), "module", "left_anti").select("module", "rank"), [], ["rank"], {"__k": F.lit(1)})
        numbered = fresh.select("module", (F.col("__k") + known).cast("long").alias("family"), F.lit(True).alias("is_new")).unionByName(matched.withColumn("is_new", F.lit(False)))
        rows = now.join(numbered, "module")
        if families is not None:
            rows = rows.join(families.select("family", F.col("family_label").alias("__old")), "family", "left")
        else:
            rows = rows.withColumn("__old", F.lit(None).cast("string"))
        rows = materialize(rows.withColumn("family_label", F.coalesce("__old", F.when(F.col("label") != "", F.col("label")).otherwise(F.col("module")))).drop("__old"), "family-stage")
        seen = rows.select("family", "label", "genes", "pathways", "family_label")
        families = materialize(seen if families is None else families.join(seen.select("family"), "family", "left_anti").unionByName(seen), "families")
        part = rows.select("stage_index", "module", "rank", "score", "family", "family_label", "is_new")
        out = part if out is None else out.unionByName(part)
    return out if out is not None else modules.sparkSession.createDataFrame([], "stage_index long, module string, rank long, score double, family long, family_label string, is_new boolean")
