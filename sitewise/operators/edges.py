"""Evidence for network edges over runs, against a known network."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Shares of recurrence, mean score and co-presence, and the two limits of a status.
SHARES, NOVEL, SUPPORTED = (0.5, 0.3, 0.2), 0.55, 0.70


def edge_evidence(evidence: DataFrame, known: DataFrame, known_threshold: float) -> DataFrame:
    """One row for each edge of (gene_a, gene_b, source_run, observed_score, evidence_type), with counts, score and status.

    The score is half the runs that show the edge, 0.3 the mean observed score in thousandths of
    its range to 1,000, and 0.2 the times it came as 'module_copresence', the first and last as
    shares of the largest of all edges. ``known`` holds (gene_a, gene_b, score), the largest of
    repeats counting; both tables are taken without direction. An edge is missing from it, below
    the threshold or known; accepted as novel if missing with a score of 0.55 or more, as
    supported from 0.70, else a candidate. Edges of a gene to itself do not count, null scores
    count 0.
    """
    ends = [F.least("gene_a", "gene_b").alias("gene_a"), F.greatest("gene_a", "gene_b").alias("gene_b")]
    rows = evidence.where("gene_a <> gene_b").select(*ends, "source_run", F.coalesce(F.col("observed_score").cast("double"), F.lit(0.0)).alias("s"), "evidence_type")
    g = rows.groupBy("gene_a", "gene_b").agg(
        F.count("*").alias("occurrences"), F.countDistinct("source_run").alias("support_runs"), F.avg("s").alias("mean_score"), F.max("s").alias("max_score"),
        F.count_if(F.col("evidence_type") == "module_copresence").alias("copresences"))
    most = g.agg(F.greatest(F.max("support_runs"), F.lit(1)).alias("__r"), F.greatest(F.max("copresences"), F.lit(1)).alias("__c"))
    parts = (F.col("support_runs") / F.col("__r"), F.least(F.greatest("mean_score", F.lit(0.0)), F.lit(1000.0)) / 1000, F.col("copresences") / F.col("__c"))
    score = F.least(F.greatest(sum(w * p for w, p in zip(SHARES, parts)), F.lit(0.0)), F.lit(1.0))
    scored = g.crossJoin(F.broadcast(most)).withColumn("score", score).drop("__r", "__c")  # one row beside all
    network = known.where("gene_a <> gene_b").select(*ends, F.col("score").cast("double").alias("known_score")).groupBy("gene_a", "gene_b").agg(F.max("known_score").alias("known_score"))
    j = scored.join(network.withColumn("in_known", F.lit(True)), ["gene_a", "gene_b"], "left").withColumn("in_known", F.coalesce("in_known", F.lit(False)))
    novelty = F.when(~F.col("in_known"), "missing").when(F.coalesce("known_score", F.lit(0.0)) < known_threshold, "known_below_threshold").otherwise("known")
    status = F.when((F.col("novelty") == "missing") & (F.col("score") >= NOVEL), "accepted_novel").when(F.col("score") >= SUPPORTED, "accepted_supported").otherwise("candidate")
    return j.withColumn("known_score", F.coalesce("known_score", F.lit(0.0))).withColumn("novelty", novelty).withColumn("status", status)
