"""Evidence: thinned coverage, panel checks, thresholds of associations, merged enrichment and module scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .centroid import KEY, coverage, level
from .intervals import overlap
from .running import running

#: Ranks of evidence levels.
LEVELS = {"none": 0, "low": 1, "medium": 2, "high": 3}
#: Least level, publications, scores of two sources, and whether predictions count.
PROFILES = {
    "strict": ("high", 2, 0.5, 0.3, False),
    "balanced": ("medium", 0, 0.3, 0.1, False),
    "permissive": ("low", 0, 0.0, 0.0, True),
}
#: Fixed value: the least positive double.
P_FLOOR = 5e-324
#: Weights of a module's score.
MODULE_WEIGHTS = {"log10q": 0.35, "n_terms": 0.15, "n_genes": 0.15, "gene_weight": 0.15, "overlap": 0.2}


def thin_coverage(counts: DataFrame, cap: int, seed: int = 0) -> DataFrame:
    """Counts of sites deeper than the cap, each read kept with probability cap / coverage; others unchanged.

    A read's draw is a hash of seed, sample, site, state and its number, so that reruns agree
    however rows are dealt, and kept counts are binomial. Repeated rows get the same draws;
    null counts stay null.
    """
    def kept(column: str) -> Column:
        draw = lambda i: F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(column), "sample_id", *KEY, i), 11) / F.lit(2.0**53)
        some = F.size(F.filter(F.sequence(F.lit(1).cast("long"), F.col(column)), lambda i: draw(i) < F.col("__share")))
        return F.when((F.col("__share") < 1) & (F.col(column) > 0), some.cast("long")).otherwise(F.col(column))

    # The share stands in a column of its own: inside a lambda a new mC would hide the old one.
    rows = counts.withColumn("__share", F.lit(cap) / F.greatest(coverage(), F.lit(1)))
    return rows.withColumns({"__m": kept("mC"), "__u": kept("uC")}).withColumns({"mC": F.col("__m"), "uC": F.col("__u")}).drop("__share", "__m", "__u")


def panel_qc(counts: DataFrame, regions: DataFrame) -> DataFrame:
    """Sites, sites on target and their coverage, and levels in control regions of each sample.

    ``regions.kind`` is target, positive or negative. Overlapping regions count a site once;
    a sample without a site on target or in controls has nulls there.
    """
    at = overlap(counts.select("chrom", "pos").distinct(), regions.select("chrom", "region_start", "region_end", "kind"))
    kinds = at.groupBy("chrom", "pos").agg(*[F.max(F.col("kind") == k).alias(k) for k in ("target", "positive", "negative")])
    rows = counts.join(kinds, ["chrom", "pos"], "left").withColumn("x", F.when(coverage() > 0, level()))
    on = F.when(F.col("target"), coverage())
    g = rows.groupBy("sample_id").agg(
        F.count("*").alias("n_sites"), F.count_if(F.col("target")).alias("n_on_target"), F.avg(on).alias("on_target_mean_coverage"), F.percentile(on, 0.5).alias("on_target_median_coverage"),
        F.avg(F.when(F.col("positive"), F.col("x"))).alias("positive_level"), F.avg(F.when(F.col("negative"), F.col("x"))).alias("negative_level"))
    return g.withColumn("on_target_fraction", F.col("n_on_target") / F.col("n_sites"))


def merge_stable(panels: DataFrame, key: list[str]) -> DataFrame:
    """One row per site of several stable panels: the largest frequency, then the largest effect, nulls last."""
    rest = [c for c in panels.columns if c not in key]
    least = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(float("-inf")))
    best = F.max_by(F.struct(*rest), F.struct(least("frequency"), least("effect_size"), *rest))
    return panels.groupBy(*key).agg(best.alias("__b")).select(*key, "__b.*")


def partition_coverage(loci: DataFrame, features: DataFrame, regions: list[str], min_loci: int = 1) -> DataFrame:
    """(label, region, n_loci, enough): distinct loci of each label in each region of the list, whether they are enough, and a last row without label for all.

    In the last row ``n_loci`` counts loci in any region of the list that carry no unknown feature.
    """
    j = loci.select(*KEY, "label").distinct().join(features.select(*KEY, "feature_type").distinct(), KEY, "left")
    per = j.where(F.col("feature_type").isin(regions)).groupBy("label", F.col("feature_type").alias("region")).agg(F.countDistinct(*KEY).alias("n_loci"))
    flags = j.groupBy(*KEY).agg(F.max((F.coalesce("feature_type", F.lit("unknown")) == "unknown")).alias("lost"), F.max(F.coalesce(F.col("feature_type").isin(regions), F.lit(False))).alias("found"))
    total = flags.agg(F.count_if(F.col("found") & ~F.col("lost")).alias("n_loci")).select(F.lit(None).cast("string").alias("label"), F.lit(None).cast("string").alias("region"), "n_loci")
    return per.unionByName(total).withColumn("enough", F.col("n_loci") >= min_loci)


def signature_overlap(selected: DataFrame, signatures: DataFrame, a: str, b: str) -> DataFrame:
    """Genes of each panel in two signatures, as numbers and shares of the signature, and which share is larger."""
    wanted = signatures.where(F.col("signature").isin(a, b)).select("signature", "gene").distinct()
    flags = wanted.groupBy("gene").agg(F.max(F.col("signature") == a).alias("in_a"), F.max(F.col("signature") == b).alias("in_b"))
    size = flags.agg(F.count_if("in_a").alias("size_a"), F.count_if("in_b").alias("size_b"))
    g = selected.select("panel", "gene").distinct().join(flags, "gene", "left").groupBy("panel").agg(F.count("*").alias("n_selected"), F.count_if("in_a").alias("n_a"), F.count_if("in_b").alias("n_b"))
    share = lambda k: F.when(F.col(f"size_{k}") > 0, F.col(f"n_{k}") / F.col(f"size_{k}")).otherwise(F.lit(0.0))
    rows = g.crossJoin(F.broadcast(size)).withColumns({"share_a": share("a"), "share_b": share("b")})  # one row
    dominant = F.when(F.col("share_a") > F.col("share_b"), a).when(F.col("share_b") > F.col("share_a"), b).otherwise("tie")
    return rows.select("panel", "n_selected", "n_a", "n_b", "share_a", "share_b", dominant.alias("dominant"))


def meets(profile: str) -> Column:
    """Whether an association passes a profile; null levels are none, null numbers 0."""
    level_at_least, publications, disgenet, targets, predicted = PROFILES[profile]
    ranks = F.lit(0)
    for name, rank in LEVELS.items():
        ranks = F.when(F.lower("evidence_level") == name, rank).otherwise(ranks)
    score = F.coalesce(F.col("score"), F.lit(0.0))
    low = ((F.col("source") == "disgenet") & (score < disgenet)) | ((F.col("source") == "open_targets") & (score < targets))
    guess = F.lit(False) if predicted else F.coalesce(F.lower("association_type") == "predicted", F.lit(False))
    return (F.coalesce(F.col("associated"), F.lit(False)) & ~guess & (ranks >= LEVELS[level_at_least])
            & (F.coalesce(F.col("publications"), F.lit(0)) >= publications) & ~F.coalesce(low, F.lit(False)))


def select_sites(rows: DataFrame, limits: dict[str, float], top: int | None = None, by: str = "q_value") -> DataFrame:
    """Rows within all limits: ``max_x`` and ``min_x`` of the column's size; limits of absent columns are left out.

    ``top`` keeps the best by one column, least first for q-values and overlaps, ties by site.
    """
    for name, limit in limits.items():
        side, column = name.split("_", 1)
        if column in rows.columns:
            rows = rows.where(F.abs(column) <= limit if side == "max" else F.abs(column) >= limit)
    if top is None:
        return rows
    by = by if by in rows.columns else "q_value"
    place = F.round(by, 9)
    return rows.orderBy(place if by in ("q_value", "overlap") else F.desc(place), *KEY).limit(top)


def merge_libraries(terms: DataFrame, supporting: list[str]) -> DataFrame:
    """Adds the combined score -ln(p) * odds, p floored, and the place of each term: libraries in the list come after all others.

    Places go by q, p and falling odds, each to 9 digits, then by name; ``block`` is 0 for primary libraries.
    Null p and q count as 1, null odds as 0; a score that is not finite is null.
    """
    p = lambda c: F.coalesce(F.greatest(F.col(c), F.lit(P_FLOOR)), F.lit(1.0))
    rows = terms.withColumns({"p_value": p("p_value"), "q_value": p("q_value")}).withColumn("__s", -F.log("p_value") * F.coalesce("odds_ratio", F.lit(0.0)))
    rows = rows.withColumn("combined_score", F.when(F.abs("__s") < float("inf"), F.col("__s"))).drop("__s").withColumn("block", F.col("library").isin(supporting).cast("int"))
    order = [F.round("q_value", 9), F.round("p_value", 9), F.desc(F.round(F.coalesce("odds_ratio", F.lit(0.0)), 9)), "library", "term"]
    return running(rows.withColumn("__one", F.lit(1)), ["block"], order, {"place": "__one"}).drop("__one")


def module_scores(modules: DataFrame, terms: DataFrame, genes: DataFrame, weights: DataFrame) -> DataFrame:
    """Score of each module in 0..1 from its terms and genes, with the parts of its activity.

    modules: (module, term); terms: (term, q_value, combined_score, overlap_abs); genes: (term, gene);
    weights: (gene, w, effect). A gene without a weight weighs 1 and has no effect; a module
    whose terms were not tested scores 0.
    """
    m = modules.distinct()
    log10q = -F.log10(F.greatest(F.coalesce(F.col("q_value"), F.lit(1.0)), F.lit(1e-10)))
    t = m.join(terms, "term", "left").groupBy("module").agg(
        F.countDistinct("term").alias("n_terms"), F.count("q_value").alias("n_tested"), F.avg(F.when(F.col("q_value").isNotNull(), log10q)).alias("activity_log10q"),
        F.avg("combined_score").alias("activity_combined"), F.avg(F.when(F.col("q_value").isNotNull(), F.coalesce("overlap_abs", F.lit(0.0)))).alias("activity_overlap"))
    g = m.join(genes, "term").select("module", "gene").distinct().join(weights, "gene", "left").groupBy("module").agg(
        F.count("*").alias("n_genes"), F.avg(F.coalesce("w", F.lit(1.0))).alias("__w"), F.avg(F.abs(F.coalesce("effect", F.lit(0.0)))).alias("activity_gene"))
    rows = t.join(g, "module", "left").na.fill(0, ["n_genes"]).na.fill(0.0, ["activity_log10q", "activity_combined", "activity_overlap", "activity_gene"]).na.fill(1.0, ["__w"])
    part = {"log10q": F.col("activity_log10q") / 10, "n_terms": F.col("n_terms") / 50, "n_genes": F.col("n_genes") / 200, "gene_weight": F.col("__w"), "overlap": F.col("activity_overlap")}
    clip = lambda c: F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))
    score = sum((clip(part[k]) * w for k, w in MODULE_WEIGHTS.items()), F.lit(0.0))
    return rows.select("module", "n_terms", "n_genes", F.when(F.col("n_tested") > 0, clip(score)).otherwise(F.lit(0.0)).alias("score"), "activity_log10q", "activity_combined", "activity_overlap", "activity_gene")


def normal_overlap(pairs: DataFrame) -> DataFrame:
    """Adds ``overlap_normal``, exp(-(difference of means)^2 / (4 * sum of variances)), of two normals a site."""
    d = F.col("mean1") - F.col("mean2")
    return pairs.withColumn("overlap_normal", F.exp(-d * d / F.greatest(4 * (F.col("var1") + F.col("var2")), F.lit(1e-12))))


def log_probability(counts: DataFrame, bins: DataFrame) -> DataFrame:
    """Sum over shared sites of the log density of each sample's level in a centroid's histogram, equal bins on 0..1.

    A level without coverage is 0.5; an empty bin has density 1e-12.
    """
    x = F.when(coverage() > 0, level()).otherwise(F.lit(0.5))
    j = counts.select("sample_id", *KEY, x.alias("x")).join(bins.select(*KEY, "bin_counts"), KEY)
    size, n = F.size("bin_counts"), F.aggregate("bin_counts", F.lit(0).cast("long"), lambda s, v: s + v)
    at = F.element_at("bin_counts", F.least(F.floor(F.round(F.col("x") * size, 9)) + 1, size).cast("int"))
    return j.withColumn("__l", F.log(F.greatest(at * size / n, F.lit(1e-12)))).groupBy("sample_id").agg(F.count("*").alias("n_sites"), F.sum("__l").alias("log_p"))
