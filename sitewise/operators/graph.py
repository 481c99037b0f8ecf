"""Gene sets, pathway similarity, networks and stage tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import special
from ..shared import materialize
from . import fdr
from .running import running


def pathway_key(term: Column) -> Column:
    """Trimmed, single-spaced, lower-case form of a term."""
    return F.lower(F.trim(F.regexp_replace(term, r"\s+", " ")))


def merge_terms(sets: DataFrame) -> DataFrame:
    """Gene sets united over terms with the same key."""
    return sets.select("library", pathway_key(F.col("term")).alias("term"), "gene").distinct()


def over_representation(sets: DataFrame, genes: DataFrame, by: list[str]) -> DataFrame:
    """Hypergeometric tail, odds ratio and Benjamini-Hochberg q of each term, on the sets' own background.

    Log binomials come from one lgamma expression; the tail adds min(K, n) - k + 1 terms.
    """
    members = sets.select(*by, "gene").distinct()
    background = members.select("gene").distinct()
    query = genes.select("gene").distinct().join(background, "gene", "left_semi").withColumn("hit", F.lit(1))
    sizes = background.agg(F.count("*").alias("n_all")).crossJoin(query.agg(F.count("*").alias("n_query")))  # one row
    g = members.join(query, "gene", "left").groupBy(*by).agg(F.count("*").alias("term_size"), F.count("hit").alias("n_hit")).crossJoin(F.broadcast(sizes))
    terms = g.withColumn("i", F.explode(F.sequence("n_hit", F.least("term_size", "n_query"))))
    lc = lambda a, b: f"({special.lgamma(f'({a}) + 1')} - {special.lgamma(f'({b}) + 1')} - {special.lgamma(f'({a}) - ({b}) + 1')})"
    fits = F.col("n_query") - F.col("i") <= F.col("n_all") - F.col("term_size")
    log_p = f"{lc('term_size', 'i')} + {lc('n_all - term_size', 'greatest(n_query - i, 0)')} - {lc('n_all', 'n_query')}"
    p = F.when(fits, F.exp(F.expr(log_p))).otherwise(F.lit(0.0))
    tail = terms.groupBy(*by, "term_size", "n_hit", "n_all", "n_query").agg(F.least(F.sum(p), F.lit(1.0)).alias("p_value"))
    hit, size, query_size, rest = (F.col(c) for c in ("n_hit", "term_size", "n_query", "n_all"))
    odds = (hit + 0.5) * (rest - size - query_size + hit + 0.5) / ((size - hit + 0.5) * (query_size - hit + 0.5))
    return fdr.benjamini_hochberg(tail.withColumn("odds_ratio", odds), "p_value", by[:-1])


def term_overlap_weights(sets: DataFrame, weights: DataFrame) -> DataFrame:
    """Mean, mean absolute value, sum and number of the weights of a term's genes."""
    j = sets.join(weights, "gene")
    return j.groupBy("library", "term").agg(F.count("*").alias("n"), F.avg("w").alias("mean_w"), F.avg(F.abs(F.col("w"))).alias("mean_abs_w"), F.sum("w").alias("sum_w"))


def similarity_edges(sets: DataFrame, threshold: float, coefficient: str = "jaccard") -> DataFrame:
    """Pairs of terms with that much Jaccard or overlap coefficient.

    Candidates come from prefixes: of a term's n genes, rarest first, the first n - k + 1
    must hold a gene shared with any term that shares k or more, and k is at least
    ceil(threshold * n). So common genes form no pairs but where nothing rarer is left, and
    only candidates are counted exactly.
    """
    s = sets.select("term", "gene").distinct()
    rarity = s.groupBy("gene").agg(F.count("*").alias("df"))
    of_term = Window.partitionBy("term")
    ordered = s.join(rarity, "gene").select("term", "gene", F.row_number().over(of_term.orderBy("df", "gene")).alias("place"), F.count("*").over(of_term).alias("n"))
    ordered = materialize(ordered, "terms")
    prefix = ordered.where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1).select("gene", F.col("term").alias("a"), F.col("n").alias("na"))
    # The smaller term's prefix meets the other's prefix for Jaccard, all its genes for the overlap coefficient.
    other = (prefix if coefficient == "jaccard" else ordered.select("gene", F.col("term").alias("a"), F.col("n").alias("na"))).select("gene", F.col("a").alias("b"), F.col("na").alias("nb"))
    smaller = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
    sized = smaller & (F.col("na") >= threshold * F.col("nb") - 1e-9) if coefficient == "jaccard" else smaller
    pairs = materialize(prefix.join(other, "gene").where(sized).select("a", "b", "na", "nb").distinct(), "term-pairs")
    genes = s.select("term", "gene")
    both = pairs.join(genes.withColumnRenamed("term", "a"), "a").join(genes.withColumnRenamed("term", "b"), ["b", "gene"])
    shared = both.groupBy("a", "b", "na", "nb").agg(F.count("*").alias("k"))
    below = F.least("na", "nb") if coefficient == "overlap" else F.col("na") + F.col("nb") - F.col("k")
    return shared.withColumn("weight", F.col("k") / below).where(F.col("weight") >= threshold).select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst"), "weight")


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, component): the smallest name reachable, by minimum labels with shortcuts.

    Each round takes the smallest label around a node and then the label of that label, so
    the rounds grow with the logarithm of a component's width. Rounds are written to the
    shared folder; only a count of changes reaches the driver.
    """
    both = edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).where("src <> dst").distinct()
    both = materialize(both, "graph-edges")
    labels = materialize(both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("label")).withColumnRenamed("src", "node"), "graph-labels")
    for _ in range(rounds):
        near = both.join(labels, both["dst"] == labels["node"]).groupBy("src").agg(F.min("label").alias("m"))
        step = labels.join(near, labels["node"] == near["src"]).select("node", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        jump = labels.select(F.col("node").alias("via"), F.col("label").alias("next"))
        new = materialize(step.join(jump, F.col("label") == F.col("via")).select("node", "old", F.least("label", "next").alias("label")), "graph-labels")
        changed = new.where("label <> old").limit(1).count()
        labels = new.select("node", "label")
        if not changed:
            return labels.withColumnRenamed("label", "component")
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def keep_large(edges: DataFrame, min_size: int) -> DataFrame:
    """Edges without loops, in components of at least ``min_size`` nodes."""
    c = components(edges)
    large = c.join(c.groupBy("component").agg(F.count("*").alias("n")).where(F.col("n") >= min_size), "component", "left_semi")
    return edges.where("src <> dst").join(large.select(F.col("node").alias("src")), "src", "left_semi").select(edges.columns)


def degrees(edges: DataFrame) -> DataFrame:
    """Degree, weighted degree, degree centrality and degree scaled to 0..1."""
    ends = edges.select(F.col("src").alias("node"), "weight").unionByName(edges.select(F.col("dst").alias("node"), "weight"))
    d = ends.groupBy("node").agg(F.count("*").alias("degree"), F.sum("weight").alias("strength"))
    s = d.agg(F.count("*").alias("n"), F.min("degree").alias("lo"), F.max("degree").alias("hi"))
    scaled = F.when(F.col("hi") > F.col("lo"), (F.col("degree") - F.col("lo")) / (F.col("hi") - F.col("lo"))).otherwise(F.lit(0.0))
    return d.crossJoin(F.broadcast(s)).select("node", "degree", "strength", (F.col("degree") / F.greatest(F.col("n") - 1, F.lit(1))).alias("centrality"), scaled.alias("hub_score"))


def inside_edges(modules: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(a, b, modules) and (module, m): numbers of an edge's ends and of the modules that hold both, loops and edges without one left out.

    Each node carries the numbers of its modules, so an edge stays one row and meets each end
    once; its modules are the intersection.
    """
    members = modules.select("module", "node").distinct()
    number = lambda c: running(members.select(c).distinct().withColumn("one", F.lit(1)), [], [c], {"k": "one"}).select(c, (F.col("k") - 1).alias(f"__{c}"))
    numbered = materialize(members.join(number("module"), "module"), "members")
    of = materialize(numbered.groupBy("node").agg(F.collect_set("__module").alias("ms")).join(number("node"), "node"), "nodes-modules")
    end = lambda side, k: of.select(F.col("node").alias(side), F.col("__node").alias(k), F.col("ms").alias(f"m{k}"))
    both = edges.where("src <> dst").select("src", "dst").join(end("src", "a"), "src").join(end("dst", "b"), "dst")
    return both.select("a", "b", F.array_intersect("ma", "mb").alias("modules")).where(F.size("modules") > 0), numbered.select("module", F.col("__module").alias("m")).distinct()


def _forest(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from the least to every other node of each component of the edges x-y."""
    names, place = np.unique(np.concatenate([x, y]), return_inverse=True)
    u, v = place[:len(x)], place[len(x):]
    label = np.arange(len(names))
    while len(u):
        low = np.minimum(label[u], label[v])
        np.minimum.at(label, label[u], low)
        np.minimum.at(label, label[v], low)
        while (up := label[label]).tobytes() != label.tobytes():
            label = up
        open_ = label[u] != label[v]
        u, v = u[open_], v[open_]
    child = np.flatnonzero(label != np.arange(len(names)))
    return names[label[child]], names[child]


def _reduce_edges(rows: DataFrame, limit: int = 4_000_000) -> DataFrame:
    """(m, a, b) edges of the same components in each module, fewer than the exploded rows (a, b, modules).

    A task gathers up to ``limit`` edges and replaces them by a forest; where that stays large it
    is handed on, so memory is bounded whatever a module's size.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def reduced() -> list[tuple[int, np.ndarray, np.ndarray]]:
            m, a, b = (np.concatenate(c) for c in zip(*held))
            order = np.argsort(m, kind="stable")
            cuts = np.flatnonzero(np.diff(m[order])) + 1
            return [(int(m[k[0]]), *_forest(a[k], b[k])) for k in np.split(order, cuts) if len(k)]

        def emit(parts: list) -> Iterator[pa.RecordBatch]:
            for m, a, b in parts:
                for at in range(0, len(a), 1_000_000):
                    x, y = a[at:at + 1_000_000], b[at:at + 1_000_000]
                    yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y), pa.array(np.full(len(x), m))], ["a", "b", "m"])

        for batch in batches:
            lists = batch.column(2)
            n = np.diff(np.asarray(lists.offsets))
            held.append((np.asarray(lists.flatten()), np.repeat(np.asarray(batch.column(0)), n), np.repeat(np.asarray(batch.column(1)), n)))
            size += len(held[-1][0])
            if size >= limit:
                parts = reduced()
                held = [(np.full(len(a), m), a, b) for m, a, b in parts]
                size = sum(len(a) for _, a, _ in parts)
                if size >= limit / 2:
                    yield from emit(parts)
                    held, size = [], 0
        if size:
            yield from emit(reduced())

    return rows.select("a", "b", "modules").mapInArrow(run, "a long, b long, m long")


def module_density(modules: DataFrame, edges: DataFrame) -> DataFrame:
    """(module, n, density): nodes of each module, and the share of their pairs that are edges."""
    inside, names = inside_edges(modules, edges)
    return _density(modules, inside, names)


def _density(modules: DataFrame, inside: DataFrame, names: DataFrame) -> DataFrame:
    n = modules.groupBy("module").agg(F.count("*").alias("n"))
    e = inside.select(F.explode("modules").alias("m")).groupBy("m").agg(F.count("*").alias("e")).join(names, "m").select("module", "e")
    density = F.when(F.col("n") > 1, 2 * F.coalesce("e", F.lit(0)) / (F.col("n") * (F.col("n") - 1))).otherwise(F.lit(0.0))
    return n.join(e, "module", "left").select("module", "n", density.alias("density"))


def module_coherence(modules: DataFrame, edges: DataFrame, scores: DataFrame) -> DataFrame:
    """0.4 density + 0.3 mean hub score + 0.3 largest component share, for each module of (module, node).

    Edges inside modules are replaced by forests, first where they are and then module by
    module, before components are sought.
    """
    inside, names = inside_edges(modules, edges)
    inside = materialize(inside, "inside")
    forest = materialize(_reduce_edges(inside), "forest")
    forest = materialize(_reduce_edges(forest.repartition("m").select("a", "b", F.array("m").alias("modules"))), "forest")
    at = lambda c: F.struct("m", F.col(c).alias("node")).alias(c)
    found = components(forest.select(at("a").alias("src"), at("b").alias("dst")))
    largest = found.groupBy(F.col("node.m").alias("m"), "component").agg(F.count("*").alias("s")).groupBy("m").agg(F.max("s").alias("largest")).join(names, "m").select("module", "largest")
    hub = modules.join(scores, "node", "left").groupBy("module").agg(F.avg(F.coalesce("hub_score", F.lit(0.0))).alias("hub"))
    j = _density(modules, inside, names).join(hub, "module").join(largest, "module", "left")
    share = F.coalesce("largest", F.lit(1)) / F.col("n")
    return j.select("module", "n", "density", share.alias("largest_share"), (0.4 * F.col("density") + 0.3 * F.col("hub") + 0.3 * share).alias("coherence"))


def label_propagation(edges: DataFrame, rounds: int = 5) -> DataFrame:
    """Label of most weight around each node, the smaller name on ties, for fixed rounds."""
    both = edges.select("src", "dst", "weight").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")).where("src <> dst")
    both = materialize(both, "graph-edges")
    labels = both.select(F.col("src").alias("node")).distinct().withColumn("label", F.col("node"))
    for _ in range(rounds):
        votes = both.join(labels, both["dst"] == labels["node"]).groupBy("src", "label").agg(F.sum("weight").alias("w"))
        best = votes.groupBy("src").agg(F.max("w").alias("w")).join(votes, ["src", "w"]).groupBy("src").agg(F.min("label").alias("label"))
        labels = materialize(best.withColumnRenamed("src", "node"), "graph-labels")
    return labels


def ranked_stages(stages: DataFrame) -> DataFrame:
    """Rank of each entity in its stage by score, ties by name."""
    return stages.withColumn("rank", F.row_number().over(Window.partitionBy("stage_index").orderBy(F.desc("score"), "entity")).cast("long"))


def progression(stages: DataFrame) -> DataFrame:
    """Label, slope, contrast and range of an entity over the stages it is in."""
    total = stages.agg(F.max("stage_index").alias("last"))
    w = Window.partitionBy("entity").orderBy("stage_index")
    d = stages.withColumn("d", F.col("score") - F.lag("score").over(w))
    g = d.groupBy("entity").agg(
        F.count("*").alias("n"), F.min("stage_index").alias("a"), F.max("stage_index").alias("b"), F.bool_and(F.col("d") > 0).alias("up"), F.bool_and(F.col("d") < 0).alias("down"),
        F.regr_slope("score", "stage_index").alias("slope"), (F.max_by("score", "stage_index") - F.min_by("score", "stage_index")).alias("contrast"), (F.max("score") - F.min("score")).alias("score_range"))
    g = g.crossJoin(F.broadcast(total))
    label = (F.when(F.col("n") == 1, "stage_specific").when((F.col("n") >= 3) & F.col("up"), "monotonic_up").when((F.col("n") >= 3) & F.col("down"), "monotonic_down")
             .when(F.col("b") < F.col("last"), "early_only").when(F.col("a") > 0, "late_only").otherwise("stable"))
    return g.select("entity", "n", label.alias("label"), "slope", "contrast", "score_range")


def edge_status(observed: DataFrame, known: DataFrame, limit: float) -> DataFrame:
    """known, below_threshold or missing for each observed edge against a reference network."""
    pair = lambda df: df.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"), *[c for c in df.columns if c not in ("src", "dst")])
    ref = pair(known).groupBy("src", "dst").agg(F.max("weight").alias("ref"))
    j = pair(observed).select("src", "dst").distinct().join(ref, ["src", "dst"], "left")
    return j.select("src", "dst", F.when(F.col("ref").isNull(), "missing").when(F.col("ref") >= limit, "known").otherwise("below_threshold").alias("status"))
