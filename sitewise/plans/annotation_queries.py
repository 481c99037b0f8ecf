"""Queries of filters, lookups and selections."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import annotation as A
from ..operators import intervals as I
from ..operators.running import running
from .registry import register

_ROLL = "g AS (SELECT entity AS gene, sum(score) AS score, count(*) AS n FROM stages GROUP BY 1)"


def roll(t):
    return t.stages.groupBy(F.col("entity").alias("gene")).agg(F.sum("score").alias("score"), F.count("*").alias("n"))


@register("gene_filter", f"WITH {_ROLL} SELECT gene, n FROM g WHERE score >= 1000000 AND n >= 3 AND (score IS NULL OR score <= 1e12)")
def _(t):
    return A.filter_genes(roll(t), min_score=1_000_000, min_n=3, max_score=1e12).select("gene", "n")


@register("gene_any_hits", """WITH h AS (SELECT r.gene_id, count(*) FILTER (feature_type = 'promoter') AS p, count(*) FILTER (feature_type = 'exon') AS e FROM sites s JOIN regions r ON s.chrom = r.chrom AND s.pos >= r.region_start AND s.pos < r.region_end GROUP BY 1) SELECT * FROM h WHERE p > 0 OR e > 0""")
def _(t):
    h = I.overlap(t.sites, t.regions).groupBy("gene_id").agg(F.count_if(F.col("feature_type") == "promoter").alias("p"), F.count_if(F.col("feature_type") == "exon").alias("e"))
    return A.any_hits(h, ["p", "e"])


@register("evidence_rank", "SELECT p_partkey AS id, CASE p_partkey % 7 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 3 WHEN 4 THEN 4 WHEN 5 THEN 5 ELSE 0 END AS rank FROM part")
def _(t):
    names = F.array(*[F.lit(e.upper()) for e in A.EVIDENCE], F.lit("unknown"))
    return t.part.select(F.col("p_partkey").alias("id"), A.evidence_rank(F.element_at(names, (F.col("p_partkey") % 7 + 1).cast("int"))).cast("int").alias("rank"))


@register("term_theme", "SELECT library, term, gene, CASE WHEN regexp_matches(term, 'O') THEN 'o' WHEN regexp_matches(term, '#1') THEN 'ones' WHEN regexp_matches(term, 'S') THEN 's' ELSE 'other' END AS theme FROM gene_sets")
def _(t):
    patterns = t.spark.createDataFrame([(1, "O", "o"), (2, "#1", "ones"), (3, "S", "s")], "priority int, pattern string, theme string")
    return A.theme(t.gene_sets, "term", patterns).select("library", "term", "gene", "theme")


@register("tile_site_overlap", "SELECT DISTINCT run_id, chrom, CAST(pos // 8 * 8 AS BIGINT) AS tile_start FROM sites JOIN runs USING (chrom, pos)")
def _(t):
    tiles = t.sites.groupBy("chrom", (F.floor(F.col("pos") / 8) * 8).alias("tile_start")).agg(F.collect_list("pos").alias("positions"))
    return A.tiles_with_sites(tiles, t.runs, ("run_id",)).select("run_id", "chrom", "tile_start")


@register("annotate_coalesce", """WITH m AS (SELECT run_id, chrom, pos, max(effect_size) AS e FROM runs WHERE delta_mean >= 0 GROUP BY 1, 2, 3), s AS (SELECT run_id, chrom, pos, avg(effect_size) AS effect_size FROM runs GROUP BY 1, 2, 3)
SELECT run_id, chrom, pos, coalesce(m.e, effect_size) AS effect_size, m.e IS NOT NULL AS matched FROM s LEFT JOIN m USING (run_id, chrom, pos)""", "effect_size")
def _(t):
    site = ["run_id", "chrom", "pos"]
    m = t.runs.where("delta_mean >= 0").groupBy(*site).agg(F.max("effect_size").alias("effect_size"))
    s = t.runs.groupBy(*site).agg(F.avg("effect_size").alias("effect_size"))
    return A.annotate(s, m, site, ["effect_size"])


_EV = "ev AS (SELECT gene, term AS label, CAST(length(term) * 10 + length(gene) AS DOUBLE) AS score FROM gene_sets)"


def evidence(t):
    return t.gene_sets.select("gene", F.col("term").alias("label"), (F.length("term") * 10 + F.length("gene")).cast("double").alias("score"))


@register("trait_best_by_gene", f"WITH {_EV} SELECT gene, max(score) AS score, arg_min(label, (-score, label)) AS label, count(*) AS n_rows FROM ev WHERE lower(label) LIKE '%brand%' GROUP BY gene", "score")
def _(t):
    return A.best_by_gene(evidence(t), "label", "Brand")


@register("evidence_merge_sources", f"WITH {_EV}, a AS (SELECT gene, max(score) AS s FROM ev WHERE label LIKE 'Brand#1%' GROUP BY 1), b AS (SELECT gene, max(score) AS s FROM ev WHERE label LIKE '%O%' GROUP BY 1), k AS (SELECT DISTINCT gene FROM gene_sets) SELECT k.gene, coalesce(a.s, b.s) AS score, CASE WHEN a.s IS NOT NULL THEN 'first' WHEN b.s IS NOT NULL THEN 'second' ELSE 'none' END AS source FROM k LEFT JOIN a USING (gene) LEFT JOIN b USING (gene)", "score")
def _(t):
    e = evidence(t)
    best = lambda d: d.groupBy("gene").agg(F.max("score").alias("score"))
    return A.merge_sources(t.gene_sets.select("gene").distinct(), [("first", best(e.where("label like 'Brand#1%'"))), ("second", best(e.where("label like '%O%'")))])


_GR = "rg AS (SELECT run_id, r.gene_id, effect_size FROM runs s JOIN regions r ON s.chrom = r.chrom AND s.pos >= r.region_start AND s.pos < r.region_end AND r.feature_type = 'exon')"


@register("gene_recurrence", f"WITH {_GR}, p AS (SELECT run_id, gene_id, avg(effect_size) AS effect FROM rg GROUP BY 1, 2), n AS (SELECT count(DISTINCT run_id) AS n_runs FROM p) SELECT gene_id, count(*) AS n_present, avg(effect) AS effect, n_runs, count(*) / CAST(n_runs AS DOUBLE) AS frequency FROM p, n GROUP BY gene_id, n_runs", "effect frequency")
def _(t):
    return A.gene_recurrence(I.overlap(t.runs, t.regions.where("feature_type = 'exon'")).select("run_id", "gene_id", "effect_size"))


_FR = "fr AS (SELECT chrom, pos, avg(e) AS effect_size, count(*) / 7.0e0 AS frequency FROM (SELECT run_id, chrom, pos, avg(effect_size) AS e FROM runs GROUP BY 1, 2, 3) GROUP BY 1, 2)"


@register("panel_tiers", f"WITH {_FR} SELECT chrom, pos, frequency, effect_size * sqrt(frequency) AS stable_score, CASE WHEN frequency >= 0.8 THEN 'strict' ELSE 'relaxed' END AS tier FROM fr WHERE frequency >= 0.5", "frequency stable_score")
def _(t):
    per = t.runs.groupBy("run_id", "chrom", "pos").agg(F.avg("effect_size").alias("e"))
    fr = per.groupBy("chrom", "pos").agg(F.avg("e").alias("effect_size"), (F.count("*") / 7.0).alias("frequency"))
    return A.tiers(fr, 0.8, 0.5).select("chrom", "pos", "frequency", "stable_score", "tier")


@register("gene_plateau", """WITH r AS (SELECT row_number() OVER (ORDER BY chrom, pos) AS rank, chrom || '-' || CAST(pos // 40 AS VARCHAR) AS gene_id FROM sites), f AS (SELECT gene_id, min(rank) AS rank FROM r GROUP BY 1),
g AS (SELECT rank, lead(rank) OVER (ORDER BY rank) AS nx, row_number() OVER (ORDER BY rank) AS n_genes, (SELECT max(rank) FROM r) AS e FROM f) SELECT min(rank) AS k, min(n_genes) AS n_genes FROM g WHERE coalesce(nx, e + 1) - rank > 15""")
def _(t):
    r = running(t.sites, [], ["chrom", "pos"], {"rank": F.lit(1)}).select("rank", F.concat_ws("-", "chrom", F.floor(F.col("pos") / 40).cast("string")).alias("gene_id"))
    return A.gene_plateau(r, 15).select("k", F.col("n_genes").cast("long").alias("n_genes"))


@register("grid_objective", """WITH g AS (SELECT n_nationkey AS id, n_regionkey AS a, r_regionkey AS b, n_nationkey * 0.01e0 + r_regionkey * 0.1e0 AS auc, (n_nationkey % 7) * 0.1e0 AS ba FROM nation, region),
o AS (SELECT id * 10 + b AS id, 0.7e0 * auc + 0.3e0 * ba AS objective, auc >= 0.2 AND ba >= 0.1 AS passed FROM g) SELECT id, objective, passed, CASE WHEN passed THEN row_number() OVER (PARTITION BY passed ORDER BY objective DESC, id) END AS rank FROM o WHERE passed""", "objective")
def _(t):
    g = A.expand_grid([t.nation.select("n_nationkey"), t.region.select("r_regionkey")])
    m = g.select((F.col("n_nationkey") * 10 + F.col("r_regionkey")).alias("id"), (F.col("n_nationkey") * 0.01 + F.col("r_regionkey") * 0.1).alias("auc"), ((F.col("n_nationkey") % 7) * 0.1).alias("ba"))
    return A.objective(m, {"auc": 0.7, "ba": 0.3}, {"auc": 0.2, "ba": 0.1}).where("passed").select("id", "objective", "passed", F.col("rank").cast("long").alias("rank"))


_UP = "translate(c, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ')"


@register("methylation_call", f"""WITH l AS (SELECT doc_id AS id, CASE WHEN doc_id % 2 = 0 THEN 'CT' ELSE 'GA' END AS xg, string_split(text, '') AS x, list_transform(string_split(text, ''), lambda c: {_UP}) AS u FROM documents),
e AS (SELECT id, xg, x, u, unnest(generate_series(1, len(x) - 2)) AS i FROM l),
c AS (SELECT id, CASE WHEN x[i] IN ('Z', 'X', 'H') THEN 1 WHEN x[i] IN ('z', 'x', 'h') THEN 0 WHEN xg = 'CT' AND u[i + 1] = 'C' AND u[i + 2] IN ('C', 'T') THEN CASE WHEN u[i + 2] = 'C' THEN 1 ELSE 0 END
WHEN xg = 'GA' AND u[i + 1] = 'G' AND u[i + 2] IN ('G', 'A') THEN CASE WHEN u[i + 2] = 'G' THEN 1 ELSE 0 END END AS call FROM e)
SELECT doc_id AS id, count(call) FILTER (call = 1) AS n_methylated, count(call) FILTER (call = 0) AS n_unmethylated FROM documents LEFT JOIN c ON c.id = doc_id GROUP BY 1""")
def _(t):
    # Each character is an XM letter and the next two its reference and read bases: a call at every position of the whole text.
    xg = F.when(F.col("doc_id") % 2 == 0, "CT").otherwise("GA")
    c = t.documents.select(F.col("doc_id").alias("id"), xg.alias("xg"), F.split(F.coalesce("text", F.lit("")), "").alias("x"))
    c = c.withColumn("u", F.transform("x", lambda v: F.translate(v, "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")))
    at = F.filter(F.sequence(F.lit(1), F.greatest(F.size("x") - 2, F.lit(1))), lambda i: i <= F.size("x") - 2)
    calls = F.transform(at, lambda i: A.methylation_call(F.element_at("x", i), F.element_at("u", i + 1), F.element_at("u", i + 2), F.col("xg")))
    n = lambda v: F.size(F.filter("calls", lambda k: k == v)).cast("long")
    return c.select("id", calls.alias("calls")).groupBy("id").agg(F.sum(n(1)).alias("n_methylated"), F.sum(n(0)).alias("n_unmethylated"))
