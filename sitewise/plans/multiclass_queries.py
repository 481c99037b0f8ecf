"""Queries of K-class scores, fusion and read-outs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import multiclass as K
from ..operators.derived import FrozenSchema
from .registry import register

_B = "CASE WHEN mC + uC > 0 THEN least((mC * 20) // (mC + uC), 19) ELSE 0 END"


def _panel(k: int, weight: str) -> str:
    h = ", ".join("[{}] AS h{}".format(", ".join(f"count(*) FILTER (k = {i} AND b = {b})" for b in range(20)), i) for i in range(k))
    p = ", ".join(f"[(x + 0.5e0) / (list_sum(h{i}) + 10) for x in h{i}] AS p{i}" for i in range(k))
    return (f"s AS (SELECT *, CAST(sample_id AS BIGINT) % {k} AS k, {_B} AS b FROM site_counts), h AS (SELECT chrom, context, pos, {h} FROM s GROUP BY 1, 2, 3), "
            f"p AS (SELECT chrom, context, pos, {weight} AS w, {p} FROM h)")


_LOG = lambda i: f"greatest(ln(greatest(p{i}[b + 1], 1e-300)), -20)"
_W = "1 + (pos % 7) * 0.1e0"


def _three(t):
    c = t.site_counts.withColumn("k", F.col("sample_id").cast("long") % 3)
    return c, K.class_panel(c, "k", [0, 1, 2], 1 + (F.col("pos") % 7) * 0.1)


def _out(df):
    return df.select("sample_id", "n_loci", *[F.element_at("scores", i + 1).alias(f"s{i}") for i in range(3)])


@register("multiclass_scores", f"WITH {_panel(3, _W)} SELECT sample_id, count(*) AS n_loci, " + ", ".join(f"sum(w * {_LOG(i)}) / sum(w) AS s{i}" for i in range(3)) + " FROM s JOIN p USING (chrom, context, pos) GROUP BY 1", "s0 s1 s2")
def _(t):
    c, panel = _three(t)
    return _out(K.class_scores(c, panel, 3))


_OWN = lambda i: f"(1 + ((pos + {i}) % 7) * 0.1e0)"


@register("multiclass_class_weights", f"WITH {_panel(3, '1')} SELECT sample_id, count(*) AS n_loci, " + ", ".join(f"sum({_OWN(i)} * {_LOG(i)}) / sum({_OWN(i)}) AS s{i}" for i in range(3)) + " FROM s JOIN p USING (chrom, context, pos) GROUP BY 1", "s0 s1 s2")
def _(t):
    c = t.site_counts.withColumn("k", F.col("sample_id").cast("long") % 3)
    return _out(K.class_scores(c, K.class_panel(c, "k", [0, 1, 2], [1 + ((F.col("pos") + i) % 7) * 0.1 for i in range(3)]), 3))


@register("multiclass_contrast", f"WITH {_panel(3, _W)}, g AS (SELECT sample_id, count(*) AS n_loci, " + ", ".join(f"sum(w * ({_LOG(i)} - {_LOG(0)})) / sum(w) AS s{i}" for i in (1, 2)) + " FROM s JOIN p USING (chrom, context, pos) GROUP BY 1) SELECT sample_id, n_loci, -greatest(s1, s2) AS s0, s1, s2 FROM g", "s0 s1 s2")
def _(t):
    c, panel = _three(t)
    return _out(K.class_scores(c, panel, 3, contrast=True))


_HEADS = "hd AS (SELECT l_orderkey AS id, l_linenumber % 3 AS head, avg(0.01e0 + l_discount * 9) AS p FROM lineitem WHERE l_tax > 0.01 GROUP BY 1, 2), o AS (SELECT DISTINCT l_orderkey AS id FROM lineitem)"
_LOGIT = "lg AS (SELECT o.id, {zero} AS l0, l1, l2 FROM o LEFT JOIN (SELECT id, max(ln(greatest(p, 1e-12)) - ln(greatest(1 - p, 1e-12))) FILTER (head = 0) AS l0, max(ln(greatest(p, 1e-12)) - ln(greatest(1 - p, 1e-12))) FILTER (head = 1) AS l1, max(ln(greatest(p, 1e-12)) - ln(greatest(1 - p, 1e-12))) FILTER (head = 2) AS l2 FROM hd GROUP BY 1) x USING (id))"
_PAIR = "-CASE WHEN l1 IS NULL THEN l2 WHEN l2 IS NULL THEN l1 ELSE greatest(l1, l2) END"
_MAX = "greatest(coalesce(l0, -1e300), coalesce(l1, -1e300), coalesce(l2, -1e300))"
_E = lambda i: f"exp(coalesce(l{i}, -1e300) - {_MAX})"
_P = ", ".join(f"CASE WHEN l0 IS NULL AND l1 IS NULL AND l2 IS NULL THEN 1 / 3.0e0 ELSE {_E(i)} / ({_E(0)} + {_E(1)} + {_E(2)}) END AS p{i}" for i in range(3))


def _heads(t):
    p = t.lineitem.where("l_tax > 0.01").groupBy(F.col("l_orderkey").alias("id"), (F.col("l_linenumber") % 3).alias("head")).agg(F.avg(0.01 + F.col("l_discount") * 9).alias("p"))
    return t.lineitem.select(F.col("l_orderkey").alias("id")).distinct().join(p, "id", "left")


@register("multiclass_fusion", f"WITH {_HEADS}, {_LOGIT.format(zero='l0')} SELECT id, {_P} FROM lg", "p0 p1 p2")
def _(t):
    return K.fuse_heads(_heads(t), 3).select("id", *[F.element_at("p", i + 1).alias(f"p{i}") for i in range(3)])


@register("multiclass_fusion_pairwise", f"WITH {_HEADS}, {_LOGIT.format(zero=_PAIR)} SELECT id, {_P} FROM lg", "p0 p1 p2")
def _(t):
    return K.fuse_heads(_heads(t), 3, pairwise=True).select("id", *[F.element_at("p", i + 1).alias(f"p{i}") for i in range(3)])


@register("multiclass_probability_summary", f"WITH {_HEADS}, {_LOGIT.format(zero='l0')}, f AS (SELECT id, {_P} FROM lg), m AS (SELECT *, CASE WHEN round(p0, 9) >= round(p1, 9) AND round(p0, 9) >= round(p2, 9) THEN 0 WHEN round(p1, 9) >= round(p2, 9) THEN 1 ELSE 2 END AS lead FROM f), "
          "u AS (SELECT lead, 0 AS class, p0 AS v FROM m UNION ALL SELECT lead, 1, p1 FROM m UNION ALL SELECT lead, 2, p2 FROM m) SELECT CAST(lead AS BIGINT) AS lead, CAST(class AS BIGINT) AS class, count(*) AS n, avg(v) AS mean_p FROM u GROUP BY 1, 2", "mean_p")
def _(t):
    s = K.probability_summary(K.fuse_heads(_heads(t), 3))
    return s.select(F.col("lead").cast("long").alias("lead"), F.col("class").cast("long").alias("class"), "n", "mean_p")


@register("panel_readout", f"""WITH {_HEADS}, {_LOGIT.format(zero=_PAIR)}, x AS (SELECT *, coalesce(l0, -1e300) AS a, coalesce(l1, -1e300) AS b, coalesce(l2, -1e300) AS c FROM lg)
SELECT id, CASE WHEN l0 IS NULL AND l1 IS NULL AND l2 IS NULL THEN 'indeterminate' WHEN a >= b AND a >= c THEN 'healthy' WHEN greatest(b, c) - greatest(a, least(b, c)) < 0.5 THEN 'indeterminate' WHEN b >= c THEN 'primary_disease' ELSE 'alternative_panel_disease' END AS label,
l1 AS first_logit, l2 AS second_logit FROM x""", "first_logit second_logit")
def _(t):
    return K.panel_readout(K.fuse_heads(_heads(t), 3, pairwise=True), {"first": [1], "second": [2]}, "first", 0.5)


_CHROM = "cw AS (SELECT * FROM (VALUES ('1', 0.5e0), ('2', 0.3e0), ('3', 0.2e0)) v(chrom, weight))"


def _by_chrom(t):
    c = t.site_counts.withColumn("k", F.col("sample_id").cast("long") % 2)
    return K.class_scores(c, K.class_panel(c, "k", [0, 1], 1 + (F.col("pos") % 7) * 0.1), 2, by=("sample_id", "chrom"))


@register("multiclass_chromosome_expert", f"WITH {_panel(2, _W)}, {_CHROM}, g AS (SELECT sample_id, chrom, 1 / (1 + exp(sum(w * {_LOG(0)}) / sum(w) - sum(w * {_LOG(1)}) / sum(w))) AS p FROM s JOIN p USING (chrom, context, pos) GROUP BY 1, 2) SELECT sample_id, sum(p * weight) / sum(weight) AS p FROM g JOIN cw USING (chrom) GROUP BY 1", "p")
def _(t):
    weights = t.spark.createDataFrame([("1", 0.5), ("2", 0.3), ("3", 0.2)], "chrom string, weight double")
    return K.chromosome_expert(_by_chrom(t), weights)


@register("multiclass_chromosome_weights")
def _(t):
    labels = t.site_counts.select("sample_id", (F.col("sample_id").cast("long") % 2).alias("label")).distinct()
    return K.fit_chromosome_weights(_by_chrom(t), labels, ["1", "2", "3"])


_SCALED = """u AS (SELECT feature_id, quantile_cont(value, 0.5) AS fill, min(value) AS lo, max(value) AS hi FROM features GROUP BY 1), ids AS (SELECT DISTINCT sample_id FROM features),
sc AS (SELECT ids.sample_id, u.feature_id, least(greatest(CASE WHEN hi - lo > 1e-12 THEN (coalesce(value, fill) - lo) / (hi - lo) ELSE 0.5e0 END, 1e-7), 1 - 1e-7) AS v FROM ids CROSS JOIN u LEFT JOIN features USING (sample_id, feature_id)),
b AS (SELECT sample_id, feature_id, CAST(sample_id AS BIGINT) % 3 AS k, least(CAST(floor(v * 10) AS INT), 9) AS b FROM sc)"""


def _feature_heads(t):
    long = t.features.select("sample_id", F.col("feature_id").alias("feature"), F.col("value").cast("double").alias("value"))
    labels = long.select("sample_id", (F.col("sample_id").cast("long") % 3).alias("label")).distinct()
    schema = FrozenSchema.fit(long)
    return long, schema, K.feature_heads(long, labels, schema, [0, 1, 2], bins=10)


@register("multiclass_feature_heads", f"""WITH {_SCALED}, h AS (SELECT feature_id, b, hd AS head, count(*) FILTER (k = hd) AS c1, count(*) FILTER (k <> hd) AS c0 FROM b, (SELECT unnest([0, 1, 2]) AS hd) q GROUP BY 1, 2, 3),
n AS (SELECT feature_id, head, sum(c1) AS n1, sum(c0) AS n0 FROM h GROUP BY 1, 2), w AS (SELECT feature_id, 1.0e0 + length(feature_id) % 2 AS w FROM u),
g AS (SELECT sample_id, head, sum(w * (greatest(ln(greatest(c1 / CAST(n1 AS DOUBLE) * 10, 1e-300)), -20) - greatest(ln(greatest(c0 / CAST(n0 AS DOUBLE) * 10, 1e-300)), -20))) / sum(w) AS llr, pow(sum(w), 2) / sum(w * w) AS n_eff, max(ln(n1 / CAST(n0 AS DOUBLE))) AS odds
      FROM b JOIN h USING (feature_id, b) JOIN n USING (feature_id, head) JOIN w USING (feature_id) GROUP BY 1, 2),
l AS (SELECT sample_id, head, least(greatest(llr * least(2 * sqrt(n_eff), 10) + odds, -40), 40) AS l FROM g)
SELECT sample_id, {', '.join(f"max(l) FILTER (head = {k}) AS l{k}" for k in range(3))}, {', '.join(f"exp(max(l) FILTER (head = {k}) - max(l)) / (exp(max(l) FILTER (head = 0) - max(l)) + exp(max(l) FILTER (head = 1) - max(l)) + exp(max(l) FILTER (head = 2) - max(l))) AS p{k}" for k in range(3))} FROM l GROUP BY 1""", "l0 l1 l2 p0 p1 p2")
def _(t):
    long, schema, heads = _feature_heads(t)
    weights = schema.table.select("feature", (1.0 + F.length("feature") % 2).alias("weight"))
    out = K.score_feature_heads(long, schema, heads, 3, weights, bins=10)
    return out.select("sample_id", *[F.element_at(c, k + 1).alias(f"{c[0]}{k}") for c in ("logits", "p") for k in range(3)])


@register("multiclass_learned_head", None, "p0 p1 p2")
def _(t):
    c, panel = _three(t)
    scores = K.class_scores(c, panel, 3)
    labels = c.select("sample_id", F.col("k").alias("label")).distinct()
    _, p = K.learned_head(scores, labels)
    return p.select("sample_id", *[F.element_at("p", k + 1).alias(f"p{k}") for k in range(3)])
