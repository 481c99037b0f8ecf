"""Queries of evaluation, scoring and survival."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import centroid as C
from ..operators import scoring as S
from ..operators.running import quantiles
from .centroid_queries import BY, CENTROID
from .registry import register

_CELLS = "count(*) FILTER (y_true = 1 AND y_pred = 1) AS tp, count(*) FILTER (y_true = 0 AND y_pred = 1) AS fp, count(*) FILTER (y_true = 0 AND y_pred = 0) AS tn, count(*) FILTER (y_true = 1 AND y_pred = 0) AS fn"
_RATES = """tp / CAST(tp + fn AS DOUBLE) AS sensitivity, tn / CAST(tn + fp AS DOUBLE) AS specificity, CASE WHEN tp + fp > 0 THEN tp / CAST(tp + fp AS DOUBLE) ELSE 0 END AS ppv, CASE WHEN tn + fn > 0 THEN tn / CAST(tn + fn AS DOUBLE) ELSE 0 END AS npv,
(tp + tn) / CAST(tp + fp + tn + fn AS DOUBLE) AS accuracy, (tp / CAST(tp + fn AS DOUBLE) + tn / CAST(tn + fp AS DOUBLE)) / 2 AS balanced_accuracy, 2.0e0 * tp / (2 * tp + fp + fn) AS f1,
greatest((tp / CAST(tp + fn AS DOUBLE) + 1.96e0 * 1.96e0 / (2 * (tp + fn)) - 1.96e0 * sqrt(tp / CAST(tp + fn AS DOUBLE) * (1 - tp / CAST(tp + fn AS DOUBLE)) / (tp + fn) + 1.96e0 * 1.96e0 / (4.0e0 * (tp + fn) * (tp + fn)))) / (1 + 1.96e0 * 1.96e0 / (tp + fn)), 0) AS sensitivity_low,
least((tp / CAST(tp + fn AS DOUBLE) + 1.96e0 * 1.96e0 / (2 * (tp + fn)) + 1.96e0 * sqrt(tp / CAST(tp + fn AS DOUBLE) * (1 - tp / CAST(tp + fn AS DOUBLE)) / (tp + fn) + 1.96e0 * 1.96e0 / (4.0e0 * (tp + fn) * (tp + fn)))) / (1 + 1.96e0 * 1.96e0 / (tp + fn)), 1) AS sensitivity_high"""


@register("eval_confusion", f"WITH c AS (SELECT {_CELLS} FROM predictions) SELECT *, {_RATES} FROM c", "sensitivity specificity ppv npv accuracy balanced_accuracy f1 sensitivity_low sensitivity_high")
def _(t):
    return S.rates(S.confusion(t.predictions))


@register("eval_per_class", """WITH a AS (SELECT y_true AS class, count(*) AS support, count(*) FILTER (y_true = y_pred) AS hit FROM predictions GROUP BY 1), b AS (SELECT y_pred AS class, count(*) AS predicted FROM predictions GROUP BY 1)
SELECT class, support, coalesce(hit / CAST(predicted AS DOUBLE), 0) AS precision, hit / CAST(support AS DOUBLE) AS recall, coalesce(2.0e0 * hit / (support + predicted), 0) AS f1 FROM a LEFT JOIN b USING (class)""", "precision recall f1")
def _(t):
    return S.per_class(t.predictions)


@register("eval_calibration", """WITH b AS (SELECT least(floor(p1 * 15), 14) AS bin, count(*) AS n, sum(-CASE WHEN y_true = 1 THEN ln(greatest(p1, 1e-15)) ELSE ln(1 - least(p1, 1 - 1e-15)) END) AS nll, sum((p1 - y_true) ** 2) AS brier, abs(avg(p1) - avg(y_true)) AS gap FROM predictions GROUP BY 1)
SELECT sum(nll) / sum(n) AS nll, sum(brier) / sum(n) AS brier, sum(n * gap) / sum(n) AS ece FROM b""", "nll brier ece")
def _(t):
    return S.calibration(t.predictions)


@register("eval_auc", """WITH r AS (SELECT y_true, rank() OVER (ORDER BY p1) + (count(*) OVER (PARTITION BY p1) - 1) / 2.0e0 AS r FROM predictions), g AS (SELECT count(*) FILTER (y_true = 1) AS n1, count(*) FILTER (y_true = 0) AS n0, sum(r) FILTER (y_true = 1) AS s FROM r)
SELECT n1, n0, (s - n1 * (n1 + 1) / 2.0e0) / (n1 * n0) AS auc FROM g""", "auc")
def _(t):
    return S.rank_auc(t.predictions)


_SQUARE = "(({0} + {1}) * ({0} + {1}) % 2147483647)"
_MIXED = _SQUARE.format(_SQUARE.format("((i * 48271 + draw * 69621 + 13 * 16807) % 2147483647)", 11), 1009)


@register("eval_bootstrap", f"""WITH s AS (SELECT y_true, count(*) AS n, count(*) FILTER (y_true = y_pred) AS good FROM predictions GROUP BY 1),
a AS (SELECT draw, y_true, {_MIXED} % n < good AS hit FROM (SELECT y_true, n, good, unnest(generate_series(1, n)) AS i FROM s), generate_series(1, 1000) d(draw)),
c AS (SELECT draw, y_true, avg(CASE WHEN hit THEN 1.0e0 ELSE 0 END) AS r FROM a GROUP BY 1, 2), b AS (SELECT draw, avg(r) AS b FROM c GROUP BY 1)
SELECT count(*) AS draws, avg(b) AS mean, quantile_cont(b, 0.025) AS low, quantile_cont(b, 0.975) AS high FROM b""", "mean low high")
def _(t):
    return S.bootstrap(t.predictions, 1000)


@register("eval_decision", """WITH r AS (SELECT id, p1, CASE WHEN abs(2 * p1 - 1) < 0.1 THEN 'low_margin' WHEN greatest(p1, 1 - p1) < 0.6 THEN 'low_confidence' ELSE 'ok' END AS reason FROM predictions)
SELECT id, reason, CASE WHEN reason <> 'ok' THEN 'indeterminate' WHEN p1 >= 0.5 THEN 'disease' ELSE 'control' END AS decision FROM r""")
def _(t):
    return S.decide(t.predictions, "p1", 0.1, 0.6).select("id", "reason", "decision")


@register("eval_abstain", "SELECT id, CASE WHEN id % 20 >= 0.5 * 20 THEN CASE WHEN p1 >= 0.5 THEN 1 ELSE 0 END ELSE -1 END AS y_pred, CASE WHEN id % 20 >= 0.5 * 20 THEN p1 ELSE 0.5e0 END AS p1 FROM predictions", "p1")
def _(t):
    return S.abstain(t.predictions.withColumn("seen", F.col("id") % 20).withColumn("all", F.lit(20)), "seen", "all", 0.5).select("id", "y_pred", "p1")


@register("eval_pool_splits", f"WITH c AS (SELECT id % 5 AS s, {_CELLS} FROM predictions GROUP BY 1), r AS (SELECT *, (tp / CAST(tp + fn AS DOUBLE) + tn / CAST(tn + fp AS DOUBLE)) / 2 AS b FROM c) SELECT count(*) AS n_splits, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fp) AS BIGINT) AS fp, CAST(sum(tn) AS BIGINT) AS tn, CAST(sum(fn) AS BIGINT) AS fn, avg(b) AS mean_balanced_accuracy FROM r", "mean_balanced_accuracy")
def _(t):
    return S.pool_cells(S.confusion(t.predictions.withColumn("s", F.col("id") % 5), ["s"]), "s")


_H = CENTROID.replace("array_to_string([", "[").replace("], ',') AS bins", "] AS h")
_BIN = "CASE WHEN mC + uC > 0 THEN least((mC * 20) // (mC + uC), 19) ELSE 0 END"
_PANEL = f"WITH c AS ({_H}), p AS (SELECT x.chrom, x.context, x.pos, x.h AS h1, y.h AS h2, abs(x.Sx / x.N - y.Sx / y.N) + 0.01e0 AS w FROM c x JOIN c y USING (chrom, context, pos) WHERE x.cohort = 'control' AND y.cohort = 'disease')"
_D = "greatest(ln(greatest({h}[b + 1] / list_sum({h}) * 20, 1e-300)), -20)"


def panel(t):
    c = C.build(t.site_counts, BY)
    one = c.where("cohort = 'control'").select(*C.KEY, F.col("bin_counts").alias("h1"), C.mean().alias("m1"))
    two = c.where("cohort = 'disease'").select(*C.KEY, F.col("bin_counts").alias("h2"), C.mean().alias("m2"))
    return one.join(two, C.KEY).withColumn("w", F.abs(F.col("m1") - F.col("m2")) + 0.01)


@register("score_histogram", _PANEL + f""", j AS (SELECT sample_id, w, {_D.format(h='h2')} - {_D.format(h='h1')} AS d FROM (SELECT s.*, {_BIN} AS b FROM site_counts s) s JOIN p USING (chrom, context, pos)),
g AS (SELECT sample_id, count(*) AS n_loci, sum(w * d) / sum(w) AS mean_llr, sum(w) ** 2 / sum(w * w) AS ne FROM j GROUP BY 1) SELECT sample_id, n_loci, mean_llr, 1 / (1 + exp(-mean_llr * least(sqrt(ne), 10))) AS p1 FROM g""", "mean_llr p1")
def _(t):
    return S.histogram_scores(t.site_counts, panel(t))


@register("score_prefix_search", """WITH s AS (SELECT CAST(l_suppkey AS BIGINT) AS sample_id, CAST(1 + l_partkey % 25 AS BIGINT) AS rank, sum(CAST(round(l_discount * 100) AS BIGINT) - 4 - (l_suppkey % 2) * 0 ) AS score FROM lineitem GROUP BY 1, 2),
g AS (SELECT a.sample_id, r.rank, coalesce(s.score, 0) AS score FROM (SELECT DISTINCT sample_id FROM s) a CROSS JOIN (SELECT DISTINCT rank FROM s) r LEFT JOIN s ON s.sample_id = a.sample_id AND s.rank = r.rank),
k AS (SELECT sample_id % 2 AS y, rank, CASE WHEN sum(score) OVER (PARTITION BY sample_id ORDER BY rank) > 0 THEN 1 ELSE 0 END AS p FROM g)
SELECT rank AS k, (count(*) FILTER (y = 1 AND p = 1) / CAST(count(*) FILTER (y = 1) AS DOUBLE) + count(*) FILTER (y = 0 AND p = 0) / CAST(count(*) FILTER (y = 0) AS DOUBLE)) / 2 AS balanced_accuracy,
(count(*) FILTER (y = 1 AND p = 1) / CAST(count(*) FILTER (y = 1) AS DOUBLE) + count(*) FILTER (y = 0 AND p = 0) / CAST(count(*) FILTER (y = 0) AS DOUBLE)) / 2 >= 0.5 AS reached,
rank = (SELECT min(rank) FROM (SELECT rank, (count(*) FILTER (y = 1 AND p = 1) / CAST(count(*) FILTER (y = 1) AS DOUBLE) + count(*) FILTER (y = 0 AND p = 0) / CAST(count(*) FILTER (y = 0) AS DOUBLE)) / 2 AS b FROM k GROUP BY rank) WHERE b >= 0.5) AS chosen FROM k GROUP BY rank""", "balanced_accuracy")
def _(t):
    s = t.lineitem.groupBy(F.col("l_suppkey").alias("sample_id"), (1 + F.col("l_partkey") % 25).alias("rank")).agg(F.sum((F.round(F.col("l_discount") * 100) - 4)).alias("score"))
    return S.prefix_search(s.withColumn("y_true", F.col("sample_id") % 2), 0.5)


_KM = "g AS (SELECT time, count(*) AS n, sum(event) AS d FROM survival GROUP BY time), r AS (SELECT *, sum(n) OVER (ORDER BY time DESC) AS at_risk FROM g)"


@register("survival_kaplan_meier", f"WITH {_KM} SELECT time, CAST(at_risk AS BIGINT) AS at_risk, CAST(d AS BIGINT) AS d, exp(sum(CASE WHEN d < at_risk THEN ln(1 - d / CAST(at_risk AS DOUBLE)) ELSE -1e9 END) OVER (ORDER BY time)) AS survival FROM r WHERE d > 0", "survival")
def _(t):
    return S.kaplan_meier(t.survival)


@register("survival_log_rank", """WITH m AS (SELECT quantile_cont(risk, 0.5) AS med FROM survival), g AS (SELECT time, count(*) AS n, count(*) FILTER (risk > med) AS n1, sum(event) AS d, coalesce(sum(event) FILTER (risk > med), 0) AS d1 FROM survival, m GROUP BY time),
r AS (SELECT *, CAST(sum(n) OVER (ORDER BY time DESC) AS DOUBLE) AS r, CAST(sum(n1) OVER (ORDER BY time DESC) AS DOUBLE) AS r1 FROM g)
SELECT CAST(sum(d1) AS BIGINT) AS observed, sum(d * r1 / r) AS expected, (sum(d1) - sum(d * r1 / r)) ** 2 / sum(CASE WHEN r > 1 THEN d * r1 / r * (1 - r1 / r) * (r - d) / (r - 1) ELSE 0 END) AS chi2 FROM r WHERE d > 0""", "expected chi2")
def _(t):
    med = quantiles(t.survival, "risk", {"med": 0.5})
    return S.log_rank(t.survival.crossJoin(F.broadcast(med)), F.col("risk") > F.col("med"))
