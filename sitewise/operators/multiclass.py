"""K-class scoring, fusion of one-vs-rest heads and panel read-outs."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import materialize
from .centroid import KEY, level_bin
from .derived import FrozenSchema
from .models import softmax, weighted_mean

#: Codes of a panel read-out, in this order.
READOUTS = ("healthy", "primary_disease", "alternative_panel_disease", "indeterminate")


def class_panel(counts: DataFrame, label: str, classes: list, weight: Column | list[Column] | None = None, bins: int = 20, smoothing: float = 0.5) -> DataFrame:
    """(site, w, p): smoothed bin shares of each class, in the order of ``classes``, at every site that a class has.

    A class without samples at a site has even shares there. ``weight`` is one for all classes
    or a list with one for each, which makes ``w`` an array.
    """
    rows = counts.select(*KEY, F.col(label).alias("__k"), level_bin(bins).alias("__b")).where(F.col(label).isin(classes))
    of = lambda k: F.array(*[F.count_if((F.col("__k") == k) & (F.col("__b") == b)) for b in range(bins)])
    g = rows.groupBy(*KEY).agg(*[of(k).alias(f"h{i}") for i, k in enumerate(classes)])
    total = lambda h: F.aggregate(h, F.lit(0).cast("long"), lambda s, x: s + x)
    g = g.withColumns({f"t{i}": total(f"h{i}") for i in range(len(classes))})
    share = lambda i: F.transform(f"h{i}", lambda x: F.when(F.col(f"t{i}") > 0, (x + smoothing) / (F.col(f"t{i}") + smoothing * bins)).otherwise(F.lit(1.0 / bins)))
    w = F.lit(1.0) if weight is None else F.array(*[x.cast("double") for x in weight]) if isinstance(weight, list) else weight
    return g.select(*KEY, w.alias("w"), F.array(*[share(i) for i in range(len(classes))]).alias("p"))


def class_scores(counts: DataFrame, panel: DataFrame, n_classes: int, contrast: bool = False, floor: float = -20.0, bins: int = 20, by: tuple[str, ...] = ("sample_id",)) -> DataFrame:
    """(by, n_loci, scores): weighted mean log bin share of each class, one partial and one final aggregate.

    With ``contrast`` a class's score is that of the difference to class 0, and class 0 has
    minus the largest of the others. Where ``w`` is an array a class has its own weights; where
    a class's weights are all 0 its score is 0.
    """
    j = counts.select(*by, *[c for c in KEY if c not in by], (level_bin(bins) + 1).alias("__b")).join(panel, KEY)
    own = panel.schema["w"].dataType.typeName() == "array"
    w = lambda k: F.element_at("w", k + 1) if own else F.col("w")
    log = lambda k: F.greatest(F.log(F.greatest(F.element_at(F.element_at("p", k + 1), F.col("__b")), F.lit(1e-300))), F.lit(floor))
    used = range(int(contrast), n_classes)
    g = j.groupBy(*by).agg(F.count("*").alias("n_loci"), *[F.sum(w(k)).alias(f"__w{k}") for k in (used if own else used[:1])], *[F.sum(w(k) * (log(k) - log(0) if contrast else log(k))).alias(f"__s{k}") for k in used])
    total = lambda k: F.col(f"__w{k if own else used[0]}")
    mean = [F.when(total(k) > 0, F.col(f"__s{k}") / total(k)).otherwise(F.lit(0.0)) for k in used]
    if contrast:
        mean = [-F.array_max(F.array(*mean)), *mean]
    return g.select(*by, "n_loci", F.array(*mean).alias("scores"))


def fuse_heads(heads: DataFrame, n_classes: int, pairwise: bool = False, eps: float = 1e-12) -> DataFrame:
    """(id, logits, p) from one-vs-rest probabilities (id, head, p); a null p is no evidence.

    With ``pairwise`` head 0 gives no evidence of its own: its logit is minus the largest of
    the others. A head without evidence gets probability 0, an id without any an even share.
    """
    # ``greatest`` skips nulls, so a null p is kept apart.
    logit = F.when(F.col("p").isNotNull(), F.log(F.greatest(F.col("p"), F.lit(eps))) - F.log(F.greatest(1 - F.col("p"), F.lit(eps))))
    g = heads.select("id", "head", logit.alias("l")).groupBy("id").agg(*[F.max(F.when(F.col("head") == k, F.col("l"))).alias(f"l{k}") for k in range(n_classes)])
    rest = F.array(*[F.col(f"l{k}") for k in range(1, n_classes)])
    logits = F.array(-F.array_max(rest) if pairwise else F.col("l0"), *[F.col(f"l{k}") for k in range(1, n_classes)])
    g = g.select("id", logits.alias("logits"))
    low = F.transform("logits", lambda x: F.coalesce(x, F.lit(-1e300)))
    even = F.array(*[F.lit(1.0 / n_classes)] * n_classes)
    return g.select("id", "logits", F.when(F.forall("logits", lambda x: x.isNull()), even).otherwise(softmax(low)).alias("p"))


def feature_heads(long: DataFrame, labels: DataFrame, schema: FrozenSchema, classes: list, bins: int = 100) -> DataFrame:
    """(feature, head, h1, h0): bin counts of each class and of the rest, of training features scaled to 0..1 by the schema's ranges.

    ``long`` holds (sample_id, feature, value), ``labels`` (sample_id, label). Only features of
    the schema count; one aggregate of conditional counts.
    """
    rows = _scaled(long, schema, bins).join(labels.where(F.col("label").isin(classes)).select("sample_id", "label"), "sample_id")
    of = lambda c: F.array(*[F.count_if(c & (F.col("b") == b)) for b in range(bins)])
    every = F.explode(F.array(*[F.lit(k) for k in range(len(classes))]))
    cases = F.element_at(F.array(*[F.lit(c) for c in classes]), F.col("head") + 1)
    g = rows.withColumn("head", every).withColumn("own", F.col("label") == cases)
    return g.groupBy("feature", "head").agg(of(F.col("own")).alias("h1"), of(~F.col("own")).alias("h0"))


def _scaled(long: DataFrame, schema: FrozenSchema, bins: int) -> DataFrame:
    """(sample_id, feature, b): bin of every sample's value of every feature of the schema, medians for what is absent."""
    cells = schema.apply(long).select("sample_id", F.posexplode("features").alias("place", "v"))
    span = F.col("high") - F.col("low")
    scaled = F.when(span > 1e-12, (F.col("v") - F.col("low")) / span).otherwise(F.lit(0.5))
    unit = F.least(F.greatest(scaled, F.lit(1e-7)), F.lit(1 - 1e-7))
    return cells.join(schema.table, "place").select("sample_id", "feature", F.least(F.floor(unit * bins), F.lit(bins - 1)).cast("int").alias("b"))


def score_feature_heads(long: DataFrame, schema: FrozenSchema, heads: DataFrame, n_classes: int, weights: DataFrame | None = None, temperature: float = 2.0, floor: float = -20.0, bins: int = 100) -> DataFrame:
    """(sample_id, logits, p): one-vs-rest evidence of every class from its features' histograms, and the softmax of all.

    A head's evidence is the weighted mean log ratio of the class's bin density to that of the
    rest, log densities floored, times the least of 10 and temperature * root of the effective
    number of features, plus the log odds of its training samples; it is cut at 40 either way.
    ``weights`` holds (feature, weight), 1 where absent.
    """
    j = _scaled(long, schema, bins).join(heads, "feature")
    if weights is not None:
        j = j.join(weights.select("feature", F.abs(F.col("weight")).alias("w")), "feature", "left").withColumn("w", F.coalesce("w", F.lit(0.0)))
    else:
        j = j.withColumn("w", F.lit(1.0))
    size = lambda h: F.aggregate(h, F.lit(0.0), lambda s, x: s + x)
    log = lambda h: F.greatest(F.log(F.greatest(F.element_at(h, F.col("b") + 1) / F.greatest(size(h), F.lit(1e-20)) * bins, F.lit(1e-300))), F.lit(floor))
    g = j.groupBy("sample_id", "head").agg(
        (F.sum(F.col("w") * (log("h1") - log("h0"))) / F.sum("w")).alias("llr"), (F.pow(F.sum("w"), F.lit(2)) / F.sum(F.col("w") * F.col("w"))).alias("n_eff"),
        F.max(F.log(F.greatest(size("h1"), F.lit(1.0)) / F.greatest(size("h0"), F.lit(1.0)))).alias("odds"))
    logit = F.coalesce(F.col("llr") * F.least(temperature * F.sqrt("n_eff"), F.lit(10.0)), F.lit(0.0)) + F.col("odds")
    cut = F.least(F.greatest(logit, F.lit(-40.0)), F.lit(40.0))
    wide = g.groupBy("sample_id").agg(*[F.max(F.when(F.col("head") == k, cut)).alias(f"l{k}") for k in range(n_classes)])
    out = wide.select("sample_id", F.array(*[F.coalesce(f"l{k}", F.lit(0.0)) for k in range(n_classes)]).alias("logits"))
    return out.withColumn("p", softmax(F.col("logits")))


def learned_head(scores: DataFrame, labels: DataFrame, ridge: float = 0.01) -> tuple[PipelineModel, DataFrame]:
    """A multinomial logistic model on standardised class scores, and (sample_id, p) of all samples of ``scores``.

    Labels are class numbers; samples without one are only scored. Scores and labels, a row a
    sample, are written once, as the fits read them several times.
    """
    scores, labels = materialize(scores.select("sample_id", "scores"), "scores"), materialize(labels, "labels")
    rows = scores.select("sample_id", array_to_vector("scores").alias("raw"))
    train = rows.join(labels.where("label is not null").select("sample_id", F.col("label").cast("double").alias("label")), "sample_id")
    model = Pipeline(stages=[StandardScaler(inputCol="raw", outputCol="features", withMean=True), LogisticRegression(family="multinomial", regParam=ridge)]).fit(train)
    return model, model.transform(rows).select("sample_id", vector_to_array("probability").alias("p"))


def panel_readout(fused: DataFrame, families: dict[str, list[int]], primary: str, delta: float) -> DataFrame:
    """(id, label, family logits): healthy where class 0 leads, else by the leading head's family.

    Indeterminate where no head has evidence or the lead over the second head is below
    ``delta``. Ties go to the smaller class; logits tie, and a lead reaches ``delta``, within 1e-9,
    so the last bits of averages do not decide.
    """
    order = F.array_sort(F.transform("logits", lambda x, i: F.struct((-F.round(F.coalesce(x, F.lit(-1e300)), 9)).alias("m"), i.alias("k"))))
    best, second = F.element_at(order, 1), F.element_at(order, 2)
    family_max = {n: F.array_max(F.array(*[F.element_at("logits", k + 1) for k in ks])) for n, ks in families.items()}
    label = F.when(F.forall("logits", lambda x: x.isNull()), READOUTS[3]).when(best["k"] == 0, READOUTS[0]).when(second["m"] - best["m"] < delta - 1e-9, READOUTS[3])
    label = label.when(best["k"].isin(families[primary]), READOUTS[1]).otherwise(READOUTS[2])
    return fused.select("id", label.alias("label"), *[v.alias(f"{n}_logit") for n, v in family_max.items()])


def probability_summary(fused: DataFrame) -> DataFrame:
    """Mean probability of each class over the ids that lead with each class; the smaller class leads where two differ by less than 1e-9."""
    lead = F.array_position(F.col("r"), F.array_max("r")) - 1
    return fused.withColumn("r", F.transform("p", lambda x: F.round(x, 9))).select(lead.alias("lead"), F.posexplode("p").alias("class", "v")).groupBy("lead", "class").agg(F.count("*").alias("n"), F.avg("v").alias("mean_p"))


def chromosome_expert(scores: DataFrame, weights: DataFrame) -> DataFrame:
    """One probability per sample from the two-class scores of its chromosomes and their weights."""
    p = scores.select("sample_id", "chrom", (1 / (1 + F.exp(F.element_at("scores", 1) - F.element_at("scores", 2)))).alias("p"))
    return weighted_mean(p.join(weights, "chrom"), ["sample_id"], "p", "weight")


def fit_chromosome_weights(scores: DataFrame, labels: DataFrame, chroms: list[str], ridge: float = 0.01, mix: float = 0.5) -> DataFrame:
    """(chrom, weight): elastic-net coefficients of the chromosomes' probabilities, negative ones at 0, scaled to sum 1; even if all are 0.

    What the fit reads, a row a sample, is written once.
    """
    p = scores.select("sample_id", "chrom", (1 / (1 + F.exp(F.element_at("scores", 1) - F.element_at("scores", 2)))).alias("p"))
    wide = p.groupBy("sample_id").pivot("chrom", chroms).agg(F.first("p")).na.fill(0.5).join(labels, "sample_id")
    wide = materialize(wide, "chromosome-scores")
    rows = VectorAssembler(inputCols=chroms, outputCol="features").transform(wide).select("features", F.col("label").cast("double").alias("label"))
    found = [max(float(c), 0.0) for c in LogisticRegression(regParam=ridge, elasticNetParam=mix).fit(rows).coefficients]
    total = sum(found)
    return scores.sparkSession.createDataFrame([(c, w / total if total else 1 / len(chroms)) for c, w in zip(chroms, found)], "chrom string, weight double")
