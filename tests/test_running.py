"""Running totals, quantiles and q-values against numpy, at a size where a quadratic frame would not end."""

import time

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from sitewise.operators import fdr, intervals
from sitewise.operators.running import quantiles, running


def test_running_totals_match_pandas(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b", None], 4000), "at": rng.permutation(4000), "v": rng.integers(0, 9, 4000)})
    got = running(spark.createDataFrame(pdf), ["g"], [F.desc("at")], {"upto": "v"}).toPandas()
    want = pdf.sort_values("at", ascending=False)
    want["upto"] = want.groupby("g", dropna=False)["v"].cumsum()
    assert got.sort_values("at")["upto"].tolist() == want.sort_values("at")["upto"].tolist()


def test_quantiles_match_numpy_and_take_nulls(spark):
    rng = np.random.default_rng(4)
    v = rng.integers(0, 50, 999) / 7
    df = spark.createDataFrame([(float(x),) for x in v] + [(None,)], "v double")
    got = quantiles(df, "v", {"a": 0.1, "b": 0.5, "c": 0.975}).first()
    np.testing.assert_allclose([got.a, got.b, got.c], np.quantile(v, [0.1, 0.5, 0.975]))
    assert quantiles(df.where("v is null"), "v", {"a": 0.5}).first().a is None


def test_benjamini_hochberg_on_a_million_distinct_values(spark):
    n = 1_000_000
    df = spark.range(n).select(((F.col("id") + 1) / n).alias("p"))
    start = time.time()
    got = fdr.benjamini_hochberg(df, "p", []).agg(F.min("q_value"), F.max("q_value")).first()
    assert time.time() - start < 60
    assert abs(got[0] - 1) < 1e-9 and abs(got[1] - 1) < 1e-9  # p * n / rank is 1 everywhere


def test_nearest_in_one_crowded_cell(spark):
    at = spark.range(30_000).select(F.lit("1").alias("chrom"), F.col("id").alias("pos"))
    gene = spark.range(0, 30_000, 100).select(F.lit("1").alias("chrom"), F.col("id").alias("region_start"), (F.col("id") + 1).alias("region_end"), F.col("id").cast("string").alias("gene_id"))
    start = time.time()
    got = intervals.nearest(at, gene).agg(F.max(F.abs("distance")), F.count("*")).first()
    assert time.time() - start < 60 and got[0] == 99 and got[1] == 30_000
