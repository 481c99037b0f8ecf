"""Inputs of fits, a row a sample or feature, are computed once; fits that read them again repeated all shuffles below."""

import pytest

from sitewise.operators import multiclass
from sitewise.plans import fits_queries, registry


def counted(spark, df):
    """The same rows, and a counter of how many were computed."""
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    return df.mapInPandas(run, df.schema), seen


def test_head_and_weights_read_scores_once(spark):
    rows = [(str(s), c, [-1.0 - (s * 7 + int(c)) % 5, -1.0 - (s * 3) % 4]) for s in range(30) for c in "123"]
    by_chrom, seen = counted(spark, spark.createDataFrame(rows, "sample_id string, chrom string, scores array<double>"))
    labels = spark.createDataFrame([(str(s), s % 2) for s in range(30)], "sample_id string, label int")
    w = multiclass.fit_chromosome_weights(by_chrom, labels, ["1", "2", "3"]).collect()
    assert seen.value == 90 and sum(r.weight for r in w) == pytest.approx(1)
    scores, seen = counted(spark, spark.createDataFrame([r[::2] for r in rows if r[1] == "1"], "sample_id string, scores array<double>"))
    _, p = multiclass.learned_head(scores, labels)
    assert len(p.collect()) == 30 and seen.value == 30


def test_schema_reads_features_once(spark, monkeypatch):
    rows, seen = counted(spark, spark.createDataFrame([(str(s), "1", float(s)) for s in range(10)], "sample_id string, chrom string, m double"))
    monkeypatch.setattr(fits_queries, "_chromosome_features", lambda t: rows)
    out = registry.queries()["derived_schema_apply"](spark, "/root/testdata/sf0.001").collect()
    assert len(out) == 10 and seen.value == 10
