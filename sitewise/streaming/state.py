"""Streams that keep state of their own: recurrence of loci over arriving runs, and an early stop."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import new_path


def recurrence_stream(stream: DataFrame, key: list[str], run: str = "run_id", effect: str = "effect_size") -> DataFrame:
    """(key, n_runs, sum_effect, n_positive) of each key that gets a new run from a batch, after that batch.

    A run counts once for a key, with the first effect that arrives, whichever batch brings it
    again: pairs of key and run seen before are dropped, and sums by key are kept. Both states
    are Spark's own, grow with keys and runs, not with rows, and are kept in the query's checkpoint.
    """
    e = F.col("e")
    rows = stream.select(*key, F.col(run).cast("long").alias("r"), F.coalesce(F.col(effect).cast("double"), F.lit(0.0)).alias("e")).where("r is not null")
    return rows.dropDuplicates([*key, "r"]).groupBy(*key).agg(F.count("*").alias("n_runs"), F.sum(e).alias("sum_effect"), F.count_if(e > 0).alias("n_positive"))


def run_updates(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Runs an updating stream over what is available; each batch's rows are written as ``part=number``, again if it is repeated."""
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/part={number}")

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("update").trigger(availableNow=True).start().awaitTermination()


def latest(spark: SparkSession, path: str, key: list[str]) -> DataFrame:
    """Each key's row of the last batch that touched it."""
    rows = spark.read.option("basePath", path).parquet(path)
    values = [c for c in rows.columns if c not in key and c != "part"]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*values), "part").alias("v")).select(*key, *[F.col(f"v.{c}").alias(c) for c in values])


class EarlyStop:
    """A stream of runs, one per trigger, that ends once the stable panel has settled.

    After run k the panel holds the loci in at least ``min_frequency`` of the k runs. It agrees
    if its Jaccard with the panel ``window`` runs before is ``jaccard`` or more and its size
    changed by ``max_delta`` of that one's or less; ``patience`` runs in a row that agree end the
    query. The first look is at run ``min_runs``. Counts by locus and the log are written for
    every batch, so a restarted query goes on where it stopped, and a repeated batch writes the
    same again. A batch that holds several runs counts as one.
    """

    def __init__(self, path: str, key: list[str], min_frequency: float = 0.7, min_runs: int = 20, window: int = 5, jaccard: float = 0.98, max_delta: float = 0.02, patience: int = 3):
        self.path, self.key, self.min_frequency, self.min_runs, self.window = path, key, min_frequency, min_runs, window
        self.jaccard, self.max_delta, self.patience = jaccard, max_delta, patience
        self.stopped = False

    def _counts(self, spark: SparkSession, k: int) -> DataFrame:
        return spark.read.parquet(f"{self.path}/counts/k={k}")

    def _panel(self, spark: SparkSession, k: int) -> DataFrame:
        return self._counts(spark, k).where(F.col("n") >= self.min_frequency * k).select(*self.key)

    def log(self, spark: SparkSession) -> DataFrame:
        """(k, size, jaccard, delta, agreed, streak, stop) of every run counted."""
        return spark.read.schema("k int, size long, jaccard double, delta double, agreed boolean, streak int, stop boolean").parquet(f"{self.path}/log/*")

    def _batch(self, batch: DataFrame, number: int) -> None:
        spark, k = batch.sparkSession, number + 1
        last = self.log(spark).where(F.col("k") == k - 1).first() if k > 1 else None
        if self.stopped or (last is not None and last["stop"]) or (k > 1 and last is None):
            self.stopped = True  # what arrives after the end is not counted
            return
        seen = batch.select(*self.key).distinct().withColumn("n", F.lit(1).cast("long"))
        if k > 1:
            seen = seen.unionByName(self._counts(spark, k - 1)).groupBy(*self.key).agg(F.sum("n").alias("n"))
        seen.write.mode("overwrite").parquet(f"{self.path}/counts/k={k}")
        now = self._panel(spark, k)
        size, jaccard, delta, agreed = now.count(), None, None, False
        if k >= self.min_runs and k > self.window:
            before = self._panel(spark, k - self.window)
            old, shared = before.count(), now.join(before, self.key, "left_semi").count()
            union = size + old - shared
            jaccard, delta = (shared / union if union else 1.0), abs(size - old) / max(1, old)
            agreed = jaccard >= self.jaccard and delta <= self.max_delta
        streak = (last["streak"] if last is not None else 0) + 1 if agreed else 0
        stop = streak >= self.patience
        row = [(k, size, jaccard, delta, agreed, streak, stop)]
        spark.createDataFrame(row, "k int, size long, jaccard double, delta double, agreed boolean, streak int, stop boolean").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/log/k={k}")
        self.stopped = stop

    def run(self, stream: DataFrame, checkpoint: str | None = None, wait: float = 0.2) -> int | None:
        """Runs over what is available and returns the run at which it ended, or None if it did not."""
        spark = stream.sparkSession
        q = stream.writeStream.foreachBatch(self._batch).option("checkpointLocation", checkpoint or new_path(spark, "early-stop")).trigger(availableNow=True).start()
        while q.isActive:
            if self.stopped:
                q.stop()
                break
            time.sleep(wait)
        q.awaitTermination()
        if q.lastProgress is None and not self.stopped:
            return None  # nothing arrived
        return self.log(spark).where("stop").agg(F.min("k")).first()[0]
