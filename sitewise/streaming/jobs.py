"""Structured Streaming forms of the incremental steps."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import centroid
from ..shared import new_path


def read_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 1) -> DataFrame:
    """Parquet files that arrive in a folder, a few per trigger."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def without_repeats(stream: DataFrame, time: str, delay: str, keys: list[str]) -> DataFrame:
    """Rows whose keys were not seen within the delay; the state is bounded by the watermark."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def windowed_durations(stream: DataFrame, time: str, delay: str, size: str, slide: str | None, by: str, value: str) -> DataFrame:
    """Count, mean and deviation per key and window; rows later than the delay are dropped."""
    w = F.window(time, size, slide) if slide else F.window(time, size)
    g = stream.withWatermark(time, delay).groupBy(w.alias("w"), by).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), by, "n", "mean", "sd")


def sessions(stream: DataFrame, time: str, delay: str, gap: str, by: str, value: str) -> DataFrame:
    """Count and largest value of each session of a key, and whether it breaks a limit."""
    g = stream.withWatermark(time, delay).groupBy(F.session_window(time, gap).alias("s"), by).agg(F.count("*").alias("n"), F.max(value).alias("largest"))
    return g.select(F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), by, "n", "largest")


def centroid_stream(stream: DataFrame, path: str, by: list[str] | None = None) -> Callable[[], StreamingQuery]:
    """A starter of the job that writes one partial centroid per batch; a repeated batch overwrites its own part.

    Partials instead of a running state: the state would hold every site. ``centroid_total``
    adds the parts up.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        centroid.build(batch, by or centroid.KEY).write.mode("overwrite").parquet(f"{path}/part={batch_id}")

    return lambda: stream.writeStream.foreachBatch(write).option("checkpointLocation", new_path(stream.sparkSession, "stream")).trigger(availableNow=True).start()


def centroid_total(spark: SparkSession, path: str, by: list[str] | None = None) -> DataFrame:
    return centroid.merge([(spark.read.parquet(path).drop("part"), 1)], by)


def run_to_table(stream: DataFrame, path: str) -> DataFrame:
    """Runs an appending stream over what is available and returns what it wrote."""
    spark = stream.sparkSession
    q = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", new_path(spark, "stream")).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)
