"""Materialising intermediate tables where every executor can read them."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; set to a local one only where unset and Spark runs on this machine alone (tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "table", partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and return a reader of it.

    The written table cuts the lineage and survives the loss of any executor.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    schema = df.schema
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(schema).parquet(path)


@contextmanager
def arrow_rows(spark: SparkSession, n: int) -> Iterator[None]:
    """Rows of an Arrow batch for the jobs run inside, where single rows are large."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, before)
