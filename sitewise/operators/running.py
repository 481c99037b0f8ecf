"""Running totals and exact quantiles over orders too long for one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import materialize


def deal(rows: DataFrame, by: list[str], order: list[Column | str]) -> DataFrame:
    """The rows written in ranges of (by, order), with the range's number as ``__part``; equal places share a range."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(rows.repartitionByRange(parts, *by, *order).withColumn("__part", F.spark_partition_id()), "ranges")


def add_up(dealt: DataFrame, by: list[str], order: list[Column | str], sums: dict[str, Column | str]) -> DataFrame:
    """Adds the sum of each column over the group's rows up to and with this one, in the dealt order.

    Totals of the ranges are added up in a small window, and rows inside a range by a window
    for each range, so no task holds more than a range.
    """
    cols = {n: F.col(c) if isinstance(c, str) else c for n, c in sums.items()}
    totals = dealt.groupBy(*by, "__part").agg(*[F.sum(c).alias(f"__t_{n}") for n, c in cols.items()])
    before = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*[F.col(c).alias(f"__g_{c}") for c in by], F.col("__part").alias("__g"), *[F.coalesce(F.sum(f"__t_{n}").over(before), F.lit(0)).alias(f"__o_{n}") for n in cols])
    inside = Window.partitionBy(*by, "__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = dealt.withColumns({f"__l_{n}": F.sum(c).over(inside) for n, c in cols.items()})
    match = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"__g_{c}")) for c in by], F.col("__part") == F.col("__g"))
    joined = local.join(offsets, match).withColumns({n: F.col(f"__l_{n}") + F.col(f"__o_{n}") for n in cols})
    return joined.select(*dealt.columns, *cols)


def running(rows: DataFrame, by: list[str], order: list[Column | str], sums: dict[str, Column | str]) -> DataFrame:
    """Adds running totals of each group; the order should hold no equal places."""
    return add_up(deal(rows, by, order), by, order, sums).drop("__part")


def quantiles(rows: DataFrame, value: str, at: dict[str, float], by: list[str] | None = None) -> DataFrame:
    """(by, names): exact interpolated quantiles of a column from counts of its distinct values; no values give nulls."""
    by = by or []
    counts = rows.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("double").alias("__v")).agg(F.count("*").alias("__n"))
    placed = running(counts, by, ["__v"], {"__c": "__n"})
    size = placed.groupBy(*by).agg(F.max("__c").alias("__all"))
    placed = placed.join(size, by) if by else placed.crossJoin(F.broadcast(size))  # one row
    value_at = lambda k: F.max(F.when((F.col("__c") - F.col("__n") <= k) & (k < F.col("__c")), F.col("__v")))
    place = {n: p * (F.col("__all") - 1) for n, p in at.items()}
    ends = placed.groupBy(*by).agg(F.max("__all").alias("__all"), *[x for n, k in place.items() for x in (value_at(F.floor(k)).alias(f"__lo_{n}"), value_at(F.ceil(k)).alias(f"__hi_{n}"))])
    return ends.select(*by, *[(F.col(f"__lo_{n}") + (k - F.floor(k)) * (F.col(f"__hi_{n}") - F.col(f"__lo_{n}"))).alias(n) for n, k in place.items()])
