"""Mixing sources to target weights by hash-threshold histograms, without a sort.

Every document gets a 60-bit hash. Sizes are summed by (source, hash bucket); the
bucket where a source's running sum crosses its budget is found, and only that bucket
is split again by the next bits. A document is then taken by comparing its hash with
its source's threshold: a filter, no global order and no sampling by partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import materialize

WORD = r"[^\x20\x09-\x0D]+"
HASH_BITS = 60
LEVEL_BITS = 12
#: Whole rounds of refinement; after two, a bucket holds 2**-24 of its source.
LEVELS = 2
#: Above this many sources the threshold table is joined by shuffle.
MAX_BROADCAST_SOURCES = 10_000


def word_count(text: Column) -> Column:
    """Words of the whole text as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_hash(seed: str, *cols: Column) -> Column:
    """60-bit hash of the columns, the same in any engine with MD5; nulls are left out."""
    digest = F.md5(F.concat_ws("|", F.lit(seed), *[c.cast("string") for c in cols]))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def source_targets(sized: DataFrame, max_repeat: int = 3) -> DataFrame:
    """(source, source_size, target) with targets by weights 1, 2, 3 in code-point order, null last.

    A target stops at ``max_repeat`` times its source's size; what is above is shared
    again by weight among the sources below their stop. Empty sources have target 0.
    Only single rows of totals reach the driver.
    """
    by_source = materialize(
        sized.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
        .select(
            "source", "source_size",
            ((F.col("rank") - 1) % 3 + 1).cast("double").alias("weight"),
            (F.col("source_size") * max_repeat).cast("double").alias("stop"),
        ),
        "mix-sources",
    )
    total, level = by_source.agg(F.sum("source_size"), F.sum("source_size") / F.sum("weight")).first()
    stopped = -1
    while total:
        at_stop = F.col("stop") <= F.col("weight") * level
        n, taken, weight = by_source.agg(
            F.count_if(at_stop), F.sum(F.when(at_stop, F.col("stop")).otherwise(0.0)),
            F.sum(F.when(at_stop, 0.0).otherwise(F.col("weight"))),
        ).first()
        if n == stopped or not weight:
            break
        stopped, level = n, (total - taken) / weight
    return by_source.select(
        "source", "source_size",
        F.least(F.col("stop"), F.col("weight") * F.lit(float(level or 0.0))).alias("target"),
    )


def _bucket(level: int) -> Column:
    shift = HASH_BITS - LEVEL_BITS * (level + 1)
    return F.shiftright(F.col("hash"), shift)


def thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, source_size, target, repeats, threshold): hashes below the threshold get one copy more.

    Each round sums sizes by (source, bucket), at most 2**12 rows a source, and keeps the
    bucket that crosses the remaining budget for the next round.
    """
    edge = targets.select(
        "source", "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long").alias("repeats"),
    ).withColumn("need", F.col("target") - F.col("repeats") * F.col("source_size"))
    edge = edge.withColumn("bucket", F.lit(0).cast("long"))
    small = targets.count() <= MAX_BROADCAST_SOURCES
    keyed = sized.withColumn("key", F.struct(F.col("source").isNull(), F.coalesce("source", F.lit(""))))
    for level in range(LEVELS):
        side = edge.select(
            F.struct(F.col("source").isNull(), F.coalesce("source", F.lit(""))).alias("key"),
            F.col("bucket").alias("parent"), "need", "source_size", "target", "repeats",
        )
        up = _bucket(level - 1) if level else F.lit(0).cast("long")
        rows = keyed.withColumn("bucket", _bucket(level)).join(
            F.broadcast(side) if small else side, ["key"]).where(up == F.col("parent"))
        sums = rows.groupBy("source", "bucket", "need", "source_size", "target", "repeats", "parent").agg(F.sum("size").alias("n"))
        run = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        crossed = (
            sums.withColumn("sum", F.sum("n").over(run))
            .groupBy("source", "source_size", "target", "repeats", "need", "parent")
            .agg(
                F.min(F.when(F.col("sum") > F.col("need"), F.struct("bucket", "n", "sum"))).alias("at"),
                F.max("sum").alias("all"),
            )
        )
        last = level == LEVELS - 1
        bucket = F.coalesce(F.col("at.bucket"), F.shiftleft(F.col("parent") + 1, LEVEL_BITS))
        rest = F.col("need") - F.coalesce(F.col("at.sum") - F.col("at.n"), F.col("all"))
        if last:  # take the crossing bucket if that ends nearer to the budget
            bucket = bucket + F.when(rest * 2 > F.col("at.n"), 1).otherwise(0)
        edge = materialize(
            crossed.select("source", "source_size", "target", "repeats", rest.alias("need"), bucket.alias("bucket")),
            "mix-threshold",
        )
    shift = HASH_BITS - LEVEL_BITS * LEVELS
    found = edge.select("source", F.shiftleft("bucket", shift).alias("threshold"))
    return targets.alias("t").join(found.alias("f"), F.expr("t.source <=> f.source"), "left").select(
        "t.source", "t.source_size", "t.target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long").alias("repeats"),
        F.coalesce("f.threshold", F.lit(0)).alias("threshold"),
    )


def mix_limits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix") -> tuple[DataFrame, DataFrame]:
    """(sized, limits): id, source, hash and size of every row; target and threshold of every source."""
    sized = materialize(
        docs.select(
            F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
            row_hash(seed, F.col(id_col), F.col(text_col)).alias("hash"), word_count(F.col(text_col)).alias("size"),
        ),
        "mix-sizes",
    )
    limits = materialize(thresholds(sized, source_targets(sized)), "mix-limits").withColumnRenamed("source", "of")
    return sized, F.broadcast(limits) if limits.count() <= MAX_BROADCAST_SOURCES else limits


def copies() -> Column:
    """How often the mix takes a row, by its hash and its source's limits; at most 3 times."""
    return F.least(F.col("repeats") + F.when(F.col("hash") < F.col("threshold"), 1).otherwise(0), F.lit(3))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix") -> DataFrame:
    """(doc_id, source, hash, size, source_size, target, copies, taken) for every row of ``docs``.

    ``copies`` is how often the mix takes the document (0 to 3) and ``taken`` its words,
    repeats counted. Null or empty texts have size 0 and take 0 words. Null sources form
    one source, last in order. Equal (id, text) rows are tied: they get the same copies.
    An empty table gives an empty result. Other columns are ignored.
    """
    sized, limits = mix_limits(docs, id_col, text_col, source_col, seed)
    return sized.join(limits, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "source", "hash", "size", "source_size", "target", copies().alias("copies"), (copies() * F.col("size")).alias("taken"))


def repeat_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix") -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, all columns as they were."""
    _, limits = mix_limits(docs, id_col, text_col, source_col, seed)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(source_col).alias("source"),
        row_hash(seed, F.col(id_col), F.col(text_col)).alias("hash"))
    times = F.sequence(F.lit(1).cast("long"), copies())
    return (
        rows.join(limits, F.col("source").eqNullSafe(F.col("of"))).where(copies() > 0)
        .select("row", F.explode(times).alias("time")).select("row.*")
    )
