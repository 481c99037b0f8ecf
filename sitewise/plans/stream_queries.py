"""Queries that replay tables through Structured Streaming, with batch twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..shared import new_path
from ..streaming import jobs as J
from ..streaming import state
from .centroid_queries import CENTROID, joined_bins
from .registry import register


def _files(t, df, name, parts=3):
    path = new_path(t.spark, name)
    df.repartition(parts).write.parquet(path)
    return path


def _events(t):
    e = t.events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "user_id", "value")
    # A last row far ahead moves the watermark past every window, so that all are closed.
    end = e.agg(F.max("ts").alias("ts")).select(F.lit(-1).cast("long").alias("event_id"), (F.col("ts") + F.expr("interval 365 days")).alias("ts"), F.lit("end").alias("event_type"), F.lit(-1).cast(e.schema["user_id"].dataType).alias("user_id"), F.lit(0.0).alias("value"))
    path = new_path(t.spark, "events-stream")
    e.repartition(2).write.parquet(path)
    end.write.mode("append").parquet(path)
    return J.read_stream(t.spark, path, e.schema, files_per_trigger=100)


@register("stream_centroid", f"WITH c AS ({CENTROID.replace('SELECT cohort, chrom', 'SELECT chrom').replace('GROUP BY cohort, chrom', 'GROUP BY chrom')}) SELECT chrom, context, pos, N, Sm, Su, Sc2, bins FROM c")
def _(t):
    src = _files(t, t.site_counts, "counts-stream")
    out = new_path(t.spark, "centroid-parts")
    J.centroid_stream(J.read_stream(t.spark, src, t.site_counts.schema), out)().awaitTermination()
    return joined_bins(J.centroid_total(t.spark, out)).select("chrom", "context", "pos", "N", "Sm", "Su", "Sc2", "bins")


@register("stream_window_durations", """SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS n, avg(value) AS mean, stddev_samp(value) AS sd FROM events GROUP BY 1, 2""", "mean sd")
def _(t):
    out = J.windowed_durations(_events(t), "ts", "1 hour", "1 day", None, "event_type", "value")
    return J.run_to_table(out, new_path(t.spark, "stream-out")).where("event_type <> 'end'").select("window_start", "event_type", "n", "mean", "sd")


@register("stream_without_repeats", "SELECT DISTINCT event_id FROM events")
def _(t):
    return J.run_to_table(J.without_repeats(_events(t), "ts", "400 days", ["event_id"]).select("event_id"), new_path(t.spark, "stream-out")).where("event_id >= 0")


@register("stream_sessions", """WITH g AS (SELECT user_id, ts, value, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS brk FROM events),
s AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY ts, brk DESC ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, min(ts) AS session_start, count(*) AS n, max(value) AS largest FROM s GROUP BY user_id, k""", "largest")
def _(t):
    out = J.sessions(_events(t), "ts", "1 hour", "6 hours", "user_id", "value")
    return J.run_to_table(out, new_path(t.spark, "stream-out")).where("user_id >= 0").select("user_id", "session_start", "n", "largest")


def _run_files(t):
    """The runs table as files, one run each, in the order of the runs."""
    path = new_path(t.spark, "runs-stream")
    runs = t.runs.select("run_id", "chrom", "pos", F.col("effect_size").cast("double").alias("effect_size"))
    found = sorted(r.run_id for r in runs.select("run_id").distinct().collect())
    for run in found:  # one folder a run, so that a stream takes them one by one
        runs.where(F.col("run_id") == run).groupBy("run_id", "chrom", "pos").agg(F.min("effect_size").alias("effect_size")).coalesce(1).write.parquet(f"{path}/run{run:06d}")
    return J.read_stream(t.spark, f"{path}/*", t.spark.createDataFrame([], "run_id long, chrom string, pos long, effect_size double").schema)


@register("stream_recurrence", """WITH r AS (SELECT run_id, chrom, pos, min(CAST(effect_size AS DOUBLE)) AS e FROM runs GROUP BY 1, 2, 3)
SELECT chrom, pos, count(*) AS n_runs, sum(e) AS sum_effect, count(*) FILTER (e > 0) AS n_positive FROM r GROUP BY 1, 2""", "sum_effect")
def _(t):
    out = new_path(t.spark, "recurrence")
    state.run_updates(state.recurrence_stream(_run_files(t), ["chrom", "pos"]), out, new_path(t.spark, "recurrence-checkpoint"))
    return state.latest(t.spark, out, ["chrom", "pos"])


@register("stream_early_stop", """WITH f AS (SELECT DISTINCT run_id, chrom, pos FROM runs), o AS (SELECT run_id, row_number() OVER (ORDER BY run_id) AS k FROM (SELECT DISTINCT run_id FROM runs)), ks AS (SELECT k FROM o),
s AS (SELECT ks.k, chrom, pos, count(*) AS n FROM f JOIN o USING (run_id) JOIN ks ON o.k <= ks.k GROUP BY 1, 2, 3), p AS (SELECT k, chrom, pos FROM s WHERE n >= 0.5 * k),
c AS (SELECT ks.k, count(p.chrom) AS size FROM ks LEFT JOIN p USING (k) GROUP BY 1), h AS (SELECT p.k, count(*) AS shared FROM p JOIN p q ON q.k = p.k - 1 AND q.chrom = p.chrom AND q.pos = p.pos GROUP BY 1),
j AS (SELECT c.k, c.size, CASE WHEN c.k >= 3 THEN CASE WHEN c.size + d.size > 0 THEN coalesce(shared, 0) / CAST(c.size + d.size - coalesce(shared, 0) AS DOUBLE) ELSE 1 END END AS jaccard,
      CASE WHEN c.k >= 3 THEN abs(c.size - d.size) / CAST(greatest(1, d.size) AS DOUBLE) END AS delta FROM c LEFT JOIN c d ON d.k = c.k - 1 LEFT JOIN h ON h.k = c.k),
a AS (SELECT *, coalesce(jaccard >= 0.5 AND delta <= 0.5, false) AS agreed FROM j), w AS (SELECT *, sum(CASE WHEN agreed THEN 0 ELSE 1 END) OVER (ORDER BY k) AS g FROM a),
x AS (SELECT *, CAST(sum(CASE WHEN agreed THEN 1 ELSE 0 END) OVER (PARTITION BY g ORDER BY k) AS INTEGER) AS streak FROM w), y AS (SELECT *, min(CASE WHEN streak >= 2 THEN k END) OVER () AS last FROM x)
SELECT CAST(k AS INTEGER) AS k, size, jaccard, delta, agreed, streak, streak >= 2 AS stop FROM y WHERE last IS NULL OR k <= last""", "jaccard delta")
def _(t):
    stop = state.EarlyStop(new_path(t.spark, "early-stop"), ["chrom", "pos"], min_frequency=0.5, min_runs=3, window=1, jaccard=0.5, max_delta=0.5, patience=2)
    stop.run(_run_files(t))
    return stop.log(t.spark)
