"""Streams with state: one file a trigger, a restart, and the early stop, against batch answers."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

from sitewise.streaming import jobs
from sitewise.streaming.state import EarlyStop, latest, recurrence_stream, run_updates

SCHEMA = "run_id long, pos long, effect_size double"


def write_run(spark, path, rows, name):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{path}/{name}")


def expected(rows):
    seen = defaultdict(dict)
    for run, pos, e in rows:
        seen[pos].setdefault(run, e or 0.0)
    return {p: (len(r), round(sum(r.values()), 9), sum(v > 0 for v in r.values())) for p, r in seen.items()}


def test_recurrence_equals_the_batch_answer_after_each_file_and_a_restart(spark, tmp_path):
    rng = random.Random(1)
    src, out, checkpoint = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/checkpoint"
    every = []
    for k in range(5):
        rows = [(k, p, float(rng.randrange(-3, 4))) for p in range(30) if rng.random() < 0.6]
        if k == 3:
            rows += every[:5]  # an old run comes again
        write_run(spark, src, rows, f"f{k}")
        every += rows
        # Each pass is a new query on the same checkpoint, so this is a restart as well.
        stream = jobs.read_stream(spark, f"{src}/*", spark.createDataFrame([], SCHEMA).schema)
        run_updates(recurrence_stream(stream, ["pos"]), out, checkpoint)
        got = {r.pos: (r.n_runs, round(r.sum_effect, 9), r.n_positive) for r in latest(spark, out, ["pos"]).collect()}
        assert got == expected(every)


def plain_stop(runs, share, min_runs, window, jaccard, delta, patience):
    panels, n, streak = [], defaultdict(int), 0
    for k, run in enumerate(runs, 1):
        for p in set(run):
            n[p] += 1
        panels.append({p for p, c in n.items() if c >= share * k})
        ok = False
        if k >= min_runs and k > window:
            a, b = panels[-1], panels[-1 - window]
            ok = (len(a & b) / len(a | b) if a | b else 1.0) >= jaccard and abs(len(a) - len(b)) / max(1, len(b)) <= delta
        streak = streak + 1 if ok else 0
        if streak >= patience:
            return k
    return None


def test_early_stop_ends_at_the_batch_twins_run(spark, tmp_path):
    rng = random.Random(2)
    stable = list(range(40))
    runs = [[p for p in stable if rng.random() < 0.97] + [1000 + rng.randrange(500) for _ in range(5)] for _ in range(14)]
    src = f"{tmp_path}/in"
    schema = spark.createDataFrame([], SCHEMA).schema
    settings = dict(min_frequency=0.7, min_runs=4, window=2, jaccard=0.9, max_delta=0.2, patience=3)
    want = plain_stop(runs, 0.7, 4, 2, 0.9, 0.2, 3)
    assert want is not None and want < 12
    for k, run in enumerate(runs[:5]):
        write_run(spark, src, [(k, p, 1.0) for p in run], f"f{k:02d}")
    first = EarlyStop(f"{tmp_path}/state", ["pos"], **settings)
    stream = lambda: jobs.read_stream(spark, f"{src}/*", schema)
    assert first.run(stream(), f"{tmp_path}/checkpoint") == (want if want <= 5 else None)
    for k, run in enumerate(runs[5:], 5):
        write_run(spark, src, [(k, p, 1.0) for p in run], f"f{k:02d}")
    again = EarlyStop(f"{tmp_path}/state", ["pos"], **settings)  # a new process would start like this
    assert again.run(stream(), f"{tmp_path}/checkpoint") == want
    log = {r.k: r for r in again.log(spark).collect()}
    assert max(log) == want and log[want].stop and not any(log[k].stop for k in log if k < want)
    counts = {r.pos: r.n for r in spark.read.parquet(f"{tmp_path}/state/counts/k={want}").collect()}
    assert counts == {p: c for p in {x for r in runs[:want] for x in r} if (c := sum(p in r for r in runs[:want]))}


def test_recurrence_keeps_its_state_without_python(spark, tmp_path):
    """A Python call for each key and batch took most of the time."""
    stream = jobs.read_stream(spark, str(tmp_path), spark.createDataFrame([], SCHEMA).schema)
    plan = recurrence_stream(stream, ["pos"])._jdf.queryExecution().logical().toString()
    assert "PandasWithState" not in plan and "Deduplicate" in plan
