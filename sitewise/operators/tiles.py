"""Maximum-entropy models of read patterns in tiles of k neighbouring sites, and their measures.

A pattern is a state of k spins. The model of a tile is the exponential family over all 2^k
states with a field for each site and a coupling for each pair; it is fitted so that its means
of spins and of coupled products are those of the reads.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The model's columns: fields and couplings, state probabilities, whether the means are met, and the measures.
MODEL = "struct<theta: array<double>, prob: array<double>, log_z: double, converged: boolean, mml: double, nme: double, esi: double, msi: double>"


@dataclass(frozen=True)
class States:
    """All states of k sites, the first site in the highest bit, with the statistics of each."""

    k: int
    couplings: str = "nearest"

    @property
    def pairs(self) -> list[tuple[int, int]]:
        if self.couplings not in ("nearest", "all"):
            raise ValueError("couplings are 'nearest' or 'all'")
        return [(i, j) for i in range(self.k) for j in range(i + 1, self.k) if self.couplings == "all" or j == i + 1]

    def statistics(self) -> np.ndarray:
        """(state, spin of each site and product of each pair)."""
        bits = np.arange(1 << self.k)[:, None] >> np.arange(self.k - 1, -1, -1) & 1
        spins = 2.0 * bits - 1.0
        return np.hstack([spins, *[spins[:, [i]] * spins[:, [j]] for i, j in self.pairs]])


def _log_states(theta: np.ndarray, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log probability of each state, log of the normaliser) of each tile."""
    energy = theta @ stats.T
    top = energy.max(1, keepdims=True)
    log_z = top + np.log(np.exp(energy - top).sum(1, keepdims=True))
    return energy - log_z, log_z[:, 0]


def fit_states(counts: np.ndarray, states: States, max_iter: int = 100, tol: float = 1e-6, ridge: float = 1e-8) -> tuple[np.ndarray, np.ndarray]:
    """(theta, converged) of each row of counts over the states.

    Newton steps on the mean log likelihood, all tiles at once. A step is halved while it would
    lower the likelihood; a tile whose means are met within ``tol`` rests, so its result does
    not depend on the tiles beside it. Where a state never occurs the fields grow without end,
    and the tile rests as soon as the means are met. A tile without reads has all fields 0.
    """
    stats = states.statistics()
    n = counts.sum(1)
    want = counts @ stats / np.maximum(n, 1.0)[:, None]
    theta = np.zeros((len(counts), stats.shape[1]))
    off = np.full(len(counts), np.inf)
    off[n <= 0] = 0.0
    for _ in range(max_iter):
        live = np.flatnonzero(off >= tol)
        if not len(live):
            break
        t, goal = theta[live], want[live]
        log_p, log_z = _log_states(t, stats)
        p = np.exp(log_p)
        mean = p @ stats
        left = goal - mean
        off[live] = np.abs(left).max(1)
        cov = np.einsum("ts,sf,sg->tfg", p, stats, stats) - mean[:, :, None] * mean[:, None, :]
        diag = np.einsum("tff->tf", cov)
        diag += ridge * diag + 1e-12
        step = np.linalg.solve(cov, left[:, :, None])[..., 0]
        # A field of more than 5 in one step leaves the region where the second order holds.
        size = np.minimum(1.0, 5.0 / np.maximum(np.abs(step).max(1), 1e-300))
        before = (t * goal).sum(1) - log_z
        for _ in range(20):
            new = t + size[:, None] * step
            worse = (new * goal).sum(1) - _log_states(new, stats)[1] < before - 1e-15
            if not worse.any():
                break
            size = np.where(worse, size / 2, size)
        theta[live] = t + size[:, None] * step
    mean = np.exp(_log_states(theta, stats)[0]) @ stats
    return theta, np.abs(want - mean).max(1) < tol


def state_measures(theta: np.ndarray, states: States) -> dict[str, np.ndarray]:
    """Mean level, entropy a site, and the norms of both one's gradients in the model's parameters."""
    stats = states.statistics()
    log_p, log_z = _log_states(theta, stats)
    p = np.exp(log_p)
    level = (stats[:, :states.k].mean(1) + 1) / 2
    entropy = -(p * log_p).sum(1)
    cov = lambda f: np.einsum("ts,ts,sf->tf", p, f - (p * f).sum(1, keepdims=True), stats)
    return {
        "prob": p, "log_z": log_z, "mml": p @ level, "nme": entropy / np.log(2) / states.k,
        "esi": np.linalg.norm(cov(-log_p), axis=1) / np.log(2) / states.k, "msi": np.linalg.norm(cov(np.broadcast_to(level, p.shape)), axis=1)}


def histogram(patterns: DataFrame, by: list[str], k: int) -> DataFrame:
    """(by, n_reads, hist): counts of all 2^k patterns, in order; patterns outside are left out."""
    seen = patterns.where(F.col("pattern").between(0, 2**k - 1)).groupBy(*by, "pattern").agg(F.sum("cnt").alias("cnt"))
    g = seen.groupBy(*by).agg(F.sum("cnt").cast("long").alias("n_reads"), F.map_from_entries(F.collect_list(F.struct(F.col("pattern").cast("long"), F.col("cnt")))).alias("__m"))
    every = F.sequence(F.lit(0).cast("long"), F.lit(2**k - 1).cast("long"))
    return g.select(*by, "n_reads", F.transform(every, lambda s: F.coalesce(F.element_at("__m", s), F.lit(0)).cast("double")).alias("hist"))


def _model(k: int, couplings: str, max_iter: int, tol: float, ridge: float):
    states = States(k, couplings)
    states.pairs  # a wrong name fails here, not in a task

    @F.pandas_udf(MODEL)
    def fit(hist: pd.Series) -> pd.DataFrame:
        counts = np.stack(hist.to_list()) if len(hist) else np.zeros((0, 2**k))
        theta, converged = fit_states(counts, states, max_iter, tol, ridge)
        found = state_measures(theta, states)
        return pd.DataFrame({
            "theta": list(theta), "prob": list(found["prob"]), "log_z": found["log_z"], "converged": converged,
            "mml": found["mml"], "nme": found["nme"], "esi": found["esi"], "msi": found["msi"]})

    return fit


def fit_tiles(patterns: DataFrame, by: list[str], k: int = 4, couplings: str = "nearest", min_reads: int = 1, max_iter: int = 100, tol: float = 1e-6, ridge: float = 1e-8) -> DataFrame:
    """(by, n_reads, model): the model of each tile with at least ``min_reads`` reads, and its measures.

    ``patterns`` holds (by, pattern, cnt). One shuffle brings a tile's counts together, at most
    2^k of them; Arrow batches of tiles are fitted side by side.
    """
    rows = histogram(patterns, by, k).where(F.col("n_reads") >= min_reads)
    return rows.select(*by, "n_reads", _model(k, couplings, max_iter, tol, ridge)("hist").alias("model"))


def model_means(k: int = 4, couplings: str = "nearest") -> Column:
    """The model's mean of each spin and coupled product, from its state probabilities."""
    columns = States(k, couplings).statistics().T.tolist()
    def mean(weights: list[float]) -> Column:
        return F.aggregate(F.zip_with("model.prob", F.array(*[F.lit(w) for w in weights]), lambda p, w: p * w), F.lit(0.0), lambda s, x: s + x)

    return F.array(*[mean(c) for c in columns])


def differential_tiles(patterns: DataFrame, group: Column, k: int = 4, couplings: str = "nearest", min_reads: int = 10, by: tuple[str, ...] = ("tile",), **fit) -> DataFrame:
    """(by, measures of both groups, dmml, dnme, model_jsd, mutual_information, rank) of tiles that both groups cover.

    ``group`` is 0 or 1 for the rows of ``patterns``, null for those of neither. ``model_jsd``
    is the divergence of both models' states in bits; ``mutual_information`` is what a state
    tells of the group where both are as likely, from the entropies. Ranks go by |dnme|, the
    largest first, then by tile; they are counted in ranges, not in one task.
    """
    by = list(by)
    fitted = fit_tiles(patterns.withColumn("__g", group).where("__g in (0, 1)"), [*by, "__g"], k, couplings, min_reads, **fit)
    side = lambda g: fitted.where(F.col("__g") == g).select(*by, F.col("n_reads").alias(f"n_reads{g}"), F.col("model").alias(f"m{g}"))
    both = side(0).join(side(1), by)
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    log2 = lambda x: F.log2(F.greatest(x, F.lit(1e-300)))
    middle = F.zip_with("m0.prob", "m1.prob", lambda a, b: (a + b) / 2)
    entropy = lambda p: -total(F.transform(p, lambda x: x * log2(x)))
    against = lambda p: total(F.zip_with(p, middle, lambda x, m: F.when(x > 0, x * (log2(x) - log2(m))).otherwise(F.lit(0.0))))
    out = both.select(
        *by, "n_reads0", "n_reads1", *[F.col(f"m{g}.{c}").alias(f"{c}{g}") for g in (0, 1) for c in ("mml", "nme", "converged")],
        (F.col("m0.mml") - F.col("m1.mml")).alias("dmml"), (F.col("m0.nme") - F.col("m1.nme")).alias("dnme"),
        ((against(F.col("m0.prob")) + against(F.col("m1.prob"))) / 2).alias("model_jsd"),
        (entropy(middle) - (entropy(F.col("m0.prob")) + entropy(F.col("m1.prob"))) / 2).alias("mutual_information"))
    from .running import running

    ranked = running(out.withColumn("__d", F.abs("dnme")), [], [F.desc("__d"), *by], {"rank": F.lit(1)})
    return ranked.drop("__d").withColumn("rank", F.col("rank").cast("long"))
