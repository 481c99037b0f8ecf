"""Near-duplicate vectors by cross-polytope hashing, with exact verification.

A vector is turned by fast Hadamard rotations with random signs; the axis with the largest
coordinate, and its sign, is one hash. A table joins several of them. Each vector is indexed
under its own bucket and looks up that bucket and the next likely ones (multiprobe).

Pairs are not listed inside a group. Vectors within half the link angle of a bucket's
smallest vector form a cell, all of whose pairs are links by the triangle inequality on
angles. Pairs of cells that share a bucket are decided as a whole from the angle of
their centres where possible, otherwise counted in blocks by matrix products.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import arrow_rows, materialize
from .components import connected_components

#: Hash tables; each has as many joined hashes as keep buckets below LOAD vectors.
TABLES, LOAD = 10, 0.25
#: Vectors of a cell that are multiplied at once.
BLOCK = 512
#: Guard of the whole-cell decisions against rounding, in radians.
MARGIN = 1e-6


def _signs(dim: int, n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).choice([-1.0, 1.0], size=(n, 3, dim))


def rotate(x: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Three rounds of random signs and the fast Hadamard transform on the rows of x."""
    n, dim = x.shape
    for s in signs:
        x = x * s
        h = 1
        while h < dim:
            y = x.reshape(n, dim // (2 * h), 2, h)
            x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, dim)
            h *= 2
        x = x / math.sqrt(dim)
    return x


def buckets(x: np.ndarray, hashes: int, tables: int = TABLES, seed: int = 11) -> Iterator[tuple[int, np.ndarray]]:
    """(table, codes) with codes[:, 0] each row's own bucket and the rest its probes.

    Probes change one hash to its second or third axis, or two hashes to their second.
    """
    n, dim = x.shape
    signs = _signs(dim, tables * hashes, seed)
    for t in range(tables):
        best = []
        for k in range(hashes):
            y = rotate(x, signs[t * hashes + k])
            top = np.argpartition(-np.abs(y), min(3, dim - 1), axis=1)[:, :min(3, dim)]
            top = np.take_along_axis(top, np.argsort(-np.abs(np.take_along_axis(y, top, 1)), axis=1, kind="stable"), 1)
            best.append(2 * top + (np.take_along_axis(y, top, 1) < 0))
        places = best[0].shape[1]
        choices = [(0,) * hashes] + [tuple(r if i == k else 0 for i in range(hashes)) for k in range(hashes) for r in range(1, places)]
        if places > 1:
            choices += [tuple(int(i in (a, b)) for i in range(hashes)) for a in range(hashes) for b in range(a)]
        codes = np.stack([sum(best[k][:, c[k]].astype(np.int64) * (2 * dim) ** k for k in range(hashes)) for c in choices], axis=1)
        yield t, codes


def unit_vectors(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v, dim): double unit vectors as bytes, padded to a power of two; null v where unusable."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for e in b["e"]:
                v = None
                if e is not None and len(e):
                    a = np.array([np.nan if c is None else c for c in e], np.float64)
                    top = np.abs(a).max() if np.isfinite(a).all() else 0.0
                    if top > 0:
                        a = a / top
                        a = a / math.sqrt(float(a @ a)) + 0.0
                        v = np.pad(a, (0, (1 << (len(a) - 1).bit_length()) - len(a))).tobytes()
                out.append((v, len(e) if v else None))
            yield pd.DataFrame({"id": b["id"], "v": [v for v, _ in out], "dim": pd.array([d for _, d in out], "Int32")})

    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("e"))
    return rows.mapInPandas(run, "id long, v binary, dim int").withColumn("v", F.when(F.col("id").isNotNull(), F.col("v")))


def _codes(classes: DataFrame, hashes: int, tables: int) -> DataFrame:
    """(t, bucket, own, rep): each class under its own bucket and its probes."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for dim, part in b.groupby("dim"):
                x = np.vstack([np.frombuffer(v) for v in part["v"]])
                reps = part["rep"].to_numpy()
                for t, codes in buckets(x, hashes, tables):
                    n, m = codes.shape
                    yield pd.DataFrame({
                        "t": np.full(n * m, t + tables * int(dim), np.int64), "bucket": codes.ravel(),
                        "own": np.tile(np.arange(m) == 0, n), "rep": np.repeat(reps, m)})

    return classes.select("rep", "v", "dim").mapInPandas(run, "t long, bucket long, own boolean, rep long")


def _angle(a: str, b: str):
    """Angle of two unit vectors given as bytes, by a double-precision product, as a column."""
    @F.pandas_udf("double")
    def angle(x: pd.Series, y: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=float)
        return pd.Series([math.acos(max(-1.0, min(1.0, float(np.frombuffer(p) @ np.frombuffer(q))))) for p, q in zip(x, y)])

    return angle(F.col(a), F.col(b))


def _with_angle(pairs: DataFrame, a: str, b: str, vectors: DataFrame) -> DataFrame:
    """Adds ``angle`` to pairs of (a, b) ids, with vectors (rep, v)."""
    left = vectors.select(F.col("rep").alias(a), F.col("v").alias("__va"))
    right = vectors.select(F.col("rep").alias(b), F.col("v").alias("__vb"))
    return pairs.join(left, a).join(right, b).withColumn("angle", _angle("__va", "__vb")).drop("__va", "__vb")


def _block_links(open_pairs: DataFrame, members: DataFrame, threshold: float) -> DataFrame:
    """(rep, linked, a, b): weight of the linked vectors in the other cell, for undecided pairs."""
    blocks = members.groupBy("cell", "block").agg(F.array_sort(F.collect_list(F.struct("rep", "weight", "v"))).alias("m"))
    a = blocks.select(F.col("cell").alias("a"), F.col("m").alias("ma"))
    b = blocks.select(F.col("cell").alias("b"), F.col("m").alias("mb"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            for r in part.itertuples(index=False):
                x = np.vstack([np.frombuffer(m["v"]) for m in r.ma])
                y = np.vstack([np.frombuffer(m["v"]) for m in r.mb])
                hit = x @ y.T >= threshold
                wx, wy = (np.array([m["weight"] for m in s], np.int64) for s in (r.ma, r.mb))
                reps = [m["rep"] for m in r.ma] + [m["rep"] for m in r.mb]
                yield pd.DataFrame({"rep": reps, "linked": np.concatenate([hit @ wy, wx @ hit]), "a": r.a, "b": r.b})

    joined = open_pairs.select("a", "b").join(a, "a").join(b, "b")
    return joined.mapInPandas(run, "rep long, linked long, a long, b long")


def link_vectors(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", min_cosine: float = 0.95, tables: int = TABLES) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``table``.

    Vectors link where their cosine in double precision is ``min_cosine`` or more. Vectors
    that are null, empty, zero, or hold a null or non-finite component link with nothing,
    nor do rows with a null id or vectors of another length. Equal vectors are links and
    repeated rows count as vectors of their own. An empty table gives no rows.
    """
    rows = materialize(unit_vectors(table, id_col, vec_col), "vectors")
    usable = rows.where("v is not null")
    classes = materialize(usable.groupBy("dim", "v").agg(F.min("id").alias("first"), F.count("*").alias("weight")).withColumn("rep", F.xxhash64("dim", "v")), "vector-classes")
    n = classes.count()
    dim = classes.agg(F.max(F.length("v") / 8)).first()[0] or 1
    hashes = max(1, math.ceil(math.log(max(2, n / LOAD)) / math.log(2 * max(2, dim))))
    codes = materialize(_codes(classes, hashes, tables), "vector-codes")
    own = codes.where("own")
    theta = math.acos(min_cosine)
    half = theta / 2 - MARGIN
    vectors = classes.select("rep", "v")
    # Cells: the smallest bucket leader within half the link angle, else the vector itself.
    leaders = own.groupBy("t", "bucket").agg(F.min("rep").alias("leader"))
    near = codes.join(leaders, ["t", "bucket"]).where("leader <> rep").select("rep", "leader").distinct()
    close = _with_angle(near, "rep", "leader", vectors).where(F.col("angle") <= half)
    best = close.groupBy("rep").agg(F.min(F.struct("leader", "angle")).alias("c"))
    cells = materialize(
        classes.join(best, "rep", "left").select(
            "rep", "first", "weight", "v", F.coalesce("c.leader", "rep").alias("cell"), F.coalesce("c.angle", F.lit(0.0)).alias("radius"),
            F.pmod(F.xxhash64("rep"), F.lit(1 << 20)).alias("h")),
        "vector-cells",
    )
    sums = cells.groupBy("cell").agg(F.sum("weight").alias("cell_weight"), F.count("*").alias("size"), F.max("radius").alias("radius"))
    sums = materialize(sums.join(vectors.withColumnRenamed("rep", "cell"), "cell"), "vector-cell-sums")
    # Pairs of cells that meet in a bucket, one side by its own bucket, the other by any probe.
    in_cell = codes.join(cells.select("rep", "cell"), "rep")
    there = in_cell.where("own").select("t", "bucket", F.col("cell").alias("a")).distinct()
    asks = in_cell.select("t", "bucket", F.col("cell").alias("b")).distinct()
    met = there.join(asks, ["t", "bucket"]).where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = _with_angle(met, "a", "b", sums.select(F.col("cell").alias("rep"), "v"))
    for side in "ab":
        pairs = pairs.join(sums.select(F.col("cell").alias(side), F.col("cell_weight").alias(f"w{side}"), F.col("size").alias(f"n{side}"), F.col("radius").alias(f"r{side}")), side)
    reach = F.col("ra") + F.col("rb") + MARGIN
    pairs = materialize(pairs.where(F.col("angle") - reach <= theta).withColumn("whole", F.col("angle") + reach <= theta), "vector-cell-pairs")
    whole = pairs.where("whole")
    by_cell = whole.select(F.col("a").alias("cell"), F.col("wb").alias("more")).unionByName(whole.select(F.col("b").alias("cell"), F.col("wa").alias("more"))).groupBy("cell").agg(F.sum("more").alias("more"))
    # Blocks of about BLOCK members by hash, so that no task holds a whole cell.
    blocks = cells.join(sums.select("cell", "size"), "cell").withColumn("block", F.pmod("h", F.ceil(F.col("size") / BLOCK)))
    with arrow_rows(table.sparkSession, 8):
        counted = materialize(_block_links(pairs.where("not whole"), blocks, min_cosine), "vector-block-links")
    by_rep = counted.groupBy("rep").agg(F.sum("linked").alias("found"))
    edges = whole.select("a", "b").unionByName(counted.where("linked > 0").select("a", "b").distinct())
    least = cells.groupBy("cell").agg(F.min("first").alias("least"))
    parts = connected_components(edges).withColumnRenamed("node", "cell")
    named = least.join(parts, "cell", "left").withColumn("component", F.coalesce("component", "cell"))
    roots = named.groupBy("component").agg(F.min("least").alias("component_id"))
    result = (
        cells.select("rep", "weight", "cell").join(sums.select("cell", "cell_weight"), "cell")
        .join(named.select("cell", "component"), "cell").join(roots, "component")
        .join(by_cell, "cell", "left").join(by_rep, "rep", "left")
        .select("rep", "component_id", (F.col("cell_weight") - 1 + F.coalesce("more", F.lit(0)) + F.coalesce("found", F.lit(0))).alias("n_links"))
    )
    of_row = rows.join(classes.select("dim", "v", "rep"), ["dim", "v"], "left").select("id", "rep")
    out = of_row.join(result, "rep", "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
