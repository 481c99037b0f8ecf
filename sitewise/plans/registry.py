"""All registered queries of the cohort operators, with their DuckDB twins."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .fixtures import Tables, duck

_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_oracles: dict[str, str] = {}
MODULES = ("centroid", "detect", "intervals", "genes", "stability", "samples", "scoring", "enrichment", "adjust", "models", "annotation", "multiclass", "panels", "evidence", "fits", "scores", "stream")


def register(name: str, sql: str | None = None, rounds: str = ""):
    """Registers a function of ``Tables``; named double columns are rounded to 6 digits in both engines.

    A shift of 1e-10 in both moves values that lie on a rounding edge off it, so that the last
    bits of differently ordered sums do not show.
    """
    cols = rounds.split()

    def add(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = f(Tables(spark, sf_dir))
            return df.withColumns({c: F.round(F.col(c).cast("double") + 1e-10, 6) for c in cols})

        _queries[name] = run
        if sql:
            _oracles[name] = duck(sql, cols)
        return f

    return add


def _load() -> None:
    for m in MODULES:
        importlib.import_module(f"{__package__}.{m}_queries")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_oracles)
