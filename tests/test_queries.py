"""Every registered query of the cohort operators against its DuckDB twin on the smallest tables."""

import duckdb
import numpy as np
import pytest

from sitewise.plans import registry
from sitewise.plans.fixtures import BASE

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in BASE:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def _sorted(df):
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        df[c] = df[c].astype(float).round(6) if df[c].dtype.kind == "f" else df[c].astype(str)
    keys = sorted(df.columns, key=lambda c: df[c].dtype.kind == "f")
    return df.sort_values(keys, ignore_index=True)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_matches_duckdb(spark, duck, name):
    got, want = registry.queries()[name](spark, SF).toPandas(), duck.sql(registry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got) == len(want) > 0
    got, want = _sorted(got), _sorted(want)
    for c in got.columns:
        try:
            np.testing.assert_allclose(got[c].astype(float), want[c].astype(float), rtol=1e-9, atol=2e-6)
        except ValueError:
            assert got[c].tolist() == want[c].tolist(), c


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_runs(spark, name):
    assert registry.queries()[name](spark, SF).count() > 0
