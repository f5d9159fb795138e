"""Registered Spark queries against their DuckDB oracle on the smallest scale factor."""
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as ENTRY
from cohortsmith.plans import registry

SF = "/root/testdata/sf0.001"
KEYS = sorted(registry.queries())


def canon(df: pd.DataFrame) -> list:
    def cell(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return None
        if isinstance(v, pd.Timestamp):
            return str(v.date())
        if type(v).__name__ in ("bool", "bool_"):
            return str(bool(v))
        if isinstance(v, float) and v.is_integer():
            return str(int(v))
        return str(v)
    cols = sorted(df.columns)
    rows = [tuple(cell(v) for v in r) for r in df[cols].astype(object).itertuples(index=False)]
    return [cols] + sorted(rows, key=lambda r: tuple("" if x is None else x for x in r))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["customer", "orders", "lineitem", "part"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    got = ENTRY.queries()[key](spark, SF).toPandas()
    want = con.execute(ENTRY.oracle_sql()[key]).df()
    assert canon(got) == canon(want)


def test_every_query_has_oracle():
    assert set(registry.queries()) == set(registry.oracle_sql())
    assert set(registry.queries()) <= set(ENTRY.queries()) and set(ENTRY.oracle_sql()) <= set(ENTRY.queries())
    assert len(registry.queries()) == 72


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_entry_runs(spark):
    df = ENTRY.entry(spark)
    assert df.count() > 0 and "preegfr" in df.columns
