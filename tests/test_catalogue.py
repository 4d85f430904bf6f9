"""Every query with SQL gives what DuckDB gives on the smallest tables."""

import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from folioflow.plans import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def shown(v):
    """A value as text: nulls of any kind alike, whole floats as integers, others to nine digits."""
    if isinstance(v, (list, tuple, np.ndarray)):
        return str([shown(x) for x in v])
    if v is None or pd.isna(v):
        return "-"
    if isinstance(v, float):
        return str(int(v)) if v == int(v) else f"{v:.9g}"
    return str(v)


def rows(df):
    cols = sorted(df.columns)
    return sorted(tuple(shown(v) for v in r) for r in df[cols].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, DATA).toPandas()
    if name in ORACLE_SQL:
        want = duck.execute(ORACLE_SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)
    else:
        assert len(got.columns) > 0


def test_entry_contract():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
