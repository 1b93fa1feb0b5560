"""Every registered query against its DuckDB SQL, over small tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from cairn.plans.register import ORACLES, QUERIES

DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in glob.glob(f"{DIR}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


def rows(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    plain = lambda v: None if v is None or v is pd.NA or (isinstance(v, float) and v != v) else round(v, 9) if isinstance(v, float) else bool(v) if str(type(v)).find("bool") >= 0 else int(v) if str(type(v)).find("int") >= 0 else v
    return sorted((tuple(plain(v) for v in r) for r in df.astype(object).itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, DIR)
    if name not in ORACLES:
        assert got.count() > 0
        return
    want = duck.execute(ORACLES[name]).df()
    got = got.toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    a, b = rows(got), rows(want)
    assert len(a) == len(b)
    assert [x for x in zip(a, b) if x[0] != x[1]][:3] == []
