"""The DuckDB SQL of corpus queries gives their rows."""

import duckdb
import pytest

from cairn.llm.queries import ORACLES, QUERIES

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "benchmark"):
        duck.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    want = duck.execute(ORACLES[name]).df()
    got = QUERIES[name](spark, DIR).toPandas()
    assert list(got.columns) == list(want.columns)
    assert sorted(map(tuple, got.itertuples(index=False)), key=str) == sorted(map(tuple, want.itertuples(index=False)), key=str)
