"""Every registered query of the engine's own operators against its SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

import duckdb
import pandas as pd
import pytest

from glyphforge.plans import file_queries  # noqa: F401  registers its queries
from glyphforge.plans.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def rows(df: pd.DataFrame) -> list:
    cell = lambda v: "~" if pd.isna(v) else round(float(v), 6) if isinstance(v, float) else str(v)
    return sorted((tuple(map(cell, r)) for r in df[sorted(df.columns)].astype(object).itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name not in SQL:
        assert len(got)
        return
    want = duck.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
