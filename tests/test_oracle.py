"""Every registered query against its SQL on the same tables."""

import duckdb
import pandas as pd
import pytest

from workloads.oracles import ORACLES
from workloads.queries import QUERIES

SF = "/root/testdata/sf0.01"
TABLES = ["events", "lineitem", "orders"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    yield con
    con.close()


def normal(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = [
        tuple(None if pd.isna(v) else v for v in row) for row in frame.itertuples(index=False)
    ]
    return sorted(rows, key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    found = QUERIES[name](spark, SF).toPandas()
    expected = duck.execute(ORACLES[name]).df()
    assert sorted(found.columns) == sorted(expected.columns)
    assert len(found) > 0
    assert normal(found) == normal(expected)
