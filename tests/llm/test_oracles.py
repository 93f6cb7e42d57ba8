from __future__ import annotations

import duckdb
import pytest

from waybill.llm.oracle import ORACLES
from waybill.llm.queries import QUERIES

from .conftest import SF


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_its_sql(spark, duck, name):
    want = duck.execute(ORACLES[name]).df()
    got = QUERIES[name](spark, SF).toPandas()[list(want.columns)]
    by = [want.columns[0]]
    want, got = (x.sort_values(by).reset_index(drop=True) for x in (want, got))
    assert got.astype(str).equals(want.astype(str))
