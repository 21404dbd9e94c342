"""Queries of this subpackage against their SQL over the same tables."""

import duckdb
import pytest

from sigloom.llm import queries
from tests.conftest import DATA


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_rows_as_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = queries.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    result = c.execute(f"SELECT {', '.join(columns)} FROM ({queries.oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, df.select(*columns).collect())) == sorted(result)
