"""Every registered query with SQL against DuckDB over the same tables."""

import duckdb
import pytest

from sigloom.plans import catalog
from tests.conftest import DATA

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if hasattr(v, "item"):
        v = v.item()
    if v is None or v != v:
        return None
    return repr(v) if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_same_rows_as_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted((tuple(map(plain, r)) for r in df.select(*columns).collect()), key=repr)
    result = duck.execute(catalog.SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    want = sorted((tuple(plain(r[i]) for i in places) for r in result.fetchall()), key=repr)
    assert got == want


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_streams_equal_batch(spark):
    limited = {r["event_id"]: r["admitted"] for r in catalog.QUERIES["burst_limit_stream"](spark, DATA).collect()}
    assert limited == {r["event_id"]: r["admitted"] for r in catalog.QUERIES["burst_limit"](spark, DATA).collect()}
    now = {r["rec_id"]: (r["attempts"], r["dead"], r["status"] in ("acked", "dead")) for r in catalog.QUERIES["queue_fold_stream"](spark, DATA).collect()}
    batch = {r["rec_id"]: (r["attempts"], r["dead"], r["status"] in ("acked", "dead")) for r in catalog.QUERIES["queue_fold"](spark, DATA).collect()}
    assert now == batch
