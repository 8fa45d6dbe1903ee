"""Every query against its SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

import datetime
import os

import duckdb
import pytest

from scriptorium import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages labels".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (int, float)) or hasattr(v, "is_finite"):
        return round(float(v), 6)
    return v


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    rows = df.collect()
    if name not in registry.ORACLES:
        assert rows
        return
    result = duck.execute(registry.ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted((tuple(plain(r[columns.index(c)]) for c in df.columns) for r in result.fetchall()), key=repr)
    assert sorted((tuple(plain(r[c]) for c in df.columns) for r in rows), key=repr) == want


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["subject", "refused_id", "refusal_category", "latest_id", "latest_status"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
