"""Every query with SQL against DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__
from factloom.plans import registry

DATA = os.environ.get("FACTLOOM_TESTDATA", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    assert os.path.isdir(DATA), f"no test tables in {DATA}; FACTLOOM_TESTDATA names another folder"
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "NULL"
    return repr(round(v, 9)) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, DATA)
    want = duck.sql(registry.ORACLES[name])
    columns = sorted(df.columns)
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    assert sorted(tuple(plain(r[c]) for c in columns) for r in df.collect()) == sorted(tuple(plain(r[i]) for i in at) for r in want.fetchall())


def test_free_calls_equal_sql(spark, tmp_path):
    """A view with one token costs 0.4 millionths and is not free; one without tokens is, and so is a click or a call without a type; without a value neither is known."""
    rows = [(100, "view", 1.5), (200, "view", 0.5), (300, "view", None), (700, "view", 1.0), (400, "click", 5.0), (1400, "click", 0.9), (2100, "click", 1.0), (500, None, 1.0)]
    events = spark.createDataFrame(rows, "event_id long, event_type string, value double").selectExpr("*", "timestamp_ntz'2024-01-01' AS ts", "1L AS user_id", "'{}' AS props")
    events.write.parquet(f"{tmp_path}/events.parquet")
    got = sorted(map(str, registry.QUERIES["price_lookup_fallback"](spark, str(tmp_path)).select("model", "free", "calls").toLocalIterator()))
    c = duckdb.connect()
    c.sql(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    want = c.sql(f"SELECT model, free, calls FROM ({registry.ORACLES['price_lookup_fallback']})").fetchall()
    assert got == sorted(f"Row(model={m!r}, free={f}, calls={n})" for m, f, n in want)
    assert sorted(map(str, want)) == sorted(map(str, [("view", 1, 3), ("VIEW", 0, 1), ("click", 1, 1), ("CLICK", 1, 2), (None, 1, 1)]))


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert registry.QUERIES[name](spark, DATA).count() > 0


def test_entry_and_names(spark):
    assert __spark_entry__.entry(spark).count() == 10
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
