"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from registry.oracle import ORACLE_SQL as SQL
from registry.queries import QUERIES as PLAIN
from textpulse.session import utc

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
QUERIES = {name: utc(function) for name, function in PLAIN.items()}


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_every_sql_has_its_query():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) - set(SQL) == {"file_md5", "topic_assign", "topic_assign_text"}


def test_entry_has_every_query():
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).columns == [
        "year_month", "total_posts", "avg_sentiment", "pct_negative", "rolling_3mo_sentiment"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    cursor = con.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    got = sorted(repr(tuple(r[c] for c in order)) for r in df.collect())
    want = sorted(repr(tuple(dict(zip(names, r))[c] for c in order)) for r in cursor.fetchall())
    assert got == want


@pytest.mark.parametrize("name", ["topic_assign", "topic_assign_text"])
def test_topic_fits_keep_every_row(spark, name):
    from collections import Counter
    rows = QUERIES[name](spark, SF).collect()
    sizes = Counter(r.dominant_topic for r in rows)
    assert all(n >= max(10, len(rows) // 100) for t, n in sizes.items() if t not in (-1, None))
