"""Every registered query against its DuckDB twin on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from cabflow.plans.registry import QUERIES as BASE_QUERIES
from scripts.check_oracle import TABLES, digest
from tests.conftest import SF_SMALL

# The queries of the text operators have tests of their own.
NAMES = [n for n, (_, sql) in BASE_QUERIES.items() if sql is not None]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["pickup_borough", "trip_count", "avg_total_amount", "avg_trip_distance"]


def test_rows_only_queries_run(spark):
    for name in set(BASE_QUERIES) - set(NAMES):
        assert entry.queries()[name](spark, SF_SMALL).count() >= 1
