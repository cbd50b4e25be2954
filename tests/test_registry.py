"""Every registered query against its DuckDB text on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SMALL
from fixtures.registry import ORACLES, QUERIES

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 20


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, oracle, name):
    got = QUERIES[name](spark, SMALL).toPandas()
    want = oracle.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)

    def plain(frame):
        frame = frame[columns].astype(object).where(frame[columns].notna(), None)
        return sorted(map(repr, frame.itertuples(index=False, name=None)))

    assert plain(got) == plain(want)
