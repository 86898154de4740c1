"""Every registered query equals its DuckDB twin on the driver tables."""
import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql
from __spark_entry__ import queries as all_queries
from citystream.plans.queries import QUERIES
from citystream.sources.fixtures import TABLES
from tools.check_oracle import digest


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def queries():
    """The reference's own operators; those of the optional package have tests
    of their own."""
    return QUERIES


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() > 0 and "total_kwh_consumed" in df.columns


def test_every_query_has_an_oracle():
    assert set(queries()) <= set(all_queries())
    assert set(queries()) <= set(oracle_sql()) <= set(all_queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, duck, sf_dir, name):
    df = queries()[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_queries_are_repeatable(spark, sf_dir):
    for name in ("q_json_roundtrip", "q_aqi_rolling_sql"):
        a = queries()[name](spark, sf_dir).count()
        assert queries()[name](spark, sf_dir).count() == a
