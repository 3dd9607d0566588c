"""Every registered query against its SQL on the smallest given tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracles import TABLES, rows_of  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    if not Path(SF_DIR).exists():
        pytest.skip("given tables are not here")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", [name for name in entry.queries() if name in ORACLES])
def test_query_equals_sql(spark, duck, name):
    ours, theirs = entry.queries()[name](spark, SF_DIR).toArrow(), duck.sql(ORACLES[name]).to_arrow_table()
    assert rows_of(ours) == rows_of(theirs)


@pytest.mark.parametrize("name", [name for name in entry.queries() if name not in ORACLES])
def test_query_gives_rows(spark, duck, name):
    assert entry.queries()[name](spark, SF_DIR).count() > 0


def test_entry_runs(spark, duck):
    assert entry.entry(spark).count() > 0
