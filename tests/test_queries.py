from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from check import compare
from tidemark.workload.oracles import ORACLES
from tidemark.workload.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_its_sql(spark, con, name):
    assert compare(spark, FOLDER, name, con).split()[0] in ("ok", "rows")


def test_only_the_sample_has_no_sql():
    assert set(QUERIES) - set(ORACLES) == {"sample_rows"}
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
