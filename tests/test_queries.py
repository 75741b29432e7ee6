"""Every registered query against its SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from glosswell.registry import ORACLES, QUERIES



@pytest.fixture(scope="module")
def tables(small):
    con = duckdb.connect()
    for path in Path(small).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, small, tables, name):
    got = entry.queries()[name](spark, small)
    want = tables.execute(ORACLES[name])
    names = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(names)
    key = lambda row: [repr(v) for v in row]
    rows = sorted((tuple(r[c] for c in names) for r in got.collect()), key=key)
    assert rows == sorted(want.fetchall(), key=key)
    assert rows


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) == set(ORACLES)
    assert set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).columns == ["window_start", "rank", "user_id", "cents"]
