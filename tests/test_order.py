"""The sort queries give their rows in order, not just the right rows."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF0001
from skirmish.sources.tables import DRIVER_TABLES


@pytest.mark.parametrize("name,key", [("sort_queue", ["date", "url"]), ("sort_pool", ["date"]),
                                      ("sort_rounds", ["date", "match_id", "map_id", "round_no"])])
def test_rows_come_in_order(spark, name, key):
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    got = E.queries()[name](spark, SF0001)
    key = [k for k in key if k in got.columns]
    want = con.execute(f"SELECT {', '.join(key)} FROM ({E.oracle_sql()[name]})").fetchall()
    assert [tuple(str(r[k]) for k in key) for r in got.collect()] == [tuple(map(str, r)) for r in want] and len(want) > 10
