"""Written, streamed and unioned rows against their SQL, row by row."""
import duckdb
import pytest

import __spark_entry__ as E

from test_entry import SMALL, TABLES


@pytest.mark.parametrize("name", ["union_source_rows", "written_rows", "stream_ingest_rows", "stream_dedup_rows"])
def test_rows_agree(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    df = E.queries()[name](spark, SMALL)
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({E.oracle_sql()[name]})").fetchall()
    got = [tuple(r) for r in df.collect()]
    assert got and sorted(map(repr, got)) == sorted(map(repr, want))
