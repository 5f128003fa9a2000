"""Driver contract: entry runs; every query has a DuckDB oracle or is a
declared rows-only operator; the oracles agree on sf0.001."""
import duckdb
import pytest

import __spark_entry__ as E

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
FAST = ["item_binding", "upsert_items", "by_publisher", "sentiment_by_topic", "rollup_once", "seed_urls",
        "normalize_feed", "normalize_channel", "extract_main_text", "validate_enrichment", "health_risk"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["rank", "topic", "positive", "neutral", "negative"]


def test_every_query_has_oracle():
    assert set(E.ORACLES) == set(E.QUERIES)
    assert set(E.QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    return v


@pytest.mark.parametrize("name", FAST)
def test_oracle_agrees(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    df = E.queries()[name](spark, SMALL)
    cols = sorted(df.columns)
    s = sorted(repr(tuple(_norm(r[c]) for c in cols)) for r in df.collect())
    rel = con.execute(E.oracle_sql()[name])
    dc = [d[0] for d in rel.description]
    assert sorted(dc) == cols
    d = sorted(repr(tuple(_norm(dict(zip(dc, r))[c]) for c in cols)) for r in rel.fetchall())
    assert s == d
