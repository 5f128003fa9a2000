"""A snapshot that is written whole is folded by whole rows."""
from pyspark.sql import functions as F

from covlens.operators import store as ST
from covlens.schema import ITEM_COLUMNS, ITEM_SCHEMA, conform


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_the_whole_fold_gives_the_rows_of_the_fold_by_columns(spark):
    rows = [(f"i{k % 7}", "rss", "news", "p", f"u{k}", None if k % 3 else f"t{k}", f"h{k}", None if k % 2 else f"s{k}", ["a"] if k % 4 else None, k)
            for k in range(40)]
    obs = spark.createDataFrame(rows, "id string, platform string, source_type string, publisher_or_author string, url string, title string, "
                                      "content_hash string, sentiment string, topics array<string>, seq long")
    by_columns, whole = ST.upsert_fold(obs), ST.upsert_fold(obs, whole=True)
    assert whole.schema.names == by_columns.schema.names
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, by_columns.collect())) and whole.count() == 7
    full = conform(obs.select("*", F.current_timestamp().alias("ingested_at")), extra=("seq",))
    assert ST.upsert_fold(full, whole=True).select(*ITEM_COLUMNS).schema.names == ITEM_SCHEMA.names
    assert optimized(ST.upsert_fold(full, whole=True).select(*ITEM_COLUMNS)).count("_by(") == 2
