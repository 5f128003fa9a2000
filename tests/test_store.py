"""Upsert fold semantics and properties."""
from pyspark.sql import functions as F

from covlens.operators import store as ST
from covlens.schema import ITEM_SCHEMA, conform
from covlens.sources.binding import observations, media_items

SMALL = "/root/testdata/sf0.001"


def _obs(spark, rows):
    cols = "id string, seq long, title string, content_hash string, signals_json string, platform string, url string"
    df = spark.createDataFrame(rows, cols)
    df = df.select("*", F.lit("news").alias("source_type"), F.lit("p").alias("publisher_or_author"),
                   F.lit("2024-01-01 00:00:00").cast("timestamp").alias("ingested_at"))
    return conform(df, extra=("seq",))


def test_first_protected_last_rest(spark):
    rows = [("a", 1, "t1", "h1", "s1", "rss", ""), ("a", 2, "t2", "h2", "s2", "rss", ""),
            ("a", 3, None, "h3", "s3", "rss", ""), ("b", 5, "x", "hb", "sb", "rss", "u")]
    snap = {r.id: r for r in ST.upsert_fold(_obs(spark, rows)).collect()}
    a = snap["a"]
    assert a.content_hash == "h1" and a.signals_json == "s1"   # first seen
    assert a.title is None                                     # a later NULL overwrites
    assert a.n_observations == 3 and snap["b"].title == "x"


def test_fold_independent_of_partitioning(spark):
    obs = observations(spark, SMALL)
    a = sorted(map(tuple, ST.upsert_fold(obs).select("id", "title", "content_hash", "published_at").collect()))
    b = sorted(map(tuple, ST.upsert_fold(obs.repartition(7, F.rand(3))).select(
        "id", "title", "content_hash", "published_at").collect()))
    assert a == b


def test_incremental_equals_full(spark):
    obs = observations(spark, SMALL)
    full = ST.upsert_fold(obs).select(*ITEM_SCHEMA.fieldNames())
    first = ST.upsert_fold(obs.filter(F.col("seq") < 120)).select(*ITEM_SCHEMA.fieldNames())
    later = obs.filter(F.col("seq") >= 120)
    inc, stats = ST.upsert_batch(first, later)
    key = ["id", "title", "summary", "content_hash", "sentiment", "published_at"]
    assert sorted(map(tuple, inc.select(*key).collect())) == sorted(map(tuple, full.select(*key).collect()))
    s = stats.first()
    assert s.inserted + s.updated == later.count()
    _, none = ST.upsert_batch(first, later.limit(0))
    assert tuple(none.first()) == (0, 0)


def test_latest_and_apply(spark):
    m = media_items(spark, SMALL)
    log = m.select("id", F.lit(1).alias("seq"), F.array(F.lit("x")).alias("topics"),
                   F.lit("neutral").alias("sentiment"))
    log = log.unionByName(spark.createDataFrame([("nope", 2, ["y"], "positive")],
                                                "id string, seq int, topics array<string>, sentiment string"))
    r = ST.apply_enrichment(m, log)
    assert r.count() == m.count()
    assert r.filter(F.col("topics") == F.array(F.lit("x"))).count() == m.count()
