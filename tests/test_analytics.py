"""Report invariants (consistency of the report tables) on sf0.001."""
from pyspark.sql import functions as F

from covlens.config import TEST_REPORT as P, ReportParams
from covlens.operators import analytics as A
from covlens.sources.binding import media_items

SMALL = "/root/testdata/sf0.001"


def test_invariants(spark):
    m = media_items(spark, SMALL)
    mt = A.mentions_total(m, P).first()
    pubs = A.by_publisher(m, P, k=10_000).agg(F.sum("n")).first()[0]
    days = A.by_day(m, P).agg(F.sum("n")).first()[0]
    assert pubs == mt.n_mentions == days
    st = A.sentiment_totals(m, P).collect()
    scored = A.current(m, P).filter(F.col("sent").isNotNull()).count()
    assert sum(r.n for r in st) == scored
    assert abs(sum(r.share for r in st) - 1.0) < 1e-9
    topics = A.by_topic(m, P, k=10_000).agg(F.sum("n")).first()[0]
    assert topics == A.current(m, P).select(F.sum(F.size("topics"))).first()[0]
    sp = A.sentiment_by_publisher(m, P).collect()
    assert all(r.positive + r.neutral + r.negative == r.n_scored for r in sp)


def test_seed_urls_subset_and_limit(spark):
    m = media_items(spark, SMALL)
    s = A.seed_urls(m, P, max_urls=3)
    assert s.groupBy("topic").count().agg(F.max("count")).first()[0] <= 3
    cur_urls = {r.url for r in A.current(m, P).select("url").collect()}
    assert {r.url for r in s.collect()} <= cur_urls


def test_previous_window_empty(spark):
    m = media_items(spark, SMALL)
    p = ReportParams(now="2024-01-05 00:00:00", days=7)  # previous window before the data
    h = A.health_risk(m, p).first()
    assert h.n_prev_mentions == 0 and h.mention_delta == 0.0 and h.reputation == "Stable"
    assert h.health_score == 80 and h.risk == "Low"


def test_health_thresholds(spark):
    df = spark.createDataFrame([(160, 100, 2), (60, 100, 0), (105, 100, 1), (0, 0, 9)],
                               "c long, p long, k long")
    rows = df.select(*A.health_from(F.col("c"), F.col("p"), F.col("k"))).collect()
    assert [(r.health_score, r.reputation, r.risk) for r in rows] == [
        (55, "Improving", "High"), (77, "Declining", "Low"), (70, "Stable", "Low"), (0, "Stable", "Medium")]


def test_rollup_matches_single_counts(spark):
    m = media_items(spark, SMALL)
    r = A.rollup_once(m, P)
    pub = {x.key1: x.n for x in r.filter("grouping_set = 'publisher'").collect()}
    single = {x.publisher: x.n for x in A.by_publisher(m, P, k=10_000).collect()}
    assert pub == single
