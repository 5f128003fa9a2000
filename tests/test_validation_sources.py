"""Strict response validation, hostile payloads, request filter."""
from pyspark.sql import functions as F

from covlens.operators.enrich import validate_enrichment
from covlens.sources import landing as L

CASES = [
    ("{}", "ok", None), ('{"topics":null}', "error", "bad_topics"), ('{"topics":[1,"a"]}', "error", "bad_topics"),
    ('{"topics":["a",null]}', "error", "bad_topics"), ('{"is_editorial":"yes"}', "ok", True),
    ('{"is_editorial":2}', "error", None), ("[]", "error", None), ("nope", "error", None), ("", "error", None),
    ('{"topics":["a","a"],"language":"id","sentiment":"negative","extra":1}', "ok", None),
    ('{"language":5}', "error", None), ('{"is_editorial":"No"}', "ok", False),
]


def test_validate(spark):
    df = spark.createDataFrame([(c,) for c, _, _ in CASES], "t string")
    out = df.select(validate_enrichment(F.col("t")).alias("e")).collect()
    for (text, status, extra), r in zip(CASES, out):
        assert r.e.status == status, text
        if text == '{"is_editorial":"yes"}':
            assert r.e.is_editorial is True
        if text == '{"is_editorial":"No"}':
            assert r.e.is_editorial is False
        if status == "error":
            assert r.e.topics == [] and r.e.language is None
    assert out[9].e.topics == ["a", "a"]


def test_strict_requires_all_fields(spark):
    df = spark.createDataFrame([("{}",), ('{"topics":[],"actors":[],"locations":[],"language":null,'
                                         '"is_editorial":null,"sentiment":"neutral"}',)], "t string")
    out = [r.e.status for r in df.select(validate_enrichment(F.col("t"), strict=True).alias("e")).collect()]
    assert out == ["error", "ok"]


def test_malformed_xml_contributes_nothing(spark):
    good = "<rss><channel><item><title>A</title><link>http://a</link></item></channel></rss>"
    bad = "<rss><channel><item><title>B</title><link>http://b</link></item>"
    docs = spark.createDataFrame([("g", good), ("b", bad)], "path string, text string")
    e = L.parse_feed_xml(docs, F.lit("x_feed"), F.lit("http://f"))
    assert [r.entry["link"] for r in e.collect()] == ["http://a"]


def test_aggregator_error_payload(spark):
    docs = spark.createDataFrame([("e", '{"error":{"code":"invalid_access_key","message":"m"}}'),
                                  ("d", '{"data":[{"url":"u1","title":"t"}]}')], "path string, text string")
    arts, errs = L.parse_aggregator_list(docs)
    assert [r.url for r in arts.collect()] == ["u1"]
    assert [r.code for r in errs.collect()] == ["invalid_access_key"]


def test_clean_languages():
    assert L.clean_languages("en, -de, id, ,fr") == ["en", "-de", "fr"]
    assert L.clean_languages("id") is None and L.clean_languages("") is None


def test_hostile_items(spark):
    """Missing url collapses ids per platform; a future-dated item counts
    as current; topics JSON that is null, scalar, broken or repeated."""
    from covlens.config import ReportParams
    from covlens.functions import item_id, parse_json_list
    from covlens.operators import analytics as A
    from covlens.schema import conform
    rows = [("rss", None), ("rss", ""), ("gdelt", None)]
    ids = spark.createDataFrame(rows, "p string, u string").select(item_id(F.col("p"), F.col("u")).alias("i"))
    assert ids.distinct().count() == 2
    js = spark.createDataFrame([("null",), ('"abc"',), ("{",), ('["a","a"]',)], "t string")
    assert [r.l for r in js.select(parse_json_list(F.col("t")).alias("l")).collect()] == [[], [], [], ["a", "a"]]
    items = spark.createDataFrame([("x", "2030-01-01 00:00:00", ["a", "a"]), ("y", "2024-01-20 00:00:00", [])],
                                  "id string, published_at string, topics array<string>")
    items = conform(items.select("id", F.col("published_at").cast("timestamp").alias("published_at"), "topics",
                                 F.lit("rss").alias("platform"), F.lit("u").alias("url"),
                                 F.lit("p").alias("publisher_or_author"),
                                 F.lit("2024-01-31 00:00:00").cast("timestamp").alias("ingested_at")))
    p = ReportParams(now="2024-01-31 00:00:00", days=7)
    m = A.mentions_total(items, p).first()
    assert (m.n_mentions, m.n_prev_mentions) == (1, 1)
    assert {r.topic: r.n for r in A.by_topic(items, p).collect()} == {"a": 2}
