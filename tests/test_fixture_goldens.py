"""Six landed items of our own through scan -> normalise -> tag -> upsert.
The expected ids and hashes come from plain Python."""
import hashlib
import json
import os

from pyspark.sql import functions as F

from covlens.config import Taxonomy
from covlens.functions import url_domain
from covlens.operators import normalize as N
from covlens.operators import store as ST
from covlens.operators.tagging import keyword_enrich
from covlens.sources import landing as L

TAXONOMY = Taxonomy.from_config({"topics": {"harbour": {"keywords": ["ferry", "quay"]}, "weather": {"keywords": ["storm"]}}})
DISCOVERY = [
    {"url": "https://news.tempo.co/ferry/1", "url_mobile": "", "title": "Night ferry returns to the old quay",
     "seendate": "20240105T063000Z", "socialimage": "", "domain": "news.tempo.co", "language": "English",
     "sourcecountry": "Norway", "rank": 3},
    {"url": "https://lantern.example.net/2", "url_mobile": "", "title": "A lamp for every street",
     "seendate": "20240106T000000Z", "socialimage": "", "domain": "lantern.example.net", "language": "English",
     "sourcecountry": "Norway"},
]
AGGREGATOR = [{"author": None, "title": "Laporan buruk", "description": "The harbour office and the ferry line yang baru.",
               "url": "https://gull.example.org/c", "source": "gull_daily", "image": None, "category": "general",
               "language": "en", "country": "no", "published_at": "2024-01-07T08:30:00+02:00"}]
FEEDS = {
    "tidewater_nasional": [{"title": "Storm closes the bridge", "link": "https://tidewater.example.com/d",
                            "published": "Mon, 08 Jan 2024 11:06:52 +0700", "summary": "Winds of force nine."}],
    "mill_terkini": [{"title": "Bread prices", "link": "https://mill.example.com/e",
                      "published": "Mon, 08 Jan 2024 09:00:00 +0700", "summary": "Flour is dearer. Kabar baik."}],
}
CHANNELS = {"pier_tv": [{"title": "Live from the quay", "link": "https://www.youtube.com/watch?v=pier0000001",
                         "published": "2024-01-09T10:00:00+00:00", "summary": "Boats, gulls and people.",
                         "video_id": "pier0000001", "_channel_name": "pier_tv", "_channel_id": "UCpier"}]}


def _hashes(platform, url, title, summary):
    return (hashlib.sha256(f"{platform}|{url}".encode()).hexdigest(),
            hashlib.sha256(f"{title[:200]}||{(summary or '')[:200]}".encode()).hexdigest())


EXPECTED = {  # platform, title, summary, publisher, domain, published, topics, sentiment, language
    "https://news.tempo.co/ferry/1": ("gdelt", "Night ferry returns to the old quay", None, "tempo", "news.tempo.co", "2024-01-05 06:30:00", ["harbour"], "neutral", None),
    "https://lantern.example.net/2": ("gdelt", "A lamp for every street", None, "example", "lantern.example.net", "2024-01-06 00:00:00", [], "neutral", None),
    "https://gull.example.org/c": ("mediastack", "Laporan buruk", AGGREGATOR[0]["description"], "gull_daily", "gull.example.org", "2024-01-07 06:30:00", ["harbour"], "negative", "id"),
    "https://tidewater.example.com/d": ("rss", "Storm closes the bridge", "Winds of force nine.", "tidewater", "tidewater.example.com", "2024-01-08 04:06:52", ["weather"], "neutral", None),
    "https://mill.example.com/e": ("rss", "Bread prices", "Flour is dearer. Kabar baik.", "mill", "mill.example.com", "2024-01-08 02:00:00", [], "positive", None),
    "https://www.youtube.com/watch?v=pier0000001": ("youtube", "Live from the quay", "Boats, gulls and people.", "pier_tv", "www.youtube.com", "2024-01-09 10:00:00", ["harbour"], "neutral", None),
}


def _write(d, name, obj):
    os.makedirs(os.path.join(d, name), exist_ok=True)
    with open(os.path.join(d, name, "payload.json"), "w", encoding="utf-8") as f:
        json.dump(obj, f, ensure_ascii=False)
    return os.path.join(d, name)


def _items(spark, d):
    at = F.lit("2026-01-23 00:00:00")
    gd = N.normalize_discovery(L.read_api_list(spark, _write(d, "gdelt", DISCOVERY)), at)
    arts, errs = L.read_aggregator_list(spark, _write(d, "mediastack", AGGREGATOR))
    assert errs.count() == 0
    ms = N.normalize_aggregator(arts, at)
    rs = N.normalize_feed(L.read_keyed_feeds(spark, _write(d, "rss", FEEDS)), at)
    yt = N.normalize_channel(L.read_keyed_feeds(spark, _write(d, "youtube", CHANNELS)), at)
    return N.union_sources(0, gdelt=gd, mediastack=ms, rss=rs, youtube=yt)


def test_six_items(spark, tmpdir_path):
    obs = _items(spark, tmpdir_path)
    tags = keyword_enrich(obs, TAXONOMY, F.lit("2026-01-23 00:00:00"))
    rows = obs.select("id", "url", "publisher_or_author", "title", "summary", "platform", "content_hash",
                      F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("pub"),
                      url_domain(F.col("url")).alias("domain")).join(tags, "id").collect()
    assert {r.url for r in rows} == set(EXPECTED) and len(rows) == 6
    for r in rows:
        platform, title, summary, publisher, domain, published, topics, sentiment, language = EXPECTED[r.url]
        assert (r.platform, r.title, r.summary, r.publisher_or_author, r.domain, r.pub) == (
            platform, title, summary, publisher, domain, published)
        assert (r.id, r.content_hash) == _hashes(platform, r.url, title, summary)
        assert (r.topics, r.sentiment, r.language, r.is_editorial) == (topics, sentiment, language, None), r.url


def test_same_url_in_two_feeds_of_one_document(spark, tmpdir_path):
    entry = {"link": "https://tidewater.example.com/x", "summary": "s", "published": "Mon, 08 Jan 2024 09:00:00 +0700"}
    feeds = {"zeta_one": [{**entry, "title": "First"}], "alpha_two": [{**entry, "title": "Second"}]}
    items = N.normalize_feed(L.read_keyed_feeds(spark, _write(tmpdir_path, "rss", feeds)), F.lit("2026-01-23 00:00:00"))
    obs = N.union_sources(0, rss=items)
    assert obs.select("seq").distinct().count() == 2
    row = ST.upsert_fold(obs).first()
    assert row.title == "Second" and json.loads(row.signals_json)["feed_name"] == "zeta_one"


def test_upsert_counts(spark, tmpdir_path):
    obs = _items(spark, tmpdir_path)
    snap = ST.upsert_fold(obs.withColumn("seq", F.col("seq")))
    assert snap.count() == 6
    _, stats = ST.upsert_batch(snap.drop("n_observations", "first_seq", "last_seq"), obs)
    r = stats.first()
    assert (r.inserted, r.updated) == (0, 6)
    empty = snap.limit(0)
    _, stats0 = ST.upsert_batch(empty, obs)
    r0 = stats0.first()
    assert (r0.inserted, r0.updated) == (6, 0)
