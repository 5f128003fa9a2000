"""Registered queries for scans, normalisers, source union and video
stats (S1-S6, N1-N4, U1, J1).  Payloads are derived from the test tables
by Spark (sources/derived.py); the oracles compute the expected normalised
rows straight from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.time import parse_compact_ts
from ..operators import normalize as N
from ..operators import store as ST
from ..sources import derived as D
from ..sources import landing as L
from . import oracle as O
from .queries import register

RUN_TS = "2024-01-31 00:00:00"

RAW = f"""WITH raw AS (
  SELECT d.doc_id, d.source, d.lang, substring(d.text, 1, 80) AS t_raw, substring(d.text, 81) AS s_raw,
    CASE d.doc_id % 4 WHEN 0 THEN 'rss' WHEN 1 THEN 'gdelt' WHEN 2 THEN 'mediastack' ELSE 'youtube' END AS platform,
    {O.url_sql('d.doc_id')} AS url,
    CASE WHEN d.doc_id % 17 <> 0 THEN e.ts END AS ts,
    CAST(floor(d.doc_id / 100) AS BIGINT) AS block
  FROM documents d LEFT JOIN {O.EVENT_TIMES} e ON e.doc_id = d.doc_id)
"""


def _pub_ts(c: str) -> str:
    return f"strftime(date_trunc('second', {c}), '%Y-%m-%d %H:%M:%S')"


def _channel_entries(spark, sf):
    k = L.parse_keyed_feeds(D.keyed_channel_payloads(spark, sf))
    x = L.parse_channel_xml(D.channel_xml_payloads(spark, sf), F.col("channel"), F.col("channel_ref"))
    return k.unionByName(x.select(*k.columns))


def _fmt(col):
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")


def _items_out(df):
    return df.select("id", "publisher_or_author", "url", "title", "summary",
                     _fmt(F.col("published_at")).alias("published"), "signals_json", "source_type", "content_hash",
                     F.get_json_object("raw_json", "$.title").alias("raw_title"),
                     F.get_json_object("raw_json", "$.id").alias("raw_id"))


def _own(source_type: str, summary: str, xml: str = "FALSE") -> str:
    """The remaining columns of `_items_out`; the raw payload's title and id
    (a field that no scan types) are as they landed, in XML documents
    (where `xml` holds) without surrounding white space."""
    return (f"'{source_type}' AS source_type, sha256(substring(coalesce({_ne('t_raw')}, ''), 1, 200) || '||' || "
            f"substring(coalesce({summary}, ''), 1, 200)) AS content_hash, "
            f"CASE WHEN {xml} THEN trim(t_raw, ' ' || chr(10) || chr(9) || chr(13)) ELSE t_raw END AS raw_title, 'ref-' || CAST(doc_id AS VARCHAR) AS raw_id")


def _ne(x: str) -> str:
    return f"NULLIF({O.clean_sql(x)}, '')"


@register("scan_api_list", RAW + """
SELECT url, t_raw AS title, strftime(ts, '%Y%m%dT%H%M%SZ') AS seendate FROM raw WHERE platform = 'gdelt'""")
def q_scan_api_list(spark, sf):
    """JSON array payloads -> articles."""
    a = L.parse_api_list(D.discovery_payloads(spark, sf))
    return a.select("url", "title", "seendate")


@register("scan_aggregator_list", RAW + """
SELECT url, CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN '  ' ELSE source END AS source,
  CASE WHEN doc_id % 3 <> 0 THEN 'au' || CAST(doc_id % 7 AS VARCHAR) END AS author,
  strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS published_at
FROM raw WHERE platform = 'mediastack'""")
def q_scan_aggregator_list(spark, sf):
    """Wrapped and bare aggregator payloads -> articles."""
    arts, _ = L.parse_aggregator_list(D.aggregator_payloads(spark, sf))
    return arts.select("url", "source", "author", "published_at")


@register("scan_keyed_feeds", RAW + """
SELECT source || '_nasional' AS feed_name, url AS link FROM raw WHERE platform = 'rss' AND block % 2 = 0""")
def q_scan_keyed_feeds(spark, sf):
    """S3: {feed: [entries]} payloads -> (feed_name, entry)."""
    k = L.parse_keyed_feeds(D.keyed_feed_payloads(spark, sf))
    return k.select("feed_name", F.col("entry")["link"].alias("link"))


@register("scan_feed_xml", RAW + """
SELECT source || '_nasional' AS feed_name, NULLIF(url, '') AS link, updated FROM (
  SELECT *, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS updated FROM raw) WHERE platform = 'rss' AND block % 2 = 1""")
def q_scan_feed_xml(spark, sf):
    """RSS 2.0 documents -> entries."""
    x = D.rss_xml_payloads(spark, sf)
    e = L.parse_feed_xml(x, F.col("feed_name"), F.col("feed_url"))
    return e.select("feed_name", F.col("entry")["link"].alias("link"), F.col("entry")["updated"].alias("updated"))


@register("scan_channel_feeds", RAW + """
SELECT source AS channel, 'https://www.youtube.com/watch?v=v' || CAST(doc_id AS VARCHAR) AS link,
  'v' || CAST(doc_id AS VARCHAR) AS video_id, 'UC' || source AS channel_id
FROM raw WHERE platform = 'youtube'""")
def q_scan_channel_feeds(spark, sf):
    """Atom and keyed JSON channel documents -> entries with video_id
    (F12) and channel id."""
    e = _channel_entries(spark, sf)
    return e.select(F.col("feed_name").alias("channel"), F.col("entry")["link"].alias("link"),
                    F.col("entry")["video_id"].alias("video_id"),
                    F.col("entry")["_channel_id"].alias("channel_id"))


@register("source_request_filter", RAW + """
SELECT url, published_at FROM (
  SELECT url, lang, t_raw, s_raw, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS published_at, ts FROM raw
  WHERE platform = 'mediastack')
WHERE lower(lang) IN ('en', 'fr') AND lower(coalesce(lang, '')) NOT IN ('de')
  AND (contains(lower(concat_ws(' ', t_raw, s_raw)), 'the') OR contains(lower(concat_ws(' ', t_raw, s_raw)), 'que'))
ORDER BY published_at DESC NULLS LAST, url LIMIT 60""")
def q_source_request_filter(spark, sf):
    """Languages 'en, fr, -de, id' (id is not supported -> dropped),
    keywords 'the que', page size 60, newest first."""
    arts, _ = L.parse_aggregator_list(D.aggregator_payloads(spark, sf))
    r = L.request_filter(arts, languages="en, fr, -de, id", keywords="the que", limit=60)
    return r.select("url", "published_at")


@register("discovery_request_filter", RAW + """
SELECT url, seendate FROM (
  SELECT url, lang, ts, strftime(ts, '%Y%m%dT%H%M%SZ') AS seendate FROM raw WHERE platform = 'gdelt')
WHERE lang = 'en' AND date_trunc('second', ts) >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 14 DAY""")
def q_discovery_request_filter(spark, sf):
    """The discovery API's timespan and source language."""
    arts = L.parse_api_list(D.discovery_payloads(spark, sf))
    return L.request_filter(arts, published_col="seendate", parse=parse_compact_ts, timespan="2w", sourcelang="en",
                            now=RUN_TS).select("url", "seendate")


@register("normalize_discovery", RAW + f"""
SELECT sha256('gdelt|' || url) AS id, 'example' AS publisher_or_author, url, {_ne('t_raw')} AS title,
  NULL::VARCHAR AS summary, {_pub_ts('ts')} AS published,
  to_json({{'domain': 'www.' || source || '.example.com', 'sourcecountry': 'ID', 'language': lang,
            'socialimage': '', 'url_mobile': ''}}) AS signals_json, {_own('news', 'NULL')}
FROM raw WHERE platform = 'gdelt'""")
def q_normalize_discovery(spark, sf):
    """N1 + F3 + F7."""
    return _items_out(N.normalize_discovery(L.parse_api_list(D.discovery_payloads(spark, sf)), F.lit(RUN_TS)))


@register("normalize_aggregator", RAW + f"""
SELECT sha256('mediastack|' || url) AS id,
  CASE doc_id % 5 WHEN 0 THEN CASE WHEN doc_id % 3 <> 0 THEN 'au' || CAST(doc_id % 7 AS VARCHAR) ELSE 'unknown' END
                  WHEN 1 THEN 'unknown' ELSE source END AS publisher_or_author,
  url, {_ne('t_raw')} AS title, {_ne('s_raw')} AS summary, {_pub_ts('ts')} AS published,
  to_json({{'category': 'general', 'country': 'id', 'language': lang, 'image': NULL::VARCHAR}}) AS signals_json,
  {_own('news', _ne('s_raw'))}
FROM raw WHERE platform = 'mediastack'""")
def q_normalize_aggregator(spark, sf):
    """N2 + F2 + F11."""
    arts, _ = L.parse_aggregator_list(D.aggregator_payloads(spark, sf))
    return _items_out(N.normalize_aggregator(arts, F.lit(RUN_TS)))


def _feed_entries(spark, sf):
    k = L.parse_keyed_feeds(D.keyed_feed_payloads(spark, sf))
    x = L.parse_feed_xml(D.rss_xml_payloads(spark, sf), F.col("feed_name"), F.col("feed_url"))
    return k.unionByName(x.select(*k.columns))


@register("normalize_feed", RAW + f"""
SELECT sha256('rss|' || url) AS id, source AS publisher_or_author, url, {_ne('t_raw')} AS title,
  {_ne('s_raw')} AS summary, {_pub_ts('ts')} AS published,
  to_json({{'feed_name': source || '_nasional', 'feed_url': 'https://' || source || '.example.com/rss'}}) AS signals_json,
  {_own('news', _ne('s_raw'), 'block % 2 = 1')}
FROM raw WHERE platform = 'rss'""")
def q_normalize_feed(spark, sf):
    """N3 + F2 (RFC 822 with offset, ISO fall-back) + F10; keyed JSON
    and RSS XML landings together."""
    return _items_out(N.normalize_feed(_feed_entries(spark, sf), F.lit(RUN_TS)))


_STATS = """stats AS (
  SELECT 'v' || CAST(event_id // 10 AS VARCHAR) AS video_id,
    count(*) FILTER (WHERE event_type = 'view') AS views,
    count(*) FILTER (WHERE event_type = 'click') AS likes,
    count(*) FILTER (WHERE event_type = 'signup') AS comments
  FROM events WHERE ts <= TIMESTAMP '""" + RUN_TS + """' GROUP BY 1)"""


@register("normalize_channel", RAW + ", " + _STATS + f"""
SELECT sha256('youtube|' || link) AS id, source AS publisher_or_author, link AS url, {_ne('t_raw')} AS title,
  {_ne('s_raw')} AS summary, {_pub_ts('ts')} AS published,
  '{{"channel_name":"' || source || '","channel_id":"UC' || source || '","video_id":"' || vid || '","metrics":'
    || CASE WHEN s.video_id IS NULL THEN '{{}}' ELSE '{{"views":' || s.views || ',"likes":' || s.likes
       || ',"comments":' || s.comments || '}}' END || '}}' AS signals_json, {_own('social', _ne('s_raw'), 'block % 2 = 1')}
FROM (SELECT *, 'v' || CAST(doc_id AS VARCHAR) AS vid,
        'https://www.youtube.com/watch?v=v' || CAST(doc_id AS VARCHAR) AS link FROM raw WHERE platform = 'youtube') r
LEFT JOIN stats s ON s.video_id = r.vid""")
def q_normalize_channel(spark, sf):
    """N4 + J1: channel entries with their video metrics."""
    e = _channel_entries(spark, sf)
    return _items_out(N.normalize_channel(e, F.lit(RUN_TS), D.video_stats(spark, sf)))


@register("video_stats_join", RAW + ", " + _STATS + """
SELECT 'v' || CAST(doc_id AS VARCHAR) AS video_id, coalesce(s.views, 0) AS views,
  coalesce(s.likes, 0) AS likes, coalesce(s.comments, 0) AS comments
FROM raw r LEFT JOIN stats s ON s.video_id = 'v' || CAST(r.doc_id AS VARCHAR) WHERE r.platform = 'youtube'""")
def q_video_stats_join(spark, sf):
    """Video id -> counts, missing -> 0."""
    e = _channel_entries(spark, sf)
    j = N.video_stats_join(e, D.video_stats(spark, sf), F.lit(RUN_TS))
    m = F.col("metrics")
    return j.select(F.col("entry")["video_id"].alias("video_id"),
                    F.coalesce(m["views"], F.lit(0)).cast("long").alias("views"),
                    F.coalesce(m["likes"], F.lit(0)).cast("long").alias("likes"),
                    F.coalesce(m["comments"], F.lit(0)).cast("long").alias("comments"))


def all_sources(spark, sf):
    """The four normalised sources of one ingest cycle, in order."""
    arts, _ = L.parse_aggregator_list(D.aggregator_payloads(spark, sf))
    ce = _channel_entries(spark, sf)
    return N.union_sources(
        0,
        gdelt=N.normalize_discovery(L.parse_api_list(D.discovery_payloads(spark, sf)), F.lit(RUN_TS)),
        mediastack=N.normalize_aggregator(arts, F.lit(RUN_TS)),
        rss=N.normalize_feed(_feed_entries(spark, sf), F.lit(RUN_TS)),
        youtube=N.normalize_channel(ce, F.lit(RUN_TS), D.video_stats(spark, sf)))


@register("union_sources", RAW + """
, u AS (
  SELECT platform, CASE WHEN platform = 'youtube' THEN 'https://www.youtube.com/watch?v=v' || CAST(doc_id AS VARCHAR)
                        ELSE url END AS url FROM raw)
SELECT platform, count(*) AS n_rows, count(DISTINCT sha256(platform || '|' || url)) AS n_ids FROM u GROUP BY platform""")
def q_union_sources(spark, sf):
    """All sources unioned; rows and distinct ids per platform."""
    u = all_sources(spark, sf)
    return u.groupBy("platform").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("id").alias("n_ids"))


@register("union_source_rows", RAW + """
, u AS (
  SELECT platform, CASE WHEN platform = 'youtube' THEN 'https://www.youtube.com/watch?v=v' || CAST(doc_id AS VARCHAR)
                        ELSE url END AS url FROM raw)
SELECT platform, url, sha256(platform || '|' || url) AS id FROM u""")
def q_union_source_rows(spark, sf):
    """The rows of all sources, repeats included."""
    return all_sources(spark, sf).select("platform", "url", "id")


@register("ingest_cycle", RAW + """
, u AS (
  SELECT platform, CASE WHEN platform = 'youtube' THEN 'https://www.youtube.com/watch?v=v' || CAST(doc_id AS VARCHAR)
                        ELSE url END AS url FROM raw),
  per AS (SELECT platform AS source, count(*) AS raw, count(DISTINCT sha256(platform || '|' || url)) AS inserted
          FROM u GROUP BY platform)
SELECT source, raw, inserted, raw - inserted AS updated FROM per
UNION ALL SELECT 'TOTAL', sum(raw)::BIGINT, sum(inserted)::BIGINT, (sum(raw) - sum(inserted))::BIGINT FROM per""")
def q_ingest_cycle(spark, sf):
    """U1 + T1 + S9: one full ingest cycle into an empty store: per source
    raw / inserted / updated, and the TOTAL row."""
    return ST.ingest_stats(all_sources(spark, sf), None)
