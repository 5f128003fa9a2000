"""Registered queries: one per operator, each runnable on the whole test
tables, each with its DuckDB oracle (where SQL can express it).

Every query reads the test tables (or what Spark derives from them), so
its work grows with the data; none runs on fixed inline input."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import TEST_REPORT as P
from ..functions.time import coverage_day
from ..operators import analytics as A
from ..operators.clusters import duplicate_clusters
from ..operators import filters as PF
from ..operators import store as ST
from ..sources.binding import media_items, observations
from . import oracle as O

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query.  Every query runs with the session zone pinned to
    UTC: stored instants are UTC and day buckets are UTC days."""
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


W = O.with_binding


def _items(spark, sf):
    return media_items(spark, sf)


# ---------------------------------------------------------------------------
# Binding, upsert, keyed state
# ---------------------------------------------------------------------------
@register("item_binding", W("""
SELECT seq, id, platform, source_type, publisher_or_author, url, title, summary,
       strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published, language, sentiment, content_hash
FROM obs"""))
def q_item_binding(spark, sf):
    """N5 + F4/F5/F8/F9: the normalised observation rows."""
    o = observations(spark, sf)
    return o.select("seq", "id", "platform", "source_type", "publisher_or_author", "url", "title",
                    "summary", F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published"),
                    "language", "sentiment", "content_hash")


@register("upsert_items", W("""
SELECT id, platform, url, title, summary, strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published,
       content_hash, sentiment, language, array_to_string(topics, ',') AS topics,
       n_observations, first_seq, last_seq
FROM items"""))
def q_upsert_items(spark, sf):
    """First observation gives protected fields, last gives the rest."""
    m = _items(spark, sf)
    return m.select("id", "platform", "url", "title", "summary",
                    F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published"),
                    "content_hash", "sentiment", "language", F.array_join("topics", ",").alias("topics"),
                    "n_observations", "first_seq", "last_seq")


@register("upsert_batch", W("""
, snap AS (SELECT DISTINCT id FROM obs WHERE batch_id < 2),
  bat AS (SELECT * FROM obs WHERE batch_id >= 2)
SELECT count(DISTINCT CASE WHEN s.id IS NULL THEN b.id END) AS inserted,
       count(*) - count(DISTINCT CASE WHEN s.id IS NULL THEN b.id END) AS updated
FROM bat b LEFT JOIN snap s ON s.id = b.id""".replace("\n, snap", ", snap", 1)))
def q_upsert_batch(spark, sf):
    """T1 incremental: batches 2.. of the log upserted into the snapshot
    folded from batches 0-1; (inserted, updated) as the reference counts."""
    o = observations(spark, sf)
    snap = ST.upsert_fold(o.filter(F.col("batch_id") < 2))
    _, stats = ST.upsert_batch(snap, o.filter(F.col("batch_id") >= 2))
    return stats


@register("upsert_batch_snapshot", W("""
, s AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq) AS f,
               row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS l FROM obs WHERE batch_id < 2),
  b AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq) AS f,
               row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS l FROM obs WHERE batch_id >= 2),
  ids AS (SELECT id FROM s UNION SELECT id FROM b)
SELECT ids.id,
  CASE WHEN bl.id IS NOT NULL THEN bl.title ELSE sl.title END AS title,
  CASE WHEN bl.id IS NOT NULL THEN bl.summary ELSE sl.summary END AS summary,
  CASE WHEN bl.id IS NOT NULL THEN bl.publisher_or_author ELSE sl.publisher_or_author END AS publisher,
  strftime(CASE WHEN bl.id IS NOT NULL THEN bl.published_at ELSE sl.published_at END, '%Y-%m-%d %H:%M:%S') AS published,
  CASE WHEN sf.id IS NOT NULL THEN sf.content_hash ELSE bf.content_hash END AS content_hash,
  CASE WHEN sf.id IS NOT NULL THEN sf.sentiment ELSE bf.sentiment END AS sentiment,
  CASE WHEN sf.id IS NOT NULL THEN sf.language ELSE bf.language END AS language
FROM ids LEFT JOIN s sf ON sf.id = ids.id AND sf.f = 1 LEFT JOIN s sl ON sl.id = ids.id AND sl.l = 1
  LEFT JOIN b bf ON bf.id = ids.id AND bf.f = 1 LEFT JOIN b bl ON bl.id = ids.id AND bl.l = 1""".replace("\n, s AS", ", s AS", 1)))
def q_upsert_batch_snapshot(spark, sf):
    """T1 incremental: the merged snapshot's rows."""
    o = observations(spark, sf)
    snap, _ = ST.upsert_batch(ST.upsert_fold(o.filter(F.col("batch_id") < 2)), o.filter(F.col("batch_id") >= 2))
    return snap.select("id", "title", "summary", F.col("publisher_or_author").alias("publisher"),
                       F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published"),
                       "content_hash", "sentiment", "language")


@register("ingest_stats", W("""
, per AS (
  SELECT platform AS source, count(*) AS raw, count(DISTINCT id) AS inserted FROM obs GROUP BY platform)
SELECT source, raw, inserted, raw - inserted AS updated FROM per
UNION ALL
SELECT 'TOTAL', sum(raw)::BIGINT, sum(inserted)::BIGINT, (sum(raw) - sum(inserted))::BIGINT FROM per""".replace("\n, per", ", per", 1)))
def q_ingest_stats(spark, sf):
    """Per source raw/inserted/updated of a first ingest, plus TOTAL."""
    return ST.ingest_stats(observations(spark, sf), None)


@register("latest_per_id", W("""
SELECT id, seq, title FROM b_last WHERE rn = 1"""))
def q_latest_per_id(spark, sf):
    """Last write wins per id."""
    o = observations(spark, sf).select("id", "seq", "title")
    return ST.latest_per_key(o, "id", "seq")


# ---------------------------------------------------------------------------
# Filters
# ---------------------------------------------------------------------------
@register("items_since", W(f"""
SELECT id, strftime(published_at, '%Y-%m-%d') AS day FROM items
WHERE published_at >= TIMESTAMP '{O.PREV}'"""))
def q_items_since(spark, sf):
    """published_at >= now - 2 windows."""
    _, _, prev = A.window_bounds(P)
    return PF.items_since(_items(spark, sf), prev).select(
        "id", F.date_format("published_at", "yyyy-MM-dd").alias("day"))


@register("items_by_platform", W("SELECT id, url FROM items WHERE platform = 'rss'"))
def q_items_by_platform(spark, sf):
    """P2."""
    return PF.items_by_platform(_items(spark, sf), "rss").select("id", "url")


@register("items_by_publisher", W("SELECT id, url FROM items WHERE publisher_or_author = 'src3'"))
def q_items_by_publisher(spark, sf):
    """P3."""
    return PF.items_by_publisher(_items(spark, sf), "src3").select("id", "url")


@register("items_topics_any", W("""
SELECT id, array_to_string(topics, ',') AS topics FROM items
WHERE list_has_any(coalesce(topics, []::VARCHAR[]), ['license', 'german'])"""))
def q_items_topics_any(spark, sf):
    """Any of the listed topics."""
    return PF.items_topics_any(_items(spark, sf), ["license", "german"]).select(
        "id", F.array_join("topics", ",").alias("topics"))


@register("query_items", W(f"""
SELECT id, strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published FROM (
  SELECT * FROM items
  WHERE published_at >= TIMESTAMP '{O.PREV}' AND platform = 'gdelt'
  ORDER BY published_at DESC NULLS LAST, id LIMIT 40)
WHERE list_has_any(coalesce(topics, []::VARCHAR[]), ['english'])"""))
def q_query_items(spark, sf):
    """P5: since + platform, then the row limit (the feature), then the
    topic filter, which runs after the limit as in the reference."""
    _, _, prev = A.window_bounds(P)
    r = PF.query_items(_items(spark, sf), since=prev, platform="gdelt", topics_any=["english"], limit=40)
    return r.select("id", F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published"))


@register("valid_sentiment", W("""
SELECT id, CASE WHEN lower(trim(coalesce(sentiment, ''))) IN ('positive', 'neutral', 'negative')
                THEN lower(trim(sentiment)) END AS sentiment FROM items"""))
def q_valid_sentiment(spark, sf):
    """P7 + F17."""
    from ..functions.scoring import valid_sentiment
    return _items(spark, sf).select("id", valid_sentiment(F.col("sentiment")).alias("sentiment"))


@register("has_url_known_day", W("""
SELECT id, strftime(coalesce(published_at, ingested_at), '%Y-%m-%d') AS day FROM items
WHERE coalesce(url, '') <> ''"""))
def q_has_url_known_day(spark, sf):
    """P8 + P9 + F15."""
    m = PF.known_day(PF.has_url(_items(spark, sf)))
    return m.select("id", coverage_day(F.col("published_at"), F.col("ingested_at")).alias("day"))


# ---------------------------------------------------------------------------
# Report analytics
# ---------------------------------------------------------------------------
@register("two_windows", W("""
SELECT id, CASE WHEN is_current THEN 'current' ELSE 'previous' END AS window_name FROM win"""))
def q_two_windows(spark, sf):
    """W1."""
    w = A.two_windows(_items(spark, sf), P)
    return w.select("id", F.when(F.col("is_current"), "current").otherwise("previous").alias("window_name"))


@register("mentions_total", W("""
SELECT count(*) FILTER (WHERE is_current) AS n_mentions,
       count(*) FILTER (WHERE NOT is_current) AS n_prev_mentions FROM win"""))
def q_mentions_total(spark, sf):
    """A1."""
    return A.mentions_total(_items(spark, sf), P)


_DELTA = """CASE WHEN n_prev_mentions > 0
     THEN CAST(n_mentions - n_prev_mentions AS DOUBLE) / CAST(n_prev_mentions AS DOUBLE) ELSE 0.0 END"""


@register("mention_delta", W(f"""
SELECT n_mentions, n_prev_mentions, {_DELTA} AS mention_delta FROM (
  SELECT count(*) FILTER (WHERE is_current) AS n_mentions,
         count(*) FILTER (WHERE NOT is_current) AS n_prev_mentions FROM win)"""))
def q_mention_delta(spark, sf):
    """A2."""
    return A.mention_delta(_items(spark, sf), P)


@register("by_publisher", W(O.top_k_sql("cur", "publisher", 15)))
def q_by_publisher(spark, sf):
    """A3 + T3."""
    return A.by_publisher(_items(spark, sf), P)


@register("by_domain", W(O.top_k_sql("cur", "domain", 15)))
def q_by_domain(spark, sf):
    """A4 + F14."""
    return A.by_domain(_items(spark, sf), P)


@register("by_platform", W(O.top_k_sql("cur", "platform", None)))
def q_by_platform(spark, sf):
    """A5."""
    return A.by_platform(_items(spark, sf), P)


@register("by_topic", W(", t AS (SELECT unnest(topics) AS topic FROM cur)\n" + O.top_k_sql("t", "topic", 30)))
def q_by_topic(spark, sf):
    """Every occurrence counts."""
    return A.by_topic(_items(spark, sf), P)


@register("by_actor", W(", t AS (SELECT unnest(actors) AS actor FROM cur)\n" + O.top_k_sql("t", "actor", 25)))
def q_by_actor(spark, sf):
    """A7."""
    return A.by_actor(_items(spark, sf), P)


_LAST_DAYS = """d AS (
  SELECT day, count(*) AS n,
    count(*) FILTER (WHERE sent = 'positive') AS positive,
    count(*) FILTER (WHERE sent = 'neutral') AS neutral,
    count(*) FILTER (WHERE sent = 'negative') AS negative
  FROM cur WHERE day IS NOT NULL GROUP BY day ORDER BY day DESC LIMIT 31)"""


@register("by_day", W(", " + _LAST_DAYS + "\nSELECT day, n FROM d"))
def q_by_day(spark, sf):
    """The last 31 known days."""
    return A.by_day(_items(spark, sf), P)


@register("sentiment_totals", W("""
, s AS (SELECT count(*) FILTER (WHERE sent = 'positive') AS p, count(*) FILTER (WHERE sent = 'neutral') AS u,
               count(*) FILTER (WHERE sent = 'negative') AS g FROM cur),
  r AS (SELECT 'positive' AS label, p AS n, p + u + g AS scored FROM s
        UNION ALL SELECT 'neutral', u, p + u + g FROM s
        UNION ALL SELECT 'negative', g, p + u + g FROM s)
SELECT label, n, CAST(n AS DOUBLE) / CAST(scored AS DOUBLE) AS share FROM r WHERE scored > 0""".replace("\n, s AS", ", s AS", 1)))
def q_sentiment_totals(spark, sf):
    """A9 + F18."""
    return A.sentiment_totals(_items(spark, sf), P)


@register("sentiment_by_publisher", W("""
, g AS (SELECT publisher, count(*) AS n,
          count(*) FILTER (WHERE sent = 'positive') AS positive,
          count(*) FILTER (WHERE sent = 'neutral') AS neutral,
          count(*) FILTER (WHERE sent = 'negative') AS negative
        FROM cur GROUP BY publisher ORDER BY n DESC, publisher LIMIT 15),
  r AS (SELECT CAST(row_number() OVER (ORDER BY n DESC, publisher) AS BIGINT) AS rank, * FROM g)
SELECT rank, publisher, positive, neutral, negative, positive + neutral + negative AS n_scored
FROM r WHERE positive + neutral + negative > 0""".replace("\n, g AS", ", g AS", 1)))
def q_sentiment_by_publisher(spark, sf):
    """A10."""
    return A.sentiment_by_publisher(_items(spark, sf), P)


@register("sentiment_by_topic", W("""
, e AS (SELECT unnest(topics) AS topic, sent FROM cur),
  g AS (SELECT topic, count(*) AS n,
          count(*) FILTER (WHERE sent = 'positive') AS positive,
          count(*) FILTER (WHERE sent = 'neutral') AS neutral,
          count(*) FILTER (WHERE sent = 'negative') AS negative
        FROM e GROUP BY topic ORDER BY n DESC, topic LIMIT 15),
  r AS (SELECT CAST(row_number() OVER (ORDER BY n DESC, topic) AS BIGINT) AS rank, * FROM g)
SELECT rank, topic, positive, neutral, negative FROM r
WHERE (SELECT count(*) FROM e WHERE sent IS NOT NULL) > 0""".replace("\n, e AS", ", e AS", 1)))
def q_sentiment_by_topic(spark, sf):
    """The flagship topic x sentiment table."""
    return A.sentiment_by_topic(_items(spark, sf), P)


@register("sentiment_by_day", W(", " + _LAST_DAYS + """
SELECT day, positive, neutral, negative, positive + neutral + negative AS n_scored FROM d
WHERE (SELECT count(*) FROM cur WHERE sent IS NOT NULL) > 0"""))
def q_sentiment_by_day(spark, sf):
    """A12."""
    return A.sentiment_by_day(_items(spark, sf), P)


_CRIT = ", ".join(O.q(t) for t in O.CRITICAL)


@register("critical_topics", W(f"""
, e AS (SELECT unnest(topics) AS topic FROM cur)
SELECT topic, count(*) AS n FROM e WHERE topic IN ({_CRIT}) GROUP BY topic""".replace("\n, e AS", ", e AS", 1)))
def q_critical_topics(spark, sf):
    """J6."""
    return A.critical_topics(_items(spark, sf), P)


@register("health_risk", W(f"""
, m AS (SELECT count(*) FILTER (WHERE is_current) AS n_mentions,
               count(*) FILTER (WHERE NOT is_current) AS n_prev_mentions FROM win),
  c AS (SELECT count(DISTINCT topic) AS critical_issue_count FROM (SELECT unnest(topics) AS topic FROM cur)
        WHERE topic IN ({_CRIT})),
  d AS (SELECT *, {_DELTA} AS mention_delta FROM m, c),
  s AS (SELECT *,
    (CASE WHEN critical_issue_count >= 2 THEN 2 WHEN critical_issue_count = 1 THEN 1 ELSE 0 END
     + CASE WHEN mention_delta > 0.50 THEN 1 ELSE 0 END) AS points,
    80 - 10 * critical_issue_count - CASE WHEN mention_delta > 0.50 THEN 5 ELSE 0 END
       - CASE WHEN mention_delta < -0.30 THEN 3 ELSE 0 END AS health FROM d)
SELECT n_mentions, n_prev_mentions, critical_issue_count, mention_delta,
  CAST(greatest(0, least(100, health)) AS BIGINT) AS health_score,
  CASE WHEN mention_delta > 0.10 THEN 'Improving' WHEN mention_delta < -0.10 THEN 'Declining' ELSE 'Stable' END AS reputation,
  CASE WHEN points >= 3 THEN 'High' WHEN points = 2 THEN 'Medium' ELSE 'Low' END AS risk
FROM s""".replace("\n, m AS", ", m AS", 1)))
def q_health_risk(spark, sf):
    """A13 + F19."""
    return A.health_risk(_items(spark, sf), P)


@register("cross_platform_dup", W("""
, g AS (
  SELECT 'url' AS key_type, url AS key, count(*) AS n_items, list_sort(list(DISTINCT platform)) AS pl,
         arg_min(id, (ingested_at, id)) AS keep_id
  FROM items WHERE coalesce(url, '') <> '' GROUP BY url
  UNION ALL
  SELECT 'content_hash', content_hash, count(*), list_sort(list(DISTINCT platform)),
         arg_min(id, (ingested_at, id))
  FROM items WHERE coalesce(content_hash, '') <> '' GROUP BY content_hash)
SELECT key_type, key, n_items, CAST(len(pl) AS BIGINT) AS n_platforms, array_to_string(pl, ',') AS platforms, keep_id
FROM g WHERE n_items > 1""".replace("\n, g AS", ", g AS", 1)))
def q_cross_platform_dup(spark, sf):
    """A14."""
    return A.cross_platform_dup(_items(spark, sf))


@register("duplicate_clusters", "WITH RECURSIVE " + W("""
, e AS (SELECT DISTINCT 'u:' || url AS u, 'h:' || content_hash AS h FROM items
        WHERE coalesce(url, '') <> '' AND coalesce(content_hash, '') <> ''),
  e2 AS (SELECT u AS a, h AS b FROM e UNION SELECT h, u FROM e),
  reach(node, r) AS (SELECT a, a FROM e2 UNION SELECT e2.b, reach.r FROM reach JOIN e2 ON e2.a = reach.node),
  comp AS (SELECT node, min(r) AS root FROM reach GROUP BY node),
  placed AS (SELECT i.id, i.platform, i.ingested_at, coalesce(c.root, i.node) AS root
             FROM (SELECT *, coalesce('u:' || nullif(url, ''), 'h:' || nullif(content_hash, ''), 'i:' || id) AS node FROM items) i
             LEFT JOIN comp c USING (node)),
  g AS (SELECT root, arg_min(id, (ingested_at, id)) AS keep_id, count(*) AS n_items, count(DISTINCT platform) AS n_platforms
        FROM placed GROUP BY root)
SELECT id, keep_id, id = keep_id AS kept, n_items, n_platforms FROM placed JOIN g USING (root)""").lstrip().removeprefix("WITH "))
def q_duplicate_clusters(spark, sf):
    """A14 over both keys: one group id per item."""
    return duplicate_clusters(_items(spark, sf))


@register("key_metrics", W(f"""
, m AS (SELECT count(*) FILTER (WHERE is_current) AS n_mentions,
               count(*) FILTER (WHERE NOT is_current) AS n_prev_mentions FROM win),
  tt AS (SELECT topic FROM (SELECT unnest(topics) AS topic FROM cur) GROUP BY topic ORDER BY count(*) DESC, topic LIMIT 1),
  tp AS (SELECT publisher FROM cur GROUP BY publisher ORDER BY count(*) DESC, publisher LIMIT 1)
SELECT n_mentions, n_prev_mentions, {_DELTA} AS mention_delta,
       coalesce((SELECT topic FROM tt), 'coverage') AS top_topic,
       coalesce((SELECT publisher FROM tp), 'unknown') AS top_publisher
FROM m""".replace("\n, m AS", ", m AS", 1)))
def q_key_metrics(spark, sf):
    """A15."""
    return A.key_metrics(_items(spark, sf), P)


@register("summary_tables", W(f"""
, c AS (SELECT * FROM items WHERE published_at >= TIMESTAMP '{O.SINCE}'),
  pl AS ({O.top_k_sql('c', 'platform', None)}),
  pb AS ({O.top_k_sql("(SELECT coalesce(NULLIF(publisher_or_author, ''), 'unknown') AS pubk FROM c)", 'pubk', 20)}),
  tp AS ({O.top_k_sql("(SELECT unnest(topics) AS tk FROM c)", 'tk', 30)})
SELECT 'by_platform' AS table_name, rank, platform AS key, n FROM pl
UNION ALL SELECT 'top_publishers', rank, pubk, n FROM pb
UNION ALL SELECT 'topic_counts', rank, tk, n FROM tp
UNION ALL SELECT 'total', CAST(0 AS BIGINT), 'total', count(*) FROM c""".replace("\n, c AS", ", c AS", 1)))
def q_summary_tables(spark, sf):
    """A16 over the current window (the report appendix)."""
    return A.summary_tables(A.current_items(_items(spark, sf), P))


@register("rollup_once", W("""
SELECT 'publisher' AS grouping_set, publisher AS key1, NULL::VARCHAR AS key2, count(*) AS n FROM cur GROUP BY publisher
UNION ALL SELECT 'domain', domain, NULL, count(*) FROM cur GROUP BY domain
UNION ALL SELECT 'day', day, NULL, count(*) FROM cur GROUP BY day
UNION ALL SELECT 'platform', platform, NULL, count(*) FROM cur GROUP BY platform
UNION ALL SELECT 'sentiment', sent, NULL, count(*) FROM cur GROUP BY sent
UNION ALL SELECT 'publisher_sentiment', publisher, sent, count(*) FROM cur GROUP BY publisher, sent
UNION ALL SELECT 'day_sentiment', day, sent, count(*) FROM cur GROUP BY day, sent"""))
def q_rollup_once(spark, sf):
    """All non-exploded counts from one Expand + aggregate."""
    return A.rollup_once(_items(spark, sf), P)


@register("seed_urls", W(f"""
, e AS (SELECT DISTINCT id, url, published_at, unnest(list_distinct(topics)) AS topic FROM cur WHERE coalesce(url, '') <> ''),
  r AS (SELECT topic, url, row_number() OVER (PARTITION BY topic ORDER BY published_at DESC NULLS LAST, id) AS r FROM e),
  d AS (SELECT topic, url, min(r) AS r FROM r WHERE r <= {P.max_urls} GROUP BY topic, url)
SELECT topic, CAST(row_number() OVER (PARTITION BY topic ORDER BY r) AS BIGINT) AS rank, url FROM d""".replace("\n, e AS", ", e AS", 1)))
def q_seed_urls(spark, sf):
    """W2 + U2."""
    return A.seed_urls(_items(spark, sf), P)


@register("dedup_urls", W("""
, e AS (SELECT DISTINCT id, url, published_at, unnest(list_distinct(topics)) AS topic FROM cur WHERE coalesce(url, '') <> '')
SELECT topic, url, strftime(max(published_at), '%Y-%m-%d %H:%M:%S') AS newest_at FROM e GROUP BY topic, url""".replace("\n, e AS", ", e AS", 1)))
def q_dedup_urls(spark, sf):
    """Order-preserving distinct URLs per topic over the window."""
    d = A.dedup_urls(_items(spark, sf), P)
    return d.select("topic", "url", F.date_format("newest_at", "yyyy-MM-dd HH:mm:ss").alias("newest_at"))


@register("top_key_restrict", W("""
, b AS (SELECT publisher, language, count(*) AS n FROM (SELECT *, coalesce(NULLIF(publisher_or_author, ''), 'unknown') AS publisher FROM items) GROUP BY publisher, language),
  t AS (SELECT publisher, sum(n) AS key_total FROM b GROUP BY publisher ORDER BY key_total DESC, publisher LIMIT 15),
  r AS (SELECT CAST(row_number() OVER (ORDER BY key_total DESC, publisher) AS BIGINT) AS key_rank, * FROM t)
SELECT b.publisher, b.language, b.n, r.key_rank, CAST(r.key_total AS BIGINT) AS key_total FROM b JOIN r USING (publisher)""".replace("\n, b AS", ", b AS", 1)))
def q_top_key_restrict(spark, sf):
    """Publisher x language restricted to the 15 biggest publishers."""
    m = _items(spark, sf)
    b = (m.select(F.coalesce(F.when(F.col("publisher_or_author") != "", F.col("publisher_or_author")),
                             F.lit("unknown")).alias("publisher"), "language")
         .groupBy("publisher", "language").agg(F.count(F.lit(1)).alias("n")))
    r = A.restrict_to_top(b, "publisher", 15)
    return r.select("publisher", "language", "n", "key_rank", F.col("key_total").cast("long").alias("key_total"))


# Register the remaining query families (import for side effects).
from . import queries_sources  # noqa: E402,F401
from . import queries_enrich  # noqa: E402,F401


def _sub(name: str, select: str) -> str:
    """Wrap a registered oracle as a subquery feeding a long-row select."""
    return f"SELECT {select} FROM ({ORACLES[name]})"


def _report_sql() -> str:
    d = "CAST({} AS DOUBLE)"
    parts = [
        _sub("health_risk", f"'health' AS section, CAST(1 AS BIGINT) AS rank, 'health_score' AS key, 'value' AS metric, {d.format('health_score')} AS value"),
        _sub("health_risk", "'health', 2, reputation, 'reputation', NULL"),
        _sub("health_risk", "'health', 3, risk, 'risk', NULL"),
        _sub("health_risk", f"'health', 4, 'alerts', 'critical_issue_count', {d.format('critical_issue_count')}"),
        _sub("key_metrics", f"'key_metrics', 1, 'mentions', 'n', {d.format('n_mentions')}"),
        _sub("key_metrics", f"'key_metrics', 1, 'mentions', 'n_prev', {d.format('n_prev_mentions')}"),
        _sub("key_metrics", "'key_metrics', 1, 'mentions', 'delta', mention_delta"),
        _sub("key_metrics", "'key_metrics', 2, top_topic, 'top_topic', NULL"),
        _sub("key_metrics", "'key_metrics', 3, top_publisher, 'top_publisher', NULL"),
        _sub("by_publisher", f"'top_publishers', rank, publisher, 'articles', {d.format('n')}"),
        _sub("by_topic", f"'topic_counts', rank, topic, 'articles', {d.format('n')}"),
        _sub("by_day", f"'coverage_over_time', 0, day, 'mentions', {d.format('n')}"),
        _sub("sentiment_totals", f"'sentiment', 0, label, 'count', {d.format('n')}"),
        _sub("sentiment_totals", "'sentiment', 0, label, 'share', share"),
    ]
    for m in ("positive", "neutral", "negative", "n_scored"):
        parts.append(_sub("sentiment_by_publisher", f"'sentiment_by_publisher', rank, publisher, '{m}', {d.format(m)}"))
        parts.append(_sub("sentiment_by_day", f"'sentiment_over_time', 0, day, '{m}', {d.format(m)}"))
    for m in ("positive", "neutral", "negative"):
        parts.append(_sub("sentiment_by_topic", f"'topic_sentiment', rank, topic, '{m}', {d.format(m)}"))
    parts += [
        _sub("by_domain", f"'top_domains', rank, domain, 'articles', {d.format('n')}"),
        _sub("by_actor", f"'top_actors', rank, actor, 'mentions', {d.format('n')}"),
        _sub("seed_urls", "'seed_urls', rank, url, 'topic:' || topic, NULL"),
        _sub("summary_tables", f"'appendix', rank, table_name || ':' || key, 'items', {d.format('n')}"),
    ]
    return "\nUNION ALL\n".join(parts)


@register("report_rows", _report_sql())
def q_report_rows(spark, sf):
    """The whole report as (section, rank, key, metric, value)."""
    from .report import report_rows
    return report_rows(_items(spark, sf), P)
from . import queries_streaming  # noqa: E402,F401
