"""Coverage analytics over the item snapshot: two windows (W1), volume,
publisher, domain, platform, topic, actor and day rollups (A1-A12), health
and risk (A13), duplicate groups (A14), key metrics (A15), summary tables
(A16), the one-pass rollup (A17), seed URLs per topic (W2/U2), critical
topics (J6), top-key restriction (J7) and top-k (T3).

Everything is an aggregation with map-side partial aggregation; top-k
uses orderBy+limit (TakeOrderedAndProject), per-group top-k uses
row_number <= k (WindowGroupLimit, applied before the shuffle as well)."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import (APPENDIX_PUBLISHERS, APPENDIX_TOPICS, CRITICAL_COST, DECLINING, HEALTH_BASE, HIGH_RISK_POINTS,
                      IMPROVING, LAST_DAYS, MEDIUM_RISK_POINTS, SENTIMENT_LABELS, SLUMP, SLUMP_COST, SURGE,
                      SURGE_COST, TOP_ACTORS, TOP_DOMAINS, TOP_PUBLISHERS, TOP_SENTIMENT_KEYS, TOP_TOPICS,
                      ReportParams)
from ..functions.scoring import clamp, valid_sentiment
from ..functions.text import url_domain
from ..functions.time import coverage_day
from .filters import ts_lit

POS, NEU, NEG = SENTIMENT_LABELS


def window_bounds(p: ReportParams) -> tuple[datetime, datetime, datetime]:
    now = datetime.fromisoformat(p.now)
    return now, now - timedelta(days=p.days), now - timedelta(days=2 * p.days)


def two_windows(items: DataFrame, p: ReportParams) -> DataFrame:
    """Rows with published_at >= now-2d, tagged current (>= now-d; no
    upper bound, so future-dated rows are current) or previous.  Adds the
    report keys once: publisher, domain, day, valid sentiment."""
    if "is_current" in items.columns:  # already a window slice
        return items
    _, since, prev = window_bounds(p)
    w = items.filter(F.col("published_at") >= ts_lit(prev))
    if "published_date" in items.columns:  # a written snapshot: prune date partitions
        w = w.filter(F.col("published_date") >= F.lit(prev.date()))
    return w.select(
        "id", "platform", "url", "topics", "actors", "published_at", "ingested_at",
        (F.col("published_at") >= ts_lit(since)).alias("is_current"),
        F.coalesce(F.when(F.col("publisher_or_author") != "", F.col("publisher_or_author")),
                   F.lit("unknown")).alias("publisher"),
        url_domain(F.col("url")).alias("domain"),
        coverage_day(F.col("published_at"), F.col("ingested_at")).alias("day"),
        valid_sentiment(F.col("sentiment")).alias("sent"),
    )


def current(items: DataFrame, p: ReportParams) -> DataFrame:
    return two_windows(items, p).filter("is_current")


def current_items(items: DataFrame, p: ReportParams) -> DataFrame:
    """The current-window slice with the item columns unchanged."""
    if "is_current" in items.columns:
        return items.filter("is_current")
    _, since, _ = window_bounds(p)
    return items.filter(F.col("published_at") >= ts_lit(since))


def top_k(counts: DataFrame, key: str, n: str = "n", k: int | None = None,
          rank: str = "rank") -> DataFrame:
    """Most common first, ties by key ascending, with a 1-based rank.
    The sort+limit plans a TakeOrderedAndProject; the rank window then runs
    over at most k rows.  k=None (rank every key) is only for key sets that
    are small by construction (platforms): the rank needs one partition."""
    ordered = counts.orderBy(F.col(n).desc(), F.col(key).asc())
    if k is not None:
        ordered = ordered.limit(k)
    r = F.row_number().over(Window.orderBy(F.col(n).desc(), F.col(key).asc())).cast("long")
    return ordered.select(r.alias(rank), *counts.columns)


def _count_by(df: DataFrame, key: Column, name: str) -> DataFrame:
    return df.groupBy(key.alias(name)).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------
# A1, A2
# ---------------------------------------------------------------------------
def mentions_total(items: DataFrame, p: ReportParams) -> DataFrame:
    """A1: rows in the current and in the previous window (one pass)."""
    return two_windows(items, p).agg(
        F.count_if(F.col("is_current")).alias("n_mentions"),
        F.count_if(~F.col("is_current")).alias("n_prev_mentions"))


def _delta(cur: Column, prev: Column) -> Column:
    return F.when(prev > 0, (cur - prev).cast("double") / prev.cast("double")).otherwise(F.lit(0.0))


def mention_delta(items: DataFrame, p: ReportParams) -> DataFrame:
    """A2: (cur - prev) / prev, 0.0 when prev is 0."""
    m = mentions_total(items, p)
    return m.select("*", _delta(F.col("n_mentions"), F.col("n_prev_mentions")).alias("mention_delta"))


# ---------------------------------------------------------------------------
# A3-A8 single-key rollups of the current window
# ---------------------------------------------------------------------------
def by_publisher(items: DataFrame, p: ReportParams, k: int = TOP_PUBLISHERS) -> DataFrame:
    """A3: top publishers (empty/NULL -> unknown)."""
    return top_k(_count_by(current(items, p), F.col("publisher"), "publisher"), "publisher", k=k)


def by_domain(items: DataFrame, p: ReportParams, k: int = TOP_DOMAINS) -> DataFrame:
    """A4: top URL hosts."""
    return top_k(_count_by(current(items, p), F.col("domain"), "domain"), "domain", k=k)


def by_platform(items: DataFrame, p: ReportParams) -> DataFrame:
    """A5: items per platform, all platforms."""
    return top_k(_count_by(current(items, p), F.col("platform"), "platform"), "platform")


def _exploded(cur: DataFrame, col: str, name: str, distinct: bool = False) -> DataFrame:
    arr = F.coalesce(F.col(col), F.array().cast("array<string>"))
    if distinct:
        arr = F.array_distinct(arr)
    return cur.select("id", "url", "published_at", "sent", F.explode(arr).alias(name))


def by_topic(items: DataFrame, p: ReportParams, k: int = TOP_TOPICS) -> DataFrame:
    """Every topic occurrence counts (a repeated topic counts twice)."""
    e = _exploded(current(items, p), "topics", "topic")
    return top_k(_count_by(e, F.col("topic"), "topic"), "topic", k=k)


def by_actor(items: DataFrame, p: ReportParams, k: int = TOP_ACTORS) -> DataFrame:
    """Actors, same rules as topics; no alias merging."""
    e = _exploded(current(items, p), "actors", "actor")
    return top_k(_count_by(e, F.col("actor"), "actor"), "actor", k=k)


def _last_days(cur: DataFrame, n_days: int = LAST_DAYS) -> DataFrame:
    days = (cur.filter(F.col("day").isNotNull())
            .groupBy("day").agg(F.count(F.lit(1)).alias("n"),
                                *[F.count_if(F.col("sent") == s).alias(s) for s in SENTIMENT_LABELS]))
    return days.orderBy(F.col("day").desc()).limit(n_days)


def by_day(items: DataFrame, p: ReportParams, n_days: int = LAST_DAYS) -> DataFrame:
    """Items per known day, the last `n_days` days that occur,
    ascending (no gap filling)."""
    return _last_days(current(items, p), n_days).select("day", "n").orderBy("day")


# ---------------------------------------------------------------------------
# A9-A12 sentiment
# ---------------------------------------------------------------------------
def _sent_counts() -> list[Column]:
    return [F.count_if(F.col("sent") == s).alias(s) for s in SENTIMENT_LABELS]


def sentiment_totals(items: DataFrame, p: ReportParams) -> DataFrame:
    """positive/neutral/negative counts and share of scored; three rows
    when anything is scored, none otherwise."""
    a = current(items, p).agg(*_sent_counts())
    a = a.select("*", (F.col(POS) + F.col(NEU) + F.col(NEG)).alias("scored"))
    rows = F.stack(F.lit(3), F.lit(POS), F.col(POS), F.lit(NEU), F.col(NEU), F.lit(NEG), F.col(NEG))
    s = a.filter(F.col("scored") > 0).select(rows.alias("label", "n"), "scored")
    return s.select("label", "n", (F.col("n").cast("double") / F.col("scored").cast("double"))
                    .alias("share"))


def _any_scored(cur: DataFrame) -> DataFrame:
    return cur.agg(F.count_if(F.col("sent").isNotNull()).alias("_scored"))


def sentiment_by_publisher(items: DataFrame, p: ReportParams, k: int = TOP_SENTIMENT_KEYS) -> DataFrame:
    """A10: the top-k publishers by all items, with their scored counts;
    publishers with nothing scored are dropped after the top-k."""
    cur = current(items, p)
    g = cur.groupBy("publisher").agg(F.count(F.lit(1)).alias("n"), *_sent_counts())
    t = top_k(g, "publisher", k=k)
    t = t.select("rank", "publisher", POS, NEU, NEG, (F.col(POS) + F.col(NEU) + F.col(NEG)).alias("n_scored"))
    return t.filter(F.col("n_scored") > 0)


def sentiment_by_topic(items: DataFrame, p: ReportParams, k: int = TOP_SENTIMENT_KEYS) -> DataFrame:
    """The top-k topics by all occurrences with their sentiment counts
    (zeros kept); emitted only when some topic occurrence is scored."""
    e = _exploded(current(items, p), "topics", "topic")
    g = e.groupBy("topic").agg(F.count(F.lit(1)).alias("n"), *_sent_counts())
    t = top_k(g, "topic", k=k).select("rank", "topic", POS, NEU, NEG)
    scored = g.agg(F.sum(F.col(POS) + F.col(NEU) + F.col(NEG))).scalar()  # over the aggregated topics
    return t.filter(scored > 0)


def sentiment_by_day(items: DataFrame, p: ReportParams, n_days: int = LAST_DAYS) -> DataFrame:
    """The days of A8 with their sentiment counts (zeros kept); emitted
    only when anything in the window is scored."""
    cur = current(items, p)
    d = _last_days(cur, n_days).select("day", POS, NEU, NEG,
                                       (F.col(POS) + F.col(NEU) + F.col(NEG)).alias("n_scored"))
    return d.filter(_any_scored(cur).scalar() > 0).orderBy("day")


# ---------------------------------------------------------------------------
# A13, J6 health and risk
# ---------------------------------------------------------------------------
def critical_topics(items: DataFrame, p: ReportParams) -> DataFrame:
    """Critical topics with at least one occurrence in the current
    window.  The critical list is a config parameter (a handful of names),
    so it is an inline filter, not a join."""
    crit = list(p.critical_topics)
    if not crit:
        return current(items, p).limit(0).select(F.lit("").alias("topic"), F.lit(0).cast("long").alias("n"))
    e = _exploded(current(items, p), "topics", "topic").filter(F.col("topic").isin(*crit))
    return e.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


def health_from(n_cur: Column, n_prev: Column, n_crit: Column) -> list[Column]:
    delta = _delta(n_cur, n_prev)
    reputation = (F.when(delta > IMPROVING, "Improving").when(delta < DECLINING, "Declining")
                  .otherwise("Stable"))
    points = (F.when(n_crit >= 2, 2).when(n_crit == 1, 1).otherwise(0)
              + F.when(delta > SURGE, 1).otherwise(0))
    risk = F.when(points >= HIGH_RISK_POINTS, "High").when(points >= MEDIUM_RISK_POINTS, "Medium").otherwise("Low")
    health = (F.lit(HEALTH_BASE) - F.lit(CRITICAL_COST) * n_crit - F.when(delta > SURGE, SURGE_COST).otherwise(0)
              - F.when(delta < SLUMP, SLUMP_COST).otherwise(0))
    return [delta.alias("mention_delta"),
            clamp(health, 0, 100).cast("long").alias("health_score"),
            reputation.alias("reputation"), risk.alias("risk")]


def critical_count(p: ReportParams) -> Column:
    """Aggregate expression: how many configured critical topics occur in
    the current window (one conditional max per topic of the small config
    list, so it rides along in any aggregation over the window slice)."""
    crit = list(p.critical_topics)
    if not crit:
        return F.lit(0).cast("long")
    hit = [F.max(F.when(F.col("is_current") & F.array_contains(
        F.coalesce(F.col("topics"), F.array().cast("array<string>")), t), 1).otherwise(0)) for t in crit]
    total = hit[0]
    for h in hit[1:]:
        total = total + h
    return total.cast("long")


def health_risk(items: DataFrame, p: ReportParams) -> DataFrame:
    """Health score, reputation and risk from the mention delta and
    the number of critical topics present, all from one aggregation."""
    j = two_windows(items, p).agg(
        F.count_if(F.col("is_current")).alias("n_mentions"),
        F.count_if(~F.col("is_current")).alias("n_prev_mentions"),
        critical_count(p).alias("critical_issue_count"))
    return j.select("n_mentions", "n_prev_mentions", "critical_issue_count",
                    *health_from(F.col("n_mentions"), F.col("n_prev_mentions"),
                                 F.col("critical_issue_count")))


# ---------------------------------------------------------------------------
# A14 duplicate groups
# ---------------------------------------------------------------------------
def cross_platform_dup(items: DataFrame) -> DataFrame:
    """Groups of items sharing a url, or sharing a content hash: size,
    platforms, and the id to keep (earliest ingested, then smallest id).
    Ids include the platform, so these groups are what id-level upsert
    cannot merge."""
    def groups(key: str, kind: str) -> DataFrame:
        src = items.filter(F.coalesce(F.col(key), F.lit("")) != "")
        g = src.groupBy(F.col(key).alias("key")).agg(
            F.count(F.lit(1)).alias("n_items"),
            F.array_sort(F.collect_set("platform")).alias("_pl"),
            F.min_by(F.col("id"), F.struct("ingested_at", "id")).alias("keep_id"))
        return g.filter(F.col("n_items") > 1).select(
            F.lit(kind).alias("key_type"), "key", "n_items", F.size("_pl").cast("long").alias("n_platforms"),
            F.array_join("_pl", ",").alias("platforms"), "keep_id")
    return groups("url", "url").unionByName(groups("content_hash", "content_hash"))


# ---------------------------------------------------------------------------
# A15-A18 report assemblies
# ---------------------------------------------------------------------------
def key_metrics(items: DataFrame, p: ReportParams) -> DataFrame:
    """Mentions, delta, top topic ('coverage' if none), top publisher
    ('unknown' if none)."""
    m = mention_delta(items, p)
    topic = by_topic(items, p, k=1).select("topic").scalar()
    publisher = by_publisher(items, p, k=1).select("publisher").scalar()
    return m.select("n_mentions", "n_prev_mentions", "mention_delta",
                    F.coalesce(topic, F.lit("coverage")).alias("top_topic"),
                    F.coalesce(publisher, F.lit("unknown")).alias("top_publisher"))


def summary_tables(items: DataFrame) -> DataFrame:
    """Platform counts (all), top-20 publishers, top-30 topics and the
    total, over any item set, as long rows (table_name, rank, key, n)."""
    pub = (F.col("publisher") if "publisher" in items.columns else
           F.coalesce(F.when(F.col("publisher_or_author") != "", F.col("publisher_or_author")),
                      F.lit("unknown")))
    pl = top_k(_count_by(items, F.col("platform"), "key"), "key")
    pb = top_k(_count_by(items, pub, "key"), "key", k=APPENDIX_PUBLISHERS)
    tp = top_k(_count_by(items.select(F.explode(F.coalesce("topics", F.array().cast("array<string>")))
                                      .alias("t")), F.col("t"), "key"), "key", k=APPENDIX_TOPICS)
    tot = items.agg(F.count(F.lit(1)).alias("n")).select(F.lit(0).cast("long").alias("rank"),
                                                         F.lit("total").alias("key"), "n")

    def tag(df, name):
        return df.select(F.lit(name).alias("table_name"), "rank", "key", "n")
    return (tag(pl, "by_platform").unionByName(tag(pb, "top_publishers"))
            .unionByName(tag(tp, "topic_counts")).unionByName(tag(tot, "total")))


ROLLUP_SETS = (
    ("publisher", ("publisher",)),
    ("domain", ("domain",)),
    ("day", ("day",)),
    ("platform", ("platform",)),
    ("sentiment", ("sent",)),
    ("publisher_sentiment", ("publisher", "sent")),
    ("day_sentiment", ("day", "sent")),
)


def rollup_once(items: DataFrame, p: ReportParams) -> DataFrame:
    """Every non-exploded report count in one scan: one Expand feeding
    one aggregate over grouping sets.  Output (grouping_set, key1, key2, n);
    NULL keys of a set are real NULLs (e.g. unscored sentiment)."""
    cur = current(items, p).select("publisher", "domain", "day", "platform", "sent")
    cols = ["publisher", "domain", "day", "platform", "sent"]
    sets = [list(s) for _, s in ROLLUP_SETS]
    g = cur.groupingSets(sets, *cols).agg(F.count(F.lit(1)).alias("n"),
                                          F.grouping_id(*cols).alias("_gid"))
    name = None
    for label, s in ROLLUP_SETS:
        gid = sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in s)
        name = (F.when(F.col("_gid") == gid, F.lit(label)) if name is None
                else name.when(F.col("_gid") == gid, F.lit(label)))
    k1 = F.coalesce(*[F.when(F.col("_gid") == sum(1 << (len(cols) - 1 - i)
                                                  for i, c in enumerate(cols) if c not in s),
                             F.col(s[0])) for _, s in ROLLUP_SETS])
    k2 = F.when(name.isin("publisher_sentiment", "day_sentiment"), F.col("sent"))
    return g.select(name.alias("grouping_set"), k1.alias("key1"), k2.alias("key2"), "n")


# ---------------------------------------------------------------------------
# W2/U2 seed URLs, J7 restriction
# ---------------------------------------------------------------------------
SALTS = 64


def seed_urls(items: DataFrame, p: ReportParams, topics=None, max_urls: int | None = None) -> DataFrame:
    """W2 + U2: per topic, items carrying it (once per item) with a url,
    newest first (ties by id), the first N, then repeated urls dropped (so
    fewer than N may remain).  Output (topic, rank, url)."""
    n = max_urls or p.max_urls
    e = _exploded(current(items, p), "topics", "topic", distinct=True)
    e = e.filter(F.coalesce(F.col("url"), F.lit("")) != "")
    if topics is not None:
        e = e.filter(F.col("topic").isin(*list(topics)))
    # In two stages: the newest N of each of SALTS shares of the tasks, then
    # of the topic.  A task sends at most N rows of a topic, to one share, so
    # a topic's rows meet in the last stage only, SALTS * N of them at most.
    newest = [F.col("published_at").desc_nulls_last(), F.col("id")]
    part = F.pmod(F.spark_partition_id(), F.lit(SALTS))
    some = (e.select("topic", "url", "published_at", "id", part.alias("salt"))
            .withColumn("r", F.row_number().over(Window.partitionBy("topic", "salt").orderBy(*newest)))
            .filter(F.col("r") <= n))
    top = (some.select("topic", "url", F.row_number().over(Window.partitionBy("topic").orderBy(*newest)).alias("r"))
           .filter(F.col("r") <= n))
    d = top.groupBy("topic", "url").agg(F.min("r").alias("r"))
    w2 = Window.partitionBy("topic").orderBy("r")
    return d.select("topic", F.row_number().over(w2).cast("long").alias("rank"), "url")


def dedup_urls(items: DataFrame, p: ReportParams) -> DataFrame:
    """U2 over every current item: each (topic, url) once, at its newest
    sighting, newest first within the topic.  The first sighting wins in
    newest-first order, so one aggregation per pair finds it; the order is
    then a range-partitioned global sort (no per-topic rank window, so a
    hot topic is spread over many tasks)."""
    e = _exploded(current(items, p), "topics", "topic", distinct=True)
    e = e.filter(F.coalesce(F.col("url"), F.lit("")) != "")
    g = e.groupBy("topic", "url").agg(F.max("published_at").alias("newest_at"))
    return g.orderBy("topic", F.col("newest_at").desc_nulls_last(), "url")


def restrict_to_top(breakdown: DataFrame, key: str, k: int, weight: str = "n") -> DataFrame:
    """Keep only the rows of a (key, ...) breakdown whose key is among
    the top-k keys by total weight; order by that total.  The top-k side is
    at most k rows, so broadcasting it is bounded."""
    totals = breakdown.groupBy(key).agg(F.sum(weight).alias("key_total"))
    top = top_k(totals, key, n="key_total", k=k, rank="key_rank")
    return breakdown.join(F.broadcast(top), key).orderBy("key_rank", *[c for c in breakdown.columns
                                                                      if c != key])
