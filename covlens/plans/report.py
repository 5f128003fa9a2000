"""The whole coverage report as long rows (A18): section, rank, key,
metric, value.  Sections follow the reference report's order: health,
key metrics, publishers, topics, coverage over time, sentiment (totals,
by publisher, topic x sentiment, over time), domains, actors, seed URLs,
and the appendix summary tables.

Scan sharing: the two-window slice is computed once (checkpointed), then
read by four aggregations: the window totals, one Expand over the
grouping sets of A17 (publisher, domain, day, platform, sentiment and
the two sentiment pairs), one explode aggregate of topic x sentiment and
one of actors.  Every section is derived from those small aggregates;
sections sharing an aggregate share its shuffle through exchange reuse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import (APPENDIX_PUBLISHERS, APPENDIX_TOPICS, LAST_DAYS, SENTIMENT_LABELS, TOP_ACTORS,
                      TOP_DOMAINS, TOP_PUBLISHERS, TOP_SENTIMENT_KEYS, TOP_TOPICS, ReportParams)
from ..operators import analytics as A
from ..session import ensure_checkpoint_dir

SCHEMA_COLS = ("section", "rank", "key", "metric", "value")
POS, NEU, NEG = SENTIMENT_LABELS


def window_slice(items: DataFrame, p: ReportParams, materialize: bool = True) -> DataFrame:
    """The two-window slice every section reads, computed once.  It is
    written as a reliable checkpoint to the shared checkpoint folder, so
    the sections neither recompute the snapshot fold nor depend on an
    executor's local blocks."""
    w = A.two_windows(items, p)
    return _materialize(w, materialize)


def _materialize(df: DataFrame, on: bool) -> DataFrame:
    if not on:
        return df
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _rows(df: DataFrame, section: str, rank: Column, key: Column, metrics: dict) -> DataFrame:
    out = None
    for m, v in metrics.items():
        r = df.select(F.lit(section).alias("section"), rank.cast("long").alias("rank"),
                      key.cast("string").alias("key"), F.lit(m).alias("metric"),
                      v.cast("double").alias("value"))
        out = r if out is None else out.unionByName(r)
    return out


def _set(c: DataFrame, name: str) -> DataFrame:
    return c.filter(F.col("grouping_set") == name)


def _pivot_sent(pairs: DataFrame, key: str) -> DataFrame:
    """(key, sent, n) pair counts -> key, positive, neutral, negative."""
    return pairs.groupBy(F.col("key1").alias(key)).agg(
        *[F.sum(F.when(F.col("key2") == s, F.col("n")).otherwise(0)).cast("long").alias(s)
          for s in SENTIMENT_LABELS])


def report_rows(items: DataFrame, p: ReportParams, materialize: bool = True) -> DataFrame:
    """A18."""
    w = window_slice(items, p, materialize)
    cur = w.filter("is_current")
    # The four aggregates are small (one row per key); they are cached so the
    # many sections reading them do not re-run their final aggregation.  A
    # lost cache block is recomputed from the checkpointed slice.
    tot = w.agg(F.count_if(F.col("is_current")).alias("n_mentions"),
                F.count_if(~F.col("is_current")).alias("n_prev_mentions"),
                A.critical_count(p).alias("critical_issue_count"))
    counts = A.rollup_once(w, p)
    tx = A._exploded(cur, "topics", "topic").groupBy("topic", "sent").agg(F.count(F.lit(1)).alias("n"))
    ax = A._exploded(cur, "actors", "actor").groupBy("actor").agg(F.count(F.lit(1)).alias("n"))
    if materialize:
        tot, counts, tx, ax = (d.cache() for d in (tot, counts, tx, ax))

    n = F.col("n")
    pub = _set(counts, "publisher").select(F.col("key1").alias("publisher"), "n")
    dom = _set(counts, "domain").select(F.col("key1").alias("domain"), "n")
    day = _set(counts, "day").filter(F.col("key1").isNotNull()).select(F.col("key1").alias("day"), "n")
    plat = _set(counts, "platform").select(F.col("key1").alias("platform"), "n")
    sent = _set(counts, "sentiment").filter(F.col("key1").isNotNull()).select(F.col("key1").alias("label"), "n")
    topic_all = tx.groupBy("topic").agg(F.sum("n").alias("n"),
                                        *[F.sum(F.when(F.col("sent") == s, F.col("n")).otherwise(0)).cast("long").alias(s)
                                          for s in SENTIMENT_LABELS])
    scored = sent.agg(F.sum("n")).scalar()
    topic_scored = topic_all.agg(F.sum(F.col(POS) + F.col(NEU) + F.col(NEG))).scalar()

    # health and key metrics
    hr = tot.select("*", *A.health_from(F.col("n_mentions"), F.col("n_prev_mentions"),
                                         F.col("critical_issue_count")))
    top_topic = A.top_k(topic_all.select("topic", "n"), "topic", k=1).select("topic").scalar()
    top_pub = A.top_k(pub, "publisher", k=1).select("publisher").scalar()
    km = tot.select("*", top_topic.alias("top_topic"), top_pub.alias("top_publisher"),
                    A._delta(F.col("n_mentions"), F.col("n_prev_mentions")).alias("mention_delta"))

    # sentiment sections
    # at most three label rows: the scored total is a window over them
    scored_all = F.sum("n").over(Window.partitionBy())
    totals = sent.select("label", "n", (F.col("n").cast("double") / scored_all.cast("double")).alias("share"))
    pub_top = A.top_k(pub, "publisher", k=TOP_SENTIMENT_KEYS)
    pub_sent = pub_top.join(_pivot_sent(_set(counts, "publisher_sentiment").filter(F.col("key2").isNotNull()),
                                        "publisher"), "publisher", "left").na.fill(0, list(SENTIMENT_LABELS))
    pub_sent = pub_sent.select("*", (F.col(POS) + F.col(NEU) + F.col(NEG)).alias("n_scored")) \
        .filter(F.col("n_scored") > 0)
    topic_sent = A.top_k(topic_all, "topic", k=TOP_SENTIMENT_KEYS).filter(topic_scored > 0)
    days = day.orderBy(F.col("day").desc()).limit(LAST_DAYS)
    day_sent = days.join(_pivot_sent(_set(counts, "day_sentiment").filter(F.col("key2").isNotNull()), "day"),
                         "day", "left").na.fill(0, list(SENTIMENT_LABELS))
    day_sent = day_sent.select("*", (F.col(POS) + F.col(NEU) + F.col(NEG)).alias("n_scored")) \
        .filter(scored > 0)

    appendix = (A.top_k(plat.withColumnRenamed("platform", "key"), "key").select(
                    F.lit("by_platform").alias("table_name"), "rank", "key", "n")
                .unionByName(A.top_k(pub.withColumnRenamed("publisher", "key"), "key", k=APPENDIX_PUBLISHERS)
                             .select(F.lit("top_publishers").alias("table_name"), "rank", "key", "n"))
                .unionByName(A.top_k(topic_all.select(F.col("topic").alias("key"), "n"), "key", k=APPENDIX_TOPICS)
                             .select(F.lit("topic_counts").alias("table_name"), "rank", "key", "n"))
                .unionByName(tot.select(F.lit("total").alias("table_name"), F.lit(0).cast("long").alias("rank"),
                                        F.lit("total").alias("key"), F.col("n_mentions").alias("n"))))

    parts = [
        _rows(hr, "health", F.lit(1), F.lit("health_score"), {"value": F.col("health_score")}),
        _rows(hr, "health", F.lit(2), F.col("reputation"), {"reputation": F.lit(None)}),
        _rows(hr, "health", F.lit(3), F.col("risk"), {"risk": F.lit(None)}),
        _rows(hr, "health", F.lit(4), F.lit("alerts"), {"critical_issue_count": F.col("critical_issue_count")}),
        _rows(km, "key_metrics", F.lit(1), F.lit("mentions"),
              {"n": F.col("n_mentions"), "n_prev": F.col("n_prev_mentions"), "delta": F.col("mention_delta")}),
        _rows(km, "key_metrics", F.lit(2), F.coalesce("top_topic", F.lit("coverage")), {"top_topic": F.lit(None)}),
        _rows(km, "key_metrics", F.lit(3), F.coalesce("top_publisher", F.lit("unknown")), {"top_publisher": F.lit(None)}),
        _rows(A.top_k(pub, "publisher", k=TOP_PUBLISHERS), "top_publishers", F.col("rank"), F.col("publisher"),
              {"articles": n}),
        _rows(A.top_k(topic_all.select("topic", "n"), "topic", k=TOP_TOPICS), "topic_counts", F.col("rank"),
              F.col("topic"), {"articles": n}),
        _rows(days, "coverage_over_time", F.lit(0), F.col("day"), {"mentions": n}),
        _rows(totals, "sentiment", F.lit(0), F.col("label"), {"count": n, "share": F.col("share")}),
        _rows(pub_sent, "sentiment_by_publisher", F.col("rank"), F.col("publisher"),
              {m: F.col(m) for m in (POS, NEU, NEG, "n_scored")}),
        _rows(topic_sent, "topic_sentiment", F.col("rank"), F.col("topic"), {m: F.col(m) for m in (POS, NEU, NEG)}),
        _rows(day_sent, "sentiment_over_time", F.lit(0), F.col("day"),
              {m: F.col(m) for m in (POS, NEU, NEG, "n_scored")}),
        _rows(A.top_k(dom, "domain", k=TOP_DOMAINS), "top_domains", F.col("rank"), F.col("domain"), {"articles": n}),
        _rows(A.top_k(ax, "actor", k=TOP_ACTORS), "top_actors", F.col("rank"), F.col("actor"), {"mentions": n}),
        _seed(A.seed_urls(w, p)),
        _rows(appendix, "appendix", F.col("rank"), F.concat_ws(":", F.col("table_name"), F.col("key")), {"items": n}),
    ]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def _seed(seed: DataFrame) -> DataFrame:
    return seed.select(F.lit("seed_urls").alias("section"), F.col("rank").cast("long").alias("rank"),
                       F.col("url").alias("key"), F.concat(F.lit("topic:"), F.col("topic")).alias("metric"),
                       F.lit(None).cast("double").alias("value"))
