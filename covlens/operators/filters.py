"""Item predicates (P1-P9).  All are plain filters on stored columns, so
Catalyst pushes the comparisons into the Parquet scan."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import coverage_day


def ts_lit(ts: str | datetime) -> Column:
    if isinstance(ts, datetime):
        ts = ts.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(ts).cast("timestamp")


def items_since(items: DataFrame, since) -> DataFrame:
    """published_at >= since (NULL excluded).  Filter on the column
    itself so the predicate reaches the scan."""
    return items.filter(F.col("published_at") >= ts_lit(since))


def items_by_platform(items: DataFrame, platform: str) -> DataFrame:
    """P2."""
    return items.filter(F.col("platform") == platform)


def items_by_publisher(items: DataFrame, publisher: str) -> DataFrame:
    """P3."""
    return items.filter(F.col("publisher_or_author") == publisher)


def items_topics_any(items: DataFrame, topics) -> DataFrame:
    """Any listed topic among the item's topics; empty list = no filter."""
    topics = [t for t in (topics or [])]
    if not topics:
        return items
    lit = F.array(*[F.lit(t) for t in topics])
    return items.filter(F.arrays_overlap(F.coalesce(F.col("topics"), F.array().cast("array<string>")),
                                         lit))


def query_items(items: DataFrame, since=None, topics_any=None, platform=None, publisher=None,
                limit: int | None = None) -> DataFrame:
    """P5: P1..P3, then an optional LIMIT, then P4 (the reference applies the
    topic filter after the limit).  The limit takes the newest rows (ties by
    id) so it is deterministic; no limit by default."""
    q = items
    if since is not None:
        q = items_since(q, since)
    if platform:
        q = items_by_platform(q, platform)
    if publisher:
        q = items_by_publisher(q, publisher)
    if limit is not None:
        q = q.orderBy(F.col("published_at").desc_nulls_last(), F.col("id")).limit(limit)
    return items_topics_any(q, topics_any)


def has_url(items: DataFrame) -> DataFrame:
    """Drop empty urls."""
    return items.filter(F.coalesce(F.col("url"), F.lit("")) != "")


def known_day(items: DataFrame) -> DataFrame:
    """Rows whose coverage day is known."""
    return items.filter(coverage_day(F.col("published_at"), F.col("ingested_at")).isNotNull())
