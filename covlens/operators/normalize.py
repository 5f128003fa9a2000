"""The four normalisers (N1-N4), the shared item projection (N5), the
video-stats lookup (J1) and the source union (U1).

Each normaliser is one projection over parsed landing rows; cleaning and
parsing are Column expressions, so a normaliser is a single codegen stage
after the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import content_hash, item_id
from ..functions.jsonf import compact_json
from ..functions.publisher import aggregator_publisher, feed_publisher, publisher_from_domain
from ..functions.text import clean_text
from ..functions.time import parse_compact_ts, parse_timestamp
from ..schema import ITEM_COLUMNS, conform

SOURCE_ORDER = {"gdelt": 0, "mediastack": 1, "rss": 2, "youtube": 3}


def _nonempty(c: Column) -> Column:
    return F.when(c != "", c)


def _raw(df: DataFrame, built: Column) -> Column:
    """The landed object as it came where the scan kept it (`raw`), else as
    far as it was parsed."""
    return F.col("raw") if "raw" in df.columns else compact_json(built)


def _or_none(text: Column) -> Column:
    # NULLIF binds the cleaned text; compared and returned by a WHEN it would be cleaned twice.
    return F.nullif(clean_text(text), F.lit(""))


def base_item(df: DataFrame, ingested_at: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Complete the item: id (F8), content hash (F9), the run's
    ingestion time, enrichment/content columns NULL; typed to the item
    schema.  `df` carries platform, source_type, publisher_or_author, url,
    title, summary, published_at, signals_json, raw_json."""
    x = df.select("*", item_id(F.col("platform"), F.col("url")).alias("id"),
                  content_hash(F.col("title"), F.col("summary")).alias("content_hash"),
                  ingested_at.cast("timestamp").alias("ingested_at"))
    return conform(x, extra=keep)


def normalize_discovery(arts: DataFrame, ingested_at: Column, keep=("path", "pos")) -> DataFrame:
    """Discovery-API articles -> items."""
    domain = F.coalesce(F.col("domain"), F.lit(""))
    x = arts.select(
        *[c for c in keep if c in arts.columns],
        F.lit("gdelt").alias("platform"), F.lit("news").alias("source_type"),
        F.when(domain == "", F.lit("unknown")).otherwise(publisher_from_domain(domain))
        .alias("publisher_or_author"),
        F.coalesce(F.col("url"), F.lit("")).alias("url"),
        _or_none(F.col("title")).alias("title"),
        F.lit(None).cast("string").alias("summary"),
        parse_compact_ts(F.col("seendate")).alias("published_at"),
        compact_json(F.struct(domain.alias("domain"), "sourcecountry", "language", "socialimage",
                              "url_mobile")).alias("signals_json"),
        _raw(arts, F.struct("url", "url_mobile", "title", "seendate", "socialimage", "domain",
                            "language", "sourcecountry")).alias("raw_json"))
    return base_item(x, ingested_at, keep)


def normalize_aggregator(arts: DataFrame, ingested_at: Column, keep=("path", "pos")) -> DataFrame:
    """Aggregator articles -> items."""
    x = arts.select(
        *[c for c in keep if c in arts.columns],
        F.lit("mediastack").alias("platform"), F.lit("news").alias("source_type"),
        aggregator_publisher(F.col("source"), F.col("author")).alias("publisher_or_author"),
        F.coalesce(F.col("url"), F.lit("")).alias("url"),
        _or_none(F.col("title")).alias("title"),
        _or_none(F.col("description")).alias("summary"),
        parse_timestamp(F.col("published_at")).alias("published_at"),
        compact_json(F.struct("category", "country", "language", "image")).alias("signals_json"),
        _raw(arts, F.struct("author", "title", "description", "url", "source", "image", "category",
                            "language", "country", "published_at")).alias("raw_json"))
    return base_item(x, ingested_at, keep)


def normalize_feed(entries: DataFrame, ingested_at: Column, keep=("path", "pos")) -> DataFrame:
    """Publisher RSS entries (feed_name, entry map) -> items."""
    e = F.col("entry")
    # bound here, as cleaning names its text several times
    entries = entries.select("*", F.coalesce(_nonempty(e["summary"]), e["description"]).alias("_summary"))
    x = entries.select(
        *[c for c in keep if c in entries.columns],
        F.lit("rss").alias("platform"), F.lit("news").alias("source_type"),
        feed_publisher(F.col("feed_name")).alias("publisher_or_author"),
        F.coalesce(e["link"], F.lit("")).alias("url"),
        _or_none(e["title"]).alias("title"),
        _or_none(F.col("_summary")).alias("summary"),
        parse_timestamp(F.coalesce(_nonempty(e["published"]), e["updated"])).alias("published_at"),
        compact_json(F.struct(F.coalesce(_nonempty(e["_feed_name"]), F.col("feed_name")).alias("feed_name"),
                              e["_feed_url"].alias("feed_url"))).alias("signals_json"),
        _raw(entries, e).alias("raw_json"))
    return base_item(x, ingested_at, keep)


def video_stats_join(entries: DataFrame, stats: DataFrame | None, at: Column | None = None) -> DataFrame:
    """As-of lookup video_id -> (views, likes, comments); missing counts
    are 0, an entry without a stats row gets no metrics.  `stats` is a log of
    API answers: of a video's rows the newest by `fetched_at`, none later than
    `at` if given, so every entry gives one row.  Without that column the row
    with the largest counts is taken.  The stats side grows with the number
    of videos, so no broadcast hint: AQE picks a broadcast at run time when
    the side is measured to be small."""
    vid = F.col("entry")["video_id"]
    if stats is None:
        return entries.select("*", F.create_map().cast("map<string,bigint>").alias("metrics"))
    counts = F.struct(*[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("views", "likes", "comments")])
    if "fetched_at" in stats.columns:
        if at is not None:
            stats = stats.where(F.col("fetched_at") <= at.cast("timestamp"))
        newest = F.max(F.struct("fetched_at", counts.alias("c")))["c"]
    else:
        newest = F.max(counts)
    s = (stats.where("video_id is not null").groupBy(F.col("video_id").alias("_vid")).agg(newest.alias("_c"))
         .select("_vid", F.create_map(F.lit("views"), F.col("_c.views"), F.lit("likes"), F.col("_c.likes"),
                                      F.lit("comments"), F.col("_c.comments")).alias("_m")))
    j = entries.join(s, (vid == F.col("_vid")) & (F.coalesce(vid, F.lit("")) != ""), "left")
    return j.select(*entries.columns,
                    F.coalesce("_m", F.create_map().cast("map<string,bigint>")).alias("metrics"))


def normalize_channel(entries: DataFrame, ingested_at: Column, stats: DataFrame | None = None,
                      keep=("path", "pos")) -> DataFrame:
    """Channel entries (feed_name = channel key) -> items, with the
    video metrics of J1 in the signals."""
    j = video_stats_join(entries, stats, ingested_at)
    e = F.col("entry")
    x = j.select(
        *[c for c in keep if c in j.columns],
        F.lit("youtube").alias("platform"), F.lit("social").alias("source_type"),
        F.col("feed_name").alias("publisher_or_author"),
        F.coalesce(e["link"], F.lit("")).alias("url"),
        _or_none(e["title"]).alias("title"),
        _or_none(e["summary"]).alias("summary"),
        parse_timestamp(F.coalesce(_nonempty(e["published"]), e["updated"])).alias("published_at"),
        compact_json(F.struct(F.coalesce(_nonempty(e["_channel_name"]), F.col("feed_name")).alias("channel_name"),
                              e["_channel_id"].alias("channel_id"), e["video_id"].alias("video_id"),
                              F.col("metrics").alias("metrics"))).alias("signals_json"),
        _raw(j, e).alias("raw_json"))
    return base_item(x, ingested_at, keep)


def union_sources(batch_id: int | Column, **by_platform: DataFrame) -> DataFrame:
    """Enabled sources in the fixed order discovery, aggregator, feeds,
    channels (disabled = not passed).  Adds `seq`, a struct giving the
    total order (batch, source order, landed file, position) that the
    upsert fold needs."""
    out = None
    for name in sorted(by_platform, key=lambda n: SOURCE_ORDER[n]):
        df = by_platform[name]
        if df is None:
            continue
        path = F.col("path") if "path" in df.columns else F.lit("")
        pos = F.col("pos") if "pos" in df.columns else F.lit(0)
        b = batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
        df = df.select(*ITEM_COLUMNS, b.cast("long").alias("batch_id"),
                       F.struct(b.cast("long").alias("batch"), F.lit(SOURCE_ORDER[name]).alias("src"),
                                path.alias("file"), pos.cast("long").alias("pos")).alias("seq"))
        out = df if out is None else out.unionByName(df)
    return out
