"""Landing payloads derived by Spark from the driver's test tables.

The reference ingests API lists, keyed feed payloads and raw feed XML.  The
test data has none, so Spark writes them out of the documents/events rows
(the same binding as `binding.py`: platform, article url, whole text,
published time).  Each landed "file" holds the
rows of one (platform, doc_id div 100) block, so payload documents stay
small however large the tables grow, and the scans parse real text.

Variants that exercise the normalisers' fall-backs are part of the rule:
aggregator `source` empty (doc_id % 5 = 0) or blank (= 1), `author` NULL
when doc_id % 3 = 0; feed `summary` empty when doc_id % 8 = 0 (falls to
description), `published` missing when doc_id % 8 = 4 (falls to updated);
odd blocks of the feeds land as XML, even ones as keyed JSON; of every four
XML blocks one has a byte-order mark, a comment and a style sheet before its
root and one is RDF; odd blocks of the channels land as Atom XML (with
several links an entry), even ones as keyed JSON.  Every entry carries an
`id` of its own beyond what the scans type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .binding import event_times, opening, platform_of, rest, table, url_of


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", opening(F.col("text")).alias("t_raw"), rest(F.col("text")).alias("s_raw"))
    x = d.join(event_times(spark, sf_dir), "doc_id", "left")
    return x.select(
        "doc_id", "source", "lang", "t_raw", "s_raw",
        platform_of(F.col("doc_id")).alias("platform"),
        url_of(F.col("doc_id")).alias("url"),
        F.when(F.col("doc_id") % 17 != 0, F.col("ts").cast("timestamp")).alias("ts"),
        F.concat(F.lit("ref-"), F.col("doc_id").cast("string")).alias("ref"),
        F.floor(F.col("doc_id") / 100).cast("long").alias("block"))


def _rows(spark: SparkSession, sf_dir: str, rows: DataFrame | None) -> DataFrame:
    """`rows` (raw_rows that the caller keeps for several payloads), else read from the tables."""
    return raw_rows(spark, sf_dir) if rows is None else rows


def _path(platform: str, ext: str = "json") -> Column:
    return F.concat(F.lit(f"landing/{platform}/"), F.col("block").cast("string"), F.lit(f".{ext}"))


def _by_first(field: str):
    def cmp(a, b):
        return F.when(a[field] < b[field], -1).when(a[field] > b[field], 1).otherwise(0)
    return cmp


def _ordered(col: Column) -> Column:
    """collect_list in doc_id order (a file holds at most one block)."""
    arr = F.collect_list(F.struct(F.col("doc_id"), col.alias("x")))
    return F.transform(F.array_sort(arr, _by_first("doc_id")), lambda s: s["x"])


def iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssXXX")


def discovery_payloads(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """JSON array documents of discovery-API articles (path, text)."""
    r = _rows(spark, sf_dir, rows).filter(F.col("platform") == "gdelt")
    art = F.struct(
        F.col("url"), F.lit("").alias("url_mobile"), F.col("t_raw").alias("title"),
        F.date_format("ts", "yyyyMMdd'T'HHmmss'Z'").alias("seendate"), F.lit("").alias("socialimage"),
        F.concat(F.lit("www."), F.col("source"), F.lit(".example.com")).alias("domain"),
        F.col("lang").alias("language"), F.lit("ID").alias("sourcecountry"), F.col("ref").alias("id"))
    g = r.groupBy(_path("gdelt").alias("path")).agg(_ordered(art).alias("arts"))
    return g.select("path", F.to_json("arts").alias("text"))


def aggregator_payloads(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """Aggregator responses: {"data": [...]} for even blocks, a bare array
    for odd ones."""
    r = _rows(spark, sf_dir, rows).filter(F.col("platform") == "mediastack")
    m5 = F.col("doc_id") % 5
    art = F.struct(
        F.when(F.col("doc_id") % 3 != 0, F.concat(F.lit("au"), (F.col("doc_id") % 7).cast("string")))
        .alias("author"),
        F.col("t_raw").alias("title"), F.col("s_raw").alias("description"), F.col("url"),
        F.when(m5 == 0, F.lit("")).when(m5 == 1, F.lit("  ")).otherwise(F.col("source")).alias("source"),
        F.lit(None).cast("string").alias("image"), F.lit("general").alias("category"),
        F.col("lang").alias("language"), F.lit("id").alias("country"),
        iso(F.col("ts")).alias("published_at"), F.col("ref").alias("id"))
    g = r.groupBy("block").agg(_ordered(art).alias("arts"))
    text = F.when(F.col("block") % 2 == 0, F.to_json(F.struct(F.col("arts").alias("data")))) \
        .otherwise(F.to_json("arts"))
    return g.select(_path("mediastack").alias("path"), text.alias("text"))


def _feed_entry(r_feed: Column) -> Column:
    rfc = F.date_format(F.col("ts") + F.expr("INTERVAL 7 HOURS"), "EEE, dd MMM yyyy HH:mm:ss '+0700'")
    return F.create_map(
        F.lit("title"), F.col("t_raw"), F.lit("link"), F.col("url"),
        F.lit("published"), F.when(F.col("doc_id") % 8 != 4, rfc),
        F.lit("updated"), iso(F.col("ts")),
        F.lit("summary"), F.when(F.col("doc_id") % 8 == 0, F.lit("")).otherwise(F.col("s_raw")),
        F.lit("description"), F.col("s_raw"),
        F.lit("id"), F.col("ref"), F.lit("_feed_name"), r_feed,
        F.lit("_feed_url"), F.concat(F.lit("https://"), F.col("source"), F.lit(".example.com/rss")))


def feed_name_of() -> Column:
    return F.concat(F.col("source"), F.lit("_nasional"))


def keyed_feed_payloads(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """{feed_name: [entry, ...]} JSON documents for the even feed blocks."""
    r = _rows(spark, sf_dir, rows).filter((F.col("platform") == "rss") & (F.col("block") % 2 == 0))
    per_feed = r.groupBy("block", feed_name_of().alias("feed")).agg(
        _ordered(_feed_entry(feed_name_of())).alias("entries"))
    g = per_feed.groupBy("block").agg(F.map_from_entries(F.array_sort(F.collect_list(
        F.struct("feed", "entries")), _by_first("feed"))).alias("m"))
    return g.select(_path("rss").alias("path"), F.to_json("m").alias("text"))


def xml_escape(c: Column) -> Column:
    c = F.replace(c, F.lit("&"), F.lit("&amp;"))
    c = F.replace(c, F.lit("<"), F.lit("&lt;"))
    return F.replace(c, F.lit(">"), F.lit("&gt;"))


def _tag(name: str, c: Column) -> Column:
    return F.when(c.isNotNull(), F.concat(F.lit(f"<{name}>"), xml_escape(c), F.lit(f"</{name}>"))) \
        .otherwise(F.lit(""))


def rss_xml_payloads(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """RSS 2.0 documents (one per feed and odd block): path, feed_name,
    feed_url, text."""
    r = _rows(spark, sf_dir, rows).filter((F.col("platform") == "rss") & (F.col("block") % 2 == 1))
    rfc = F.date_format(F.col("ts") + F.expr("INTERVAL 7 HOURS"), "EEE, dd MMM yyyy HH:mm:ss '+0700'")
    item = F.concat(F.lit("<item>"), _tag("title", F.col("t_raw")), _tag("link", F.col("url")),
                    _tag("pubDate", F.when(F.col("doc_id") % 8 != 4, rfc)),
                    _tag("updated", iso(F.col("ts"))),
                    _tag("description", F.col("s_raw")), _tag("guid", F.col("ref")), F.lit("</item>"))
    g = r.groupBy("block", "source").agg(_ordered(item).alias("items"))
    items, title = F.array_join("items", ""), F.concat(F.lit("<title>"), F.col("source"), F.lit("</title>"))
    head = F.when(F.col("block") % 8 == 1, F.lit(
        '\ufeff<?xml version="1.0" encoding="UTF-8"?>\n<?xml-stylesheet type="text/xsl" href="feed.xsl"?><!-- a feed -->\n')
    ).otherwise(F.lit('<?xml version="1.0" encoding="UTF-8"?>'))
    rdf = F.concat(head, F.lit('<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" '
                               'xmlns="http://purl.org/rss/1.0/"><channel>'), title, F.lit("</channel>"), items,
                   F.lit("</rdf:RDF>"))
    text = F.when(F.col("block") % 8 == 3, rdf).otherwise(F.concat(
        head, F.lit('<rss version="2.0"><channel>'), title, items, F.lit("</channel></rss>")))
    return g.select(F.concat(F.lit("landing/rss/"), F.col("source"), F.lit("-"),
                             F.col("block").cast("string"), F.lit(".xml")).alias("path"),
                    feed_name_of().alias("feed_name"),
                    F.concat(F.lit("https://"), F.col("source"), F.lit(".example.com/rss")).alias("feed_url"),
                    text.alias("text"))


def channel_xml_payloads(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """Atom channel documents (one per channel and odd block): path, channel,
    channel_ref (the configured channel id), text."""
    r = _rows(spark, sf_dir, rows).filter((F.col("platform") == "youtube") & (F.col("block") % 2 == 1))
    vid = F.concat(F.lit("v"), F.col("doc_id").cast("string"))
    link = F.concat(F.lit('<link rel="alternate" href="https://www.youtube.com/watch?v='), vid, F.lit('"/>'))
    own = F.lit('<link rel="self" href="https://www.youtube.com/feeds/self"/>')
    entry = F.concat(F.lit("<entry>"), _tag("id", F.col("ref")), _tag("yt:videoId", vid), _tag("title", F.col("t_raw")),
                     F.when(F.col("doc_id") % 3 == 0, own).otherwise(F.lit("")), link, own,
                     _tag("published", iso(F.col("ts"))), _tag("summary", F.col("s_raw")),
                     F.lit("</entry>"))
    g = r.groupBy("block", "source").agg(_ordered(entry).alias("entries"))
    text = F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?><feed xmlns:yt="http://www.youtube.com/'
                          'xml/schemas/2015" xmlns="http://www.w3.org/2005/Atom">'),
                    F.array_join("entries", ""), F.lit("</feed>"))
    return g.select(F.concat(F.lit("landing/youtube/"), F.col("source"), F.lit("-"),
                             F.col("block").cast("string"), F.lit(".xml")).alias("path"),
                    F.col("source").alias("channel"),
                    F.concat(F.lit("UC"), F.col("source")).alias("channel_ref"), text.alias("text"))


def keyed_channel_payloads(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """{channel: [entry, ...]} JSON documents for the even channel blocks."""
    r = _rows(spark, sf_dir, rows).filter((F.col("platform") == "youtube") & (F.col("block") % 2 == 0))
    vid = F.concat(F.lit("v"), F.col("doc_id").cast("string"))
    entry = F.struct(
        F.col("t_raw").alias("title"), F.concat(F.lit("https://www.youtube.com/watch?v="), vid).alias("link"),
        iso(F.col("ts")).alias("published"), F.col("s_raw").alias("summary"), vid.alias("video_id"),
        F.col("source").alias("_channel_name"), F.concat(F.lit("UC"), F.col("source")).alias("_channel_id"),
        F.col("ref").alias("id"))
    per = r.groupBy("block", "source").agg(_ordered(entry).alias("entries"))
    g = per.groupBy("block").agg(F.map_from_entries(F.array_sort(F.collect_list(
        F.struct("source", "entries")), _by_first("source"))).alias("m"))
    return g.select(_path("youtube").alias("path"), F.to_json("m").alias("text"))


def aggregator_errors(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """API error answers beside the aggregator blocks of every third number."""
    r = _rows(spark, sf_dir, rows).filter((F.col("platform") == "mediastack") & (F.col("block") % 3 == 1))
    g = r.groupBy("block").agg(F.count(F.lit(1)).alias("n"))
    error = F.struct(F.lit("rate_limit_reached").alias("code"),
                     F.concat(F.lit("limit after "), F.col("n").cast("string"), F.lit(" articles")).alias("message"))
    return g.select(F.concat(F.lit("landing/mediastack/errors-"), F.col("block").cast("string"), F.lit(".json")).alias("path"),
                    F.to_json(F.struct(error.alias("error"))).alias("text"))


def feed_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deployment's table of feeds and channels: platform, key, name,
    url, channel_id; here one feed and one channel per source."""
    s = table(spark, sf_dir, "documents").select("source").distinct()
    none = F.lit(None).cast("string")
    return s.select(F.lit("rss").alias("platform"), F.col("source").alias("key"), feed_name_of().alias("name"),
                    F.concat(F.lit("https://"), F.col("source"), F.lit(".example.com/rss")).alias("url"),
                    none.alias("channel_id")).unionByName(
        s.select(F.lit("youtube").alias("platform"), F.col("source").alias("key"), F.col("source").alias("name"),
                 none.alias("url"), F.concat(F.lit("UC"), F.col("source")).alias("channel_id")))


def video_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of statistics answers, from events: the events of document k
    (event_id div 10 = k) are the interactions with video 'v<k>', and each
    gives a row with the counts up to then, so a video has several rows."""
    ev = table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.col("ts").cast("timestamp").alias("fetched_at"),
        F.concat(F.lit("v"), F.floor(F.col("event_id") / 10).cast("string")).alias("video_id"))
    so_far = Window.partitionBy("video_id").orderBy("fetched_at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return ev.select("video_id", "fetched_at", *[F.count_if(F.col("event_type") == kind).over(so_far).alias(name) for kind, name in
                                                 (("view", "views"), ("click", "likes"), ("signup", "comments"))])
