"""Binding of the driver's test tables to item observations.

`documents d ⟕ labels l ON l.doc_id = d.doc_id ⟕ events of the document (event_id
div 10 = doc_id)` gives one observation per document:

  seq                  d.doc_id (total order of observations)
  platform             doc_id % 4: 0 rss, 1 gdelt, 2 mediastack, 3 youtube
  source_type          social for youtube, else news
  publisher_or_author  d.source
  article              doc_id; of every 40 documents, four repeat the article 20 ids
                       before them and one the article 18 ids before it, which is
                       on another platform
  url                  of the article's site ('src0' for every third article) and number;
                       '' when doc_id % 97 = 5
  title / summary      clean(text[1..80]) / clean(the whole rest), '' -> NULL
  published_at         time of the document's event with the highest value, NULL when
                       doc_id % 17 = 0
  ingested_at          2024-01-31 00:00:00
  language             d.lang
  sentiment            toxic=1 negative, quality=1 positive, quality=0 neutral
  topics, actors, ...  keyword tagger over the snapshot's stored title + summary
                       (test taxonomy), after the upsert fold

About nine tenths of the ids are distinct at every scale; the empty url gives
one id per platform that holds about one row in four hundred.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import TEST_TAXONOMY, Taxonomy
from ..functions.ids import content_hash, item_id
from ..functions.jsonf import compact_json
from ..functions.text import clean_text
from ..operators.tagging import (empty_array, keyword_actors, keyword_editorial, keyword_topics,
                                 tag_text, tags_json)
from ..schema import conform

INGESTED_AT = "2024-01-31 00:00:00"
BINDING_MODEL = "test_binding"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def platform_of(doc_id) -> F.Column:
    m = doc_id % 4
    return (F.when(m == 0, "rss").when(m == 1, "gdelt").when(m == 2, "mediastack")
            .otherwise("youtube"))


def article_of(doc_id) -> F.Column:
    m = doc_id % 40
    return F.when(m >= 36, doc_id - 20).when(m == 35, doc_id - 18).otherwise(doc_id)


def article_url(article) -> F.Column:
    site = F.when(article % 3 == 0, F.lit(0)).otherwise(article % 20)
    return F.concat(F.lit("https://www.src"), site.cast("string"), F.lit(".example.com/a/"), article.cast("string"))


def url_of(doc_id) -> F.Column:
    return F.when(doc_id % 97 == 5, F.lit("")).otherwise(article_url(article_of(doc_id)))


def opening(text) -> F.Column:
    return F.substring(text, 1, 80)


def rest(text) -> F.Column:
    return F.call_function("substring", text, F.lit(81))


def event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the time of its event with the highest value (of equal
    ones the latest id): one hash aggregation over all events, ordered by
    one number (the value in millionths, then the id's last digit)."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    order = F.floor(F.coalesce("value", F.lit(-1.0)) * 1000000) * 10 + F.col("event_id") % 10
    return (ev.groupBy(F.floor(F.col("event_id") / 10).cast("long").alias("doc_id"))
            .agg(F.max_by("ts", order).alias("ts")))


def article_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed page of each article, under the article's url: page k
    belongs to article k."""
    return table(spark, sf_dir, "pages").select(article_url(F.col("page_id")).alias("url"), "html")


def sentiment_of(quality, toxic) -> F.Column:
    return (F.when(toxic == 1, "negative").when(quality == 1, "positive")
            .when(quality == 0, "neutral"))


def observations(spark: SparkSession, sf_dir: str, taxonomy: Taxonomy = TEST_TAXONOMY) -> DataFrame:
    """The observation log (item schema + seq, batch_id) from the tables."""
    d = table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang",
        opening(F.col("text")).alias("t_raw"), rest(F.col("text")).alias("s_raw"))
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    # Both joins use the key doc_id, so at scale the documents side is
    # hash-partitioned once and the second join reuses that partitioning.
    x = d.join(lab, "doc_id", "left").join(event_times(spark, sf_dir), "doc_id", "left")

    platform = platform_of(F.col("doc_id"))
    url = url_of(F.col("doc_id"))
    x = x.select("*", clean_text(F.col("t_raw")).alias("_t"), clean_text(F.col("s_raw")).alias("_s"))
    x = x.select(
        F.col("doc_id").alias("seq"),
        platform.alias("platform"),
        F.when(platform == "youtube", "social").otherwise("news").alias("source_type"),
        F.col("source").alias("publisher_or_author"),
        url.alias("url"),
        F.when(F.col("_t") != "", F.col("_t")).alias("title"),
        F.when(F.col("_s") != "", F.col("_s")).alias("summary"),
        F.when(F.col("doc_id") % 17 != 0, F.col("ts").cast("timestamp")).alias("published_at"),
        F.lit(INGESTED_AT).cast("timestamp").alias("ingested_at"),
        F.col("lang").alias("language"),
        sentiment_of(F.col("quality"), F.col("toxic")).alias("sentiment"),
        compact_json(F.struct(F.col("source").alias("source"), F.col("lang").alias("lang")))
        .alias("signals_json"),
        compact_json(F.struct("doc_id", "source", "lang")).alias("raw_json"),
        F.floor(F.col("doc_id") % 40 / 10).cast("long").alias("batch_id"),
    )
    x = x.select("*", item_id(F.col("platform"), F.col("url")).alias("id"),
                 content_hash(F.col("title"), F.col("summary")).alias("content_hash"),
                 F.col("ingested_at").alias("enriched_at"), F.lit(BINDING_MODEL).alias("enrich_model"),
                 F.lit("ok").alias("enrich_status"))
    return conform(x, extra=("seq", "batch_id"))


def tag_snapshot(items: DataFrame, taxonomy: Taxonomy = TEST_TAXONOMY) -> DataFrame:
    """Keyword topics, actors and editorial flag of the stored title and
    summary (the enrichment pass runs on upserted items, as in the
    reference); language and sentiment stay as the binding gave them."""
    x = items.select("*", tag_text(F.col("title"), F.col("summary")).alias("_text"))
    text = F.col("_text")
    x = x.drop("topics", "actors", "locations", "is_editorial", "tags_json").select(
        "*", keyword_topics(text, taxonomy).alias("topics"), keyword_actors(text, taxonomy).alias("actors"),
        empty_array().alias("locations"), keyword_editorial(text).alias("is_editorial"))
    x = x.select("*", tags_json(F.col("topics"), F.col("actors"), F.col("locations"), F.col("language"),
                                F.col("is_editorial"), F.col("sentiment")).alias("tags_json"))
    return x.select(*items.columns)


def media_items(spark: SparkSession, sf_dir: str, taxonomy: Taxonomy = TEST_TAXONOMY) -> DataFrame:
    """The item snapshot: the upsert fold (T1) of every observation, then
    the keyword pass over the stored text."""
    from ..operators.store import upsert_fold
    return tag_snapshot(upsert_fold(observations(spark, sf_dir, taxonomy)), taxonomy)
