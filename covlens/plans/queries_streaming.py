"""Registered queries for written tables and streaming.

Each query lands the payloads Spark derives from the test tables into a
fresh folder under the shared checkpoint directory, runs the stream there
and returns what it wrote.  The oracles are the batch results, so a match
means stream == batch."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..config import TEST_TAXONOMY
from ..functions.text import clean_text
from ..operators.tagging import keyword_enrich
from ..session import ensure_checkpoint_dir
from ..sources import derived as D
from ..sources import landing as L
from ..streaming import ingest as S
from . import oracle as O
from .queries import ORACLES, register
from .queries_sources import RAW, RUN_TS, _ne


def _scratch(spark) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/covlens-{uuid.uuid4().hex[:12]}"


def _stored(df, path: str, *by: str):
    """`df` written once and read back, for what several steps read; in
    folders `by` the columns that they choose their rows by.  Row groups are
    those of a packed delivery, as the rows can be whole documents."""
    df.write.partitionBy(*by).option("parquet.block.size", str(L.PACKED_GROUP_BYTES)).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _documents(spark, sf, base: str):
    """The payload documents (path, text, block), from one pass over the tables."""
    rows = _stored(D.raw_rows(spark, sf), f"{base}/rows", "platform")
    docs = [
        D.discovery_payloads(spark, sf, rows), D.aggregator_payloads(spark, sf, rows), D.aggregator_errors(spark, sf, rows),
        D.keyed_feed_payloads(spark, sf, rows), D.rss_xml_payloads(spark, sf, rows).select("path", "text"),
        D.channel_xml_payloads(spark, sf, rows).select("path", "text"), D.keyed_channel_payloads(spark, sf, rows),
    ]
    allp = docs[0]
    for d in docs[1:]:
        allp = allp.unionByName(d)
    block = F.regexp_extract("path", r"([0-9]+)\.(json|xml)$", 1).cast("long")
    return _stored(allp.select("path", "text", block.alias("block")), f"{base}/documents")


def _land(docs, landing: str, delivery: int, even_only: bool) -> None:
    """Land the payload documents as one packed delivery, each under a path of
    its own with a folder per delivery and document."""
    if even_only:
        docs = docs.filter(F.col("block") % 2 == 0)
    doc = F.regexp_replace(F.regexp_replace("path", "^landing/", ""), "/", "__")
    L.pack_documents(docs.select(F.concat(F.lit(f"delivery={delivery}/doc="), doc, F.lit("/")).alias("path"),
                                 F.encode("text", "UTF-8").alias("content")), landing)


class _Run:
    """Two arrivals through the stream: the even blocks, then all blocks (the
    even ones for the second time); one availableNow run each.  A batch that
    fails is raised, as the queries return what both have written."""

    def __init__(self, spark, sf, compact_every: int = 2, buckets: int | None = None):
        base = _scratch(spark)
        self.log, self.snap, self.side = f"{base}/log", f"{base}/snapshot", f"{base}/side"
        docs = _documents(spark, sf, base)
        stats = _stored(D.video_stats(spark, sf), f"{base}/stats")
        registry = _stored(D.feed_registry(spark, sf), f"{base}/registry")
        for delivery, even_only in ((0, True), (1, False)):
            _land(docs, f"{base}/landing", delivery, even_only)
            S.run_ingest_stream(spark, f"{base}/landing", self.log, self.snap, f"{base}/_ck", F.lit(RUN_TS), stats,
                                compact_every=compact_every, side=self.side, registry=registry, buckets=buckets, packed=True,
                                keep_failed=False, enrich=lambda p: keyword_enrich(p, TEST_TAXONOMY, F.lit(RUN_TS)))


_U = RAW + """, u AS (
  SELECT platform, CASE WHEN platform = 'youtube' THEN 'https://www.youtube.com/watch?v=v' || CAST(doc_id AS VARCHAR)
                        ELSE url END AS url, ts, block, doc_id, source, t_raw, s_raw FROM raw)
"""

# Sightings in the stream's order: batch, source, file path, place of the feed in the file, place of the entry.
_SEEN = _U + """, seen AS (
  SELECT u.*, b.batch, sha256(platform || '|' || url) AS id,
    platform || '__' || CASE WHEN platform IN ('rss', 'youtube') AND block % 2 = 1
      THEN source || '-' || CAST(block AS VARCHAR) || '.xml/' ELSE CAST(block AS VARCHAR) || '.json/' END AS file,
    CASE WHEN platform IN ('rss', 'youtube') AND block % 2 = 0 THEN source ELSE '' END AS feed
  FROM u JOIN (VALUES (0), (1)) b(batch) ON b.batch = 1 OR u.block % 2 = 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY batch, file, feed, doc_id) AS f,
            row_number() OVER (PARTITION BY id ORDER BY batch DESC, file DESC, feed DESC, doc_id DESC) AS l FROM seen)
"""


@register("stream_ingest", _SEEN + """
SELECT platform, count(*) AS n_rows, count(DISTINCT id) AS n_ids FROM seen GROUP BY platform""")
def q_stream_ingest(spark, sf):
    """Two arrivals through the file-source stream into the log."""
    lg = spark.read.parquet(_Run(spark, sf).log)
    return lg.groupBy("platform").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("id").alias("n_ids"))


@register("stream_ingest_rows", _SEEN + """
SELECT CAST(batch AS BIGINT) AS batch_id, platform, id, url FROM seen""")
def q_stream_ingest_rows(spark, sf):
    """The rows that the stream wrote to the log, batch by batch."""
    return spark.read.parquet(_Run(spark, sf).log).select(F.col("batch_id").cast("long").alias("batch_id"), "platform", "id", "url")


@register("ingest_errors", RAW + """
SELECT batch, 'rate_limit_reached' AS code, 'limit after ' || CAST(n AS VARCHAR) || ' articles' AS message
FROM (SELECT block, count(*) AS n FROM raw WHERE platform = 'mediastack' AND block % 3 = 1 GROUP BY block) e
JOIN (VALUES (0), (1)) b(batch) ON b.batch = 1 OR block % 2 = 0""")
def q_ingest_errors(spark, sf):
    """S2 + R1: the API error answers that the cycles met."""
    return spark.read.parquet(f"{_Run(spark, sf).side}/errors").select(
        F.col("batch_id").cast("int").alias("batch"), "code", "message")


@register("stream_ingest_state", _SEEN + f"""
SELECT platform AS source, '{RUN_TS}' AS last_run_at, arg_max(file, file) AS newest FROM seen WHERE batch = 1 GROUP BY platform""")
def q_stream_ingest_state(spark, sf):
    """T4: the state rows that the cycles wrote, last write per source."""
    from ..operators.store import ingest_state
    s = ingest_state(spark.read.parquet(f"{_Run(spark, sf).side}/state"))
    newest = F.regexp_extract("cursor", r"doc=([^/]+/)", 1)
    return s.select("source", F.date_format("last_run_at", "yyyy-MM-dd HH:mm:ss").alias("last_run_at"),
                    newest.alias("newest"))


@register("stream_enrichment", _SEEN + f"""
, first_text AS (SELECT p.id, lower(coalesce({_ne('t_raw')}, '') || ' ' || CASE WHEN platform = 'gdelt' THEN '' ELSE coalesce({_ne('s_raw')}, '') END) AS ttext
                 FROM (SELECT *, row_number() OVER (PARTITION BY id, batch ORDER BY file DESC, feed DESC, doc_id DESC) AS lb,
                              min(batch) OVER (PARTITION BY id) AS b0 FROM seen) p WHERE batch = b0 AND lb = 1)
SELECT id, array_to_string({O.topics_sql('ttext', TEST_TAXONOMY)}, ',') AS topics FROM first_text""")
def q_stream_enrichment(spark, sf):
    """P6 + E6 inside the cycle: every item tagged once, in the cycle that
    first saw it."""
    e = spark.read.parquet(f"{_Run(spark, sf).side}/enrichment")
    return e.select("id", F.array_join("topics", ",").alias("topics"))


@register("stream_upsert_state", _SEEN + f"""
SELECT l.id, l.platform, {_ne('l.t_raw')} AS title, strftime(l.ts, '%Y-%m-%d %H:%M:%S') AS published,
  sha256(substring(coalesce({_ne('f.t_raw')}, ''), 1, 200) || '||' || CASE WHEN f.platform = 'gdelt' THEN ''
    ELSE substring(coalesce({_ne('f.s_raw')}, ''), 1, 200) END) AS content_hash
FROM placed l JOIN placed f ON f.id = l.id AND f.f = 1 WHERE l.l = 1""")
def q_stream_upsert_state(spark, sf):
    """R2: the item rows the stream leaves behind equal the batch fold."""
    r = _Run(spark, sf, compact_every=2)
    s = S.read_items(spark, r.log, r.snap)
    return s.select("id", "platform", "title", F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published"),
                    "content_hash")


@register("stream_upsert_keyed", ORACLES["stream_upsert_state"])
def q_stream_upsert_keyed(spark, sf):
    """R2 + T1 with a snapshot bucketed by id: written after the first cycle,
    met bucket by bucket by the log of the second."""
    r = _Run(spark, sf, compact_every=1, buckets=8)
    s = S.read_items(spark, r.log, r.snap)
    return s.select("id", "platform", "title", F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published"),
                    "content_hash")


@register("scan_feed_charsets", RAW + f"""
SELECT source || '_nasional' AS feed_name, NULLIF(url, '') AS link, {_ne('t_raw')} AS title FROM raw
WHERE platform = 'rss' AND block % 2 = 1""")
def q_scan_feed_charsets(spark, sf):
    """S4 by bytes: the feed documents landed in UTF-16 with a mark (block 1
    of every 8), UTF-16 without one (block 3), ISO-8859-1 named by the prolog
    where its letters suffice (block 5), and UTF-8; read back in their own
    character sets they give the entries of their UTF-8 twins."""
    x = D.rss_xml_payloads(spark, sf)
    block = F.regexp_extract("path", r"-([0-9]+)\.xml$", 1).cast("long")
    plain, named = F.regexp_replace("text", "^\uFEFF", ""), 'encoding="{}"'
    data = (F.when(block % 8 == 1, F.encode(plain, "UTF-16"))
            .when(block % 8 == 3, F.encode(F.replace(plain, F.lit(named.format("UTF-8")), F.lit(named.format("UTF-16"))), "UTF-16LE"))
            .when((block % 8 == 5) & ~plain.rlike(r"[^\x00-\x7F\xA0-\xFF]"),
                  F.encode(F.replace(plain, F.lit(named.format("UTF-8")), F.lit(named.format("iso-8859-1"))), "ISO-8859-1"))
            .otherwise(F.encode("text", "UTF-8")))
    landing = f"{_scratch(spark)}/landing"
    # the text writer passes a string's bytes as they are
    (x.select(F.concat_ws("__", "feed_name", block).alias("doc"), data.cast("string").alias("value"))
     .repartition("doc").write.partitionBy("doc").text(landing))
    docs = L.read_documents(spark, landing)
    e = L.parse_feed_xml(docs, F.regexp_extract("path", r"doc=(.+)__[0-9]+/", 1), F.lit(None).cast("string"))
    title = clean_text(F.col("entry")["title"])
    return e.select("feed_name", F.col("entry")["link"].alias("link"), F.nullif(title, F.lit("")).alias("title"))


@register("stream_coverage", _SEEN + f"""
, x AS (SELECT platform, strftime(coalesce(ts, TIMESTAMP '{RUN_TS}'), '%Y-%m-%d') AS day FROM placed WHERE f = 1)
SELECT day, platform, count(*) AS n FROM x GROUP BY 1, 2""")
def q_stream_coverage(spark, sf):
    """Day x platform counts of items, kept by a stream over the
    observation log, although the even blocks were delivered twice."""
    log = _Run(spark, sf).log
    base = _scratch(spark)
    out = f"{base}/coverage"
    stream = S.coverage_increments(spark.readStream.schema(spark.read.parquet(log).schema).parquet(log))

    def keep(df, batch_id):
        (df.groupBy("day", "platform", "sentiment").agg(F.sum("n").alias("n"))
         .write.mode("overwrite").parquet(f"{out}/batch={batch_id}"))
    q = (stream.writeStream.outputMode("update").foreachBatch(keep)
         .option("checkpointLocation", f"{base}/_ck_cov").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out).groupBy("day", "platform").agg(F.sum("n").alias("n")).where("n <> 0")


@register("stream_dedup", _U + """
SELECT platform, count(DISTINCT sha256(platform || '|' || url)) AS n FROM u GROUP BY platform""")
def q_stream_dedup(spark, sf):
    """Repeated ids dropped within the watermark horizon."""
    return _deduplicated(spark, sf).groupBy("platform").agg(F.count(F.lit(1)).alias("n"))


@register("stream_dedup_rows", _U + """
SELECT DISTINCT platform, sha256(platform || '|' || url) AS id FROM u""")
def q_stream_dedup_rows(spark, sf):
    """The ids that are left, each once."""
    return _deduplicated(spark, sf).select("platform", "id")


def _deduplicated(spark, sf):
    log = _Run(spark, sf).log
    base = _scratch(spark)
    out = f"{base}/dedup"
    stream = S.dedup_stream(spark.readStream.schema(spark.read.parquet(log).schema).parquet(log))
    q = (stream.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", f"{base}/_ck_dd").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)


@register("write_items", """
WITH b AS (SELECT CAST((doc_id % 40) // 10 AS BIGINT) AS batch_id FROM documents)
SELECT batch_id, count(*) AS n FROM b GROUP BY batch_id""")
def q_write_items(spark, sf):
    """The observation log written partitioned by batch and read back
    (partition pruning keeps the read to the batches asked for)."""
    from ..operators.store import write_log
    from ..sources.binding import observations
    base = _scratch(spark)
    write_log(observations(spark, sf), f"{base}/log")
    return spark.read.parquet(f"{base}/log").groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))


@register("written_rows", O.with_binding("""
SELECT batch_id, seq, id, platform, url, title, summary, strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published,
       language, sentiment, content_hash
FROM obs"""))
def q_written_rows(spark, sf):
    """The observation log's rows after writing and reading back."""
    from ..operators.store import write_log
    from ..sources.binding import observations
    base = _scratch(spark)
    write_log(observations(spark, sf), f"{base}/log")
    return spark.read.parquet(f"{base}/log").select(
        F.col("batch_id").cast("long").alias("batch_id"), "seq", "id", "platform", "url", "title", "summary",
        F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published"), "language", "sentiment", "content_hash")


@register("snapshot_by_day", None)
def q_snapshot_by_day(spark, sf):
    """S7 + A8: the snapshot written partitioned by published date, read
    back, and the day rollup run on it (the window predicate prunes date
    partitions)."""
    from ..config import TEST_REPORT
    from ..operators import analytics as A
    from ..operators.store import write_snapshot
    from ..sources.binding import media_items
    base = _scratch(spark)
    write_snapshot(media_items(spark, sf), f"{base}/snapshot")
    return A.by_day(spark.read.parquet(f"{base}/snapshot"), TEST_REPORT)


ORACLES["snapshot_by_day"] = ORACLES["by_day"]
