"""Streaming ingest.

The reference polls its sources every N minutes, upserts and tags.  Here
the landing folder is a file-source stream: every micro-batch parses the new
payload documents, normalises them, appends them to the observation log
(partition = batch id, written with dynamic partition overwrite, so a
replayed batch rewrites the same partition) and folds them into a new
snapshot version.  The checkpoint makes the stream exactly-once over files;
`availableNow` is the one-shot cycle, `processingTime` the periodic one.

R3 keeps the day counts of items current from their first sightings, R4
drops repeated ids inside a bounded horizon."""

from __future__ import annotations

import json
import logging
import re
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import coverage_day
from ..operators import normalize as N
from ..operators import store as ST
from ..operators.tagging import keyword_sentiment, tag_text
from ..sources import landing as L

PLATFORM_DIRS = ("gdelt", "mediastack", "rss", "youtube")


def landing_stream(spark: SparkSession, landing_dir: str, max_files: int | None = None, packed: bool = False) -> DataFrame:
    """One row per landed document: (path, text), each in its own character set.
    With `packed` the folder holds deliveries of `L.pack_documents`, many
    documents a file, else every file is a document."""
    r = (spark.readStream.format("parquet" if packed else "binaryFile")
         .schema(L.PACKED_SCHEMA if packed else L.DOCUMENT_SCHEMA).option("recursiveFileLookup", "true"))
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    return (L.packed_documents_of if packed else L.documents_of)(r.load(landing_dir))


def normalise_documents(docs: DataFrame, run_at, stats: DataFrame | None = None, registry: DataFrame | None = None):
    """Route landed documents by their platform folder and normalise them
    (S1-S5, N1-N4); returns the four item frames and the API errors.  A
    document lives under `.../<platform>/<name>` or in a folder named
    `doc=<platform>__<name>`; JSON documents of feeds and channels are keyed
    by feed, XML documents are named through the registry."""
    plat = F.coalesce(F.nullif(F.regexp_extract(F.col("path"), r"doc=([a-z]+)__", 1), F.lit("")),
                      F.regexp_extract(F.col("path"), r"/([a-z]+)/[^/]+$", 1))
    docs = docs.select("path", "text", plat.alias("_platform"))

    def part(p: str) -> DataFrame:
        # generated, so that predicates on the text stay above and do not decode it again
        return docs.filter(F.col("_platform") == p).select("path", F.explode(F.array("text")).alias("text"))

    def feeds(p: str) -> tuple[DataFrame, DataFrame]:
        is_xml = L.without_head(F.col("text")).startswith("<")
        return part(p).filter(~is_xml), L.name_feeds(part(p).filter(is_xml), p, registry)

    gd = N.normalize_discovery(L.parse_api_list(part("gdelt")), run_at)
    arts, errors = L.parse_aggregator_list(part("mediastack"))
    ms = N.normalize_aggregator(arts, run_at)
    json_docs, xml_docs = feeds("rss")
    keyed = L.parse_keyed_feeds(json_docs)
    xml = L.parse_feed_xml(xml_docs, F.col("feed_name"), F.col("feed_url"))
    rs = N.normalize_feed(keyed.unionByName(xml.select(*keyed.columns)), run_at)
    json_docs, xml_docs = feeds("youtube")
    keyed = L.parse_keyed_feeds(json_docs)
    xml = L.parse_channel_xml(xml_docs, F.col("feed_name"), F.col("channel_ref"))
    yt = N.normalize_channel(keyed.unionByName(xml.select(*keyed.columns)), run_at, stats)
    return gd, ms, rs, yt, errors


def snapshot_path(snapshot_root: str, version: int, buckets: int | None = None) -> str:
    """The folder of a version; one bucketed by id carries its bucket count."""
    return f"{snapshot_root.rstrip('/')}/v={version:08d}" + (f".b{buckets}" if buckets else "")


def _newest(spark: SparkSession, snapshot_root: str) -> tuple[int, int] | None:
    """(version, buckets or 0) of the newest complete snapshot (a version is
    complete once its _SUCCESS marker exists), or None."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(snapshot_root)
    fs = root.getFileSystem(conf)
    if not fs.exists(root):
        return None
    found = []
    for st in fs.listStatus(root):
        m = re.fullmatch(r"v=(\d+)(?:\.b(\d+))?", st.getPath().getName())
        if m and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            found.append((int(m[1]), int(m[2] or 0)))
    return max(found, default=None)


def latest_snapshot(spark: SparkSession, snapshot_root: str) -> int | None:
    """The newest complete snapshot version, or None."""
    newest = _newest(spark, snapshot_root)
    return None if newest is None else newest[0]


def _snapshot_of(spark: SparkSession, log_dir: str, snapshot_root: str, upto: int, whole: bool = False):
    """Latest snapshot folded with every log batch after it, up to `upto`;
    `whole` when all columns are to be written."""
    from ..schema import ITEM_COLUMNS
    newest = _newest(spark, snapshot_root)
    lg = spark.read.parquet(log_dir)
    if newest is None:
        first = ST.upsert_fold(lg.filter(F.col("batch_id") <= upto), whole=whole).select(*ITEM_COLUMNS)
        return first.withColumn("published_date", F.to_date("published_at"))
    prev, buckets = newest
    path = snapshot_path(snapshot_root, prev, buckets)
    held = ST.read_keyed_snapshot(spark, path, buckets) if buckets else spark.read.parquet(path)
    delta = lg.filter((F.col("batch_id") > prev) & (F.col("batch_id") <= upto))
    snap, _ = ST.upsert_batch(held, delta, whole=whole)
    return snap


def read_items(spark: SparkSession, log_dir: str, snapshot_root: str) -> DataFrame:
    """The current item table: the latest compacted snapshot plus the log
    batches written since (a fold over the small delta only)."""
    return _snapshot_of(spark, log_dir, snapshot_root, 2 ** 62)


def _side(df: DataFrame, side: str, name: str, batch_id: int) -> None:
    """One partition per batch of a side table; a replayed batch rewrites it."""
    ST.write_log(df.withColumn("batch_id", F.lit(batch_id).cast("long")), f"{side.rstrip('/')}/{name}")


def ingest_batch(spark: SparkSession, docs: DataFrame, batch_id: int, log_dir: str, snapshot_root: str,
                 run_at, stats: DataFrame | None = None, compact_every: int = 1, side: str | None = None,
                 registry: DataFrame | None = None, enrich=None, buckets: int | None = None, packed: bool = False) -> None:
    """R1 + R2 for one micro-batch: normalise and append to the log (cost
    proportional to the batch).  Every `compact_every` batches the log
    since the last snapshot is folded into a new snapshot version, written
    to a new folder; readers combine the latest snapshot with the newer log
    batches (read_items), so compaction can run as rarely as the history
    size requires.  With `buckets` a version is bucketed by id, so that neither
    readers nor the next compaction shuffle it; without, it is partitioned
    by date.  Versions of both layouts can follow each other.

    With a `side` folder the cycle also writes, one partition per batch:
    `errors` (API error payloads), `enrichment` (what `enrich` gives for the
    batch's items that have none yet) and `state` (last run and newest
    document per source).

    Landed single files are opened once and kept for all branches.  `packed`
    documents are scanned again by each branch instead, which costs less than
    keeping them: a delivery of any size then takes no memory."""
    if docs.select("path").isEmpty():
        return
    if not packed:
        docs = docs.persist()
    try:
        gd, ms, rs, yt, errors = normalise_documents(docs, run_at, stats, registry)
        ST.write_log(N.union_sources(batch_id, gdelt=gd, mediastack=ms, rss=rs, youtube=yt), log_dir)
        if side:
            _side(errors, side, "errors", batch_id)
            seen = spark.read.parquet(log_dir).filter(F.col("batch_id") == batch_id)
            _side(seen.groupBy(F.col("platform").alias("source")).agg(
                F.max("seq.file").alias("cursor"), F.max("ingested_at").alias("last_run_at")).withColumn(
                "seq", F.lit(batch_id).cast("long")), side, "state", batch_id)
            if enrich is not None:
                done = enrichment_log(spark, side, batch_id)
                if done is not None:  # before the fold, so that known items are not shuffled for it
                    seen = seen.join(done.select("id"), "id", "left_anti")
                pending = ST.list_unenriched(ST.upsert_fold(seen))
                _side(enrich(pending), side, "enrichment", batch_id)
    finally:
        if not packed:
            docs.unpersist()
    prev = latest_snapshot(spark, snapshot_root)
    if prev is not None and prev >= batch_id:
        return  # replay of a batch whose snapshot is already written
    if (batch_id + 1) % max(1, compact_every) != 0:
        return
    new, path = _snapshot_of(spark, log_dir, snapshot_root, batch_id, whole=True), snapshot_path(snapshot_root, batch_id, buckets)
    if buckets:
        ST.write_keyed_snapshot(new, path, buckets)
    else:
        ST.write_snapshot(new, path)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def enrichment_log(spark: SparkSession, side: str, before: int | None = None) -> DataFrame | None:
    """The enrichment rows written so far (of batches before `before`)."""
    path = f"{side.rstrip('/')}/enrichment"
    if not _exists(spark, path):
        return None
    rows = spark.read.parquet(path)
    return rows if before is None else rows.filter(F.col("batch_id") < before)


def run_ingest_stream(spark: SparkSession, landing_dir: str, log_dir: str, snapshot_root: str,
                      checkpoint: str, run_at, stats: DataFrame | None = None,
                      trigger: dict | None = None, max_files: int | None = None, compact_every: int = 1,
                      side: str | None = None, registry: DataFrame | None = None, enrich=None, buckets: int | None = None,
                      packed: bool = False, keep_failed: bool = True):
    """Start (and for availableNow, finish) the ingest stream over a folder of
    single documents, or of packed ones (`landing_stream`).  With a `side`
    folder a failing batch does not stop the loop: its documents and the
    error are kept under `failed`, from where `retry_failed` ingests them, and
    the error is logged.  What the stream wrote then lacks that batch, so a
    caller that takes it for the result sets `keep_failed` to False: the
    failure ends the stream and is raised (by availableNow here, else by
    awaitTermination), and a restart does the batch again."""
    docs = landing_stream(spark, landing_dir, max_files, packed)

    def each(df: DataFrame, batch_id: int) -> None:
        try:
            ingest_batch(spark, df, batch_id, log_dir, snapshot_root, run_at, stats, compact_every, side, registry, enrich, buckets, packed)
        except Exception as e:  # noqa: BLE001  the cycle's own boundary
            if not (side and keep_failed):
                raise
            logging.getLogger(__name__).error("batch %d failed and is kept under %s/failed: %s", batch_id, side, e)
            _side(df.withColumn("error", F.lit(f"{type(e).__name__}: {e}"[:2000])), side, "failed", batch_id)
    q = (docs.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
         .trigger(**(trigger or {"availableNow": True})).start())
    if (trigger or {"availableNow": True}).get("availableNow"):
        q.awaitTermination()
    return q


def retry_failed(spark: SparkSession, side: str, batch_id: int, log_dir: str, snapshot_root: str, run_at, **kw) -> None:
    """Ingest the documents of a failed batch again, under their batch id."""
    rows = spark.read.parquet(f"{side.rstrip('/')}/failed").filter(F.col("batch_id") == batch_id)
    ingest_batch(spark, rows.select("path", "text"), batch_id, log_dir, snapshot_root, run_at, side=side, **kw)


_SEQ = ("batch", "src", "file", "pos")
_FACTS = ("day", "platform", "sentiment")
_INCREMENT = "id string, day string, platform string, sentiment string, n bigint"
_HELD = "held binary"


def _first_sightings(horizon_ms: int):
    """The state of a group of ids is, per id, its earliest sighting (by
    `seq`) with what it counts as, and until when it is held.  A sighting that
    comes later but lies earlier takes its place: the old one is retracted
    (-1) and the new one counted (+1)."""
    import pandas as pd

    def update(key, batches, state):
        held = {e[0]: (e[1], tuple(e[2:])) for e in json.loads(zlib.decompress(bytes(state.get[0])))} if state.exists else {}
        seen: dict = {}
        if not state.hasTimedOut:
            for pdf in batches:
                at = pdf["ingested_at"].map(lambda t: int(t.timestamp() * 1000))
                for i, until, *row in zip(pdf["id"], at + horizon_ms, *(pdf[c] for c in (*_SEQ, *_FACTS))):
                    row = (int(row[0]), int(row[1]), row[2], int(row[3]), *row[4:])
                    if i in seen:
                        until, row = max(until, seen[i][0]), min(row, seen[i][1], key=lambda r: r[:len(_SEQ)])
                    seen[i] = (int(until), row)
        now = state.getCurrentWatermarkMs()
        kept = {i: h for i, h in held.items() if i in seen or h[0] > now}
        changes = []
        for i, (until, row) in seen.items():
            old_until, old = kept.get(i, (until, None))
            best = row if old is None or row[:len(_SEQ)] < old[:len(_SEQ)] else old
            kept[i] = (max(until, old_until, now + 1), best)
            if best != old:
                changes += [(i, *old[len(_SEQ):], -1)] if old is not None else []
                changes.append((i, *best[len(_SEQ):], 1))
        if kept:
            state.update((zlib.compress(json.dumps([(i, until, *row) for i, (until, row) in kept.items()]).encode(), 1),))
            state.setTimeoutTimestamp(min(until for until, _ in kept.values()))
        elif state.exists:
            state.remove()
        if changes:
            yield pd.DataFrame(changes, columns=["id", *_FACTS, "n"])
    return update


def coverage_increments(log: DataFrame, horizon_days: int = 31, groups: int = 4096) -> DataFrame:
    """Changes of the coverage (id, day, platform, sentiment, n = +1 or
    -1), whose sum counts each item once, at its first sighting in the log's
    total order, however the files of the log are dealt to micro-batches and
    tasks.  An id's state is dropped when it was not seen for the horizon of
    ingestion time; the watermark follows our own clock, so an item dated in
    the future moves nothing.

    The state is kept for `groups` groups of ids by their hash: a call to
    Python costs milliseconds, so one per id would be the whole cost.  A group
    is read and written whole when one of its ids is seen; choose `groups` so
    that it holds some thousands of ids at most.  It is fixed for the life of
    a checkpoint."""
    text = tag_text(F.col("title"), F.col("summary"))
    rows = log.select("id", *[F.col(f"seq.{c}").alias(c) for c in _SEQ], "ingested_at",
                      coverage_day(F.col("published_at"), F.col("ingested_at")).alias("day"), "platform",
                      keyword_sentiment(text).alias("sentiment"),
                      F.pmod(F.xxhash64("id"), F.lit(groups)).alias("_group"))
    return (rows.withWatermark("ingested_at", f"{horizon_days} days").groupBy("_group")
            .applyInPandasWithState(_first_sightings(horizon_days * 86_400_000), _INCREMENT, _HELD, "update", "EventTimeTimeout"))


def dedup_stream(log: DataFrame, horizon: str = "1 day") -> DataFrame:
    """One row per id within a bounded horizon of ingestion time."""
    return log.withWatermark("ingested_at", horizon).dropDuplicatesWithinWatermark(["id"])
