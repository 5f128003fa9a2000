"""Keyed item state without MERGE: upsert fold (T1), latest-per-key (W3),
enrichment/content application (J3, J4), pending list (P6), ingest state
(T4), ingest statistics (S9) and the written log/snapshot (S7).

The item table is an append-only observation log; the snapshot is a fold
over it.  Upsert semantics of the reference: the first observation of an
id supplies the protected fields (enrichment, content, signals, content
hash), the last supplies everything else (so `ingested_at` is the last
sighting and a later NULL title overwrites).  The fold is one hash
aggregation on `id` with map-side partial aggregation, so a hot id costs
no more than any other; there is no per-row lookup and no MERGE."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import CONTENT_COLUMNS, ENRICHMENT_COLUMNS, ITEM_COLUMNS, ITEM_SCHEMA, PROTECTED, UNPROTECTED

# A writing task holds a row group until it is full and a reading task holds it
# whole; items carry their texts, so an eighth of the usual size is some
# thousands of them.
ITEM_GROUP_BYTES = 16 << 20


def upsert_fold(obs: DataFrame, seq: str = "seq", whole: bool = False) -> DataFrame:
    """T1 over an observation log (any number of batches): one row per id.

    One min_by / max_by per column (seq is unique, so all come from the
    same observation).  Separate aggregates, rather than one struct, let
    Catalyst drop the ones a query never reads, and with them the
    upstream work that feeds them (cleaning, tagging).  They carry the seq
    once per column, though; with `whole`, for a caller that writes all
    columns, the two observations go as one struct each."""
    later = [c for c in UNPROTECTED if c != "id"]
    o = F.col(seq)
    columns = [c for c in ITEM_COLUMNS[1:] if c in obs.columns]
    totals = (F.count(F.lit(1)).alias("n_observations"), F.min(seq).alias("first_seq"), F.max(seq).alias("last_seq"))
    if whole:
        parts = {"_last": [c for c in columns if c in later], "_first": [c for c in columns if c not in later]}
        g = obs.groupBy("id").agg(*[pick(F.struct(*parts[p]), o).alias(p) for p, pick in (("_last", F.max_by), ("_first", F.min_by))
                                    if parts[p]], *totals)
        return g.select("id", *[F.col(f"{p}.{c}").alias(c) for c in columns for p in parts if c in parts[p]],
                        "n_observations", "first_seq", "last_seq")
    aggs = []
    for c in columns:
        pick = F.max_by(F.col(c), o) if c in later else F.min_by(F.col(c), o)
        aggs.append(pick.alias(c))
    g = obs.groupBy("id").agg(*aggs, *totals)
    return g.select("id", *columns, "n_observations", "first_seq", "last_seq")


def upsert_batch(snapshot: DataFrame, batch: DataFrame, seq: str = "seq", whole: bool = False):
    """T1 of one new batch into an existing snapshot.

    Returns (new_snapshot, stats) where stats has one row: inserted = ids
    new to the snapshot, updated = batch rows - inserted (every repeat of an
    id counts, as in the reference).  The result is a new snapshot; write it
    to a new directory, never over the one being read.  `whole` as in
    upsert_fold."""
    b = upsert_fold(batch, seq, whole)
    dated = "published_date" in snapshot.columns
    columns = [*ITEM_COLUMNS, *(["published_date"] if dated else [])]
    # Untouched rows pass as they stand, so a predicate on the published
    # date still prunes the snapshot's partitions below the anti join.
    untouched = snapshot.select(*columns).join(batch.select("id").distinct(), "id", "left_anti")
    held = snapshot.select("id", *[F.col(c).alias(f"_s_{c}") for c in ITEM_COLUMNS if c in PROTECTED],
                           F.lit(True).alias("_in_snap"))
    j = b.join(held, "id", "left")
    known = F.col("_in_snap").isNotNull()
    touched = j.select("id", *[F.when(known, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) if c in PROTECTED
                               else F.col(c) for c in ITEM_COLUMNS[1:]])
    if dated:
        touched = touched.withColumn("published_date", F.to_date("published_at"))
    new_snap = untouched.select(*columns).unionByName(touched.select(*columns))
    stats = (b.join(snapshot.select("id").withColumn("_hit", F.lit(1)), "id", "left")
             .agg(F.count_if(F.col("_hit").isNull()).alias("inserted"),
                  F.coalesce(F.sum("n_observations"), F.lit(0)).alias("rows"))
             .select("inserted", (F.col("rows") - F.col("inserted")).alias("updated")))
    return new_snap, stats


def latest_per_key(log: DataFrame, key: str = "id", order: str = "seq") -> DataFrame:
    """Last write wins per key (NULL values of the last write are kept)."""
    rest = [c for c in log.columns if c != key]
    g = log.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_r"))
    return g.select(key, *[F.col(f"_r.{c}").alias(c) for c in rest])


def apply_enrichment(items: DataFrame, enrichment_log: DataFrame, order: str = "seq") -> DataFrame:
    """Overwrite the enrichment columns of items from the latest
    enrichment per id; an enrichment for an unknown id is dropped."""
    e = latest_per_key(enrichment_log.select("id", order, *[c for c in ENRICHMENT_COLUMNS
                                                            if c in enrichment_log.columns]),
                       "id", order)
    have = set(e.columns)
    j = items.alias("i").join(e.alias("e").withColumn("_hit", F.lit(True)), "id", "left")
    hit = F.col("_hit").isNotNull()
    cols = []
    for c in items.columns:
        if c in ENRICHMENT_COLUMNS and c in have:
            cols.append(F.when(hit, F.col(f"e.{c}")).otherwise(F.col(f"i.{c}")).alias(c))
        elif c == "id":
            cols.append(F.col("id"))
        else:
            cols.append(F.col(f"i.{c}"))
    return j.select(*cols)


def apply_content(items: DataFrame, content_log: DataFrame, order: str = "seq") -> DataFrame:
    """Overwrite content_text/fetched_at/status from the latest content
    row per id; content_hash only when the content row carries one."""
    keep = ["id", order] + [c for c in (*CONTENT_COLUMNS, "content_hash") if c in content_log.columns]
    e = latest_per_key(content_log.select(*keep), "id", order)
    j = items.alias("i").join(e.alias("c").withColumn("_hit", F.lit(True)), "id", "left")
    hit = F.col("_hit").isNotNull()
    cols = []
    for c in items.columns:
        if c in CONTENT_COLUMNS and c in e.columns:
            cols.append(F.when(hit, F.col(f"c.{c}")).otherwise(F.col(f"i.{c}")).alias(c))
        elif c == "content_hash" and c in e.columns:
            cols.append(F.coalesce(F.when(F.col("c.content_hash") != "", F.col("c.content_hash")),
                                   F.col("i.content_hash")).alias(c))
        elif c == "id":
            cols.append(F.col("id"))
        else:
            cols.append(F.col(f"i.{c}"))
    return j.select(*cols)


def list_unenriched(items: DataFrame, enrichment_log: DataFrame | None = None,
                    limit: int | None = None) -> DataFrame:
    """Items not enriched yet (enriched_at NULL and no enrichment row),
    oldest ingested first, optional batch limit."""
    p = items.filter(F.col("enriched_at").isNull())
    if enrichment_log is not None:
        p = p.join(enrichment_log.select("id"), "id", "left_anti")
    if limit is not None:
        p = p.orderBy("ingested_at", "id").limit(limit)
    return p


def ingest_state(state_log: DataFrame) -> DataFrame:
    """T4: (source -> last_run_at, cursor), last write per source wins."""
    return latest_per_key(state_log.select("source", "seq", "last_run_at", "cursor"),
                          "source", "seq").select("source", "last_run_at", "cursor")


def ingest_stats(batch: DataFrame, snapshot_ids: DataFrame | None, source_col: str = "platform",
                 seq: str = "seq") -> DataFrame:
    """Per source: raw rows, inserted (first observation of an id new to
    the snapshot), updated (all other rows); plus a TOTAL row via rollup.

    Inside one batch a repeated id counts once as inserted and then as
    updated, as sequential upserts would.  Rows are pre-aggregated per
    (id, source) before anything keyed by id alone, so a hot id is
    collapsed map-side."""
    per = batch.groupBy("id", source_col).agg(F.count(F.lit(1)).alias("_n"), F.min(seq).alias("_s0"))
    first = per.groupBy("id").agg(F.min_by(F.col(source_col), F.col("_s0")).alias("_first_src"))
    b = per.join(first, "id")
    if snapshot_ids is not None:
        known = snapshot_ids.select("id").distinct().withColumn("_known", F.lit(True))
        b = b.join(known, "id", "left")
    else:
        b = b.withColumn("_known", F.lit(None).cast("boolean"))
    ins = (F.col(source_col) == F.col("_first_src")) & F.col("_known").isNull()
    r = (b.rollup(source_col)
         .agg(F.sum("_n").alias("raw"), F.count_if(ins).alias("inserted")))
    return r.select(F.coalesce(F.col(source_col), F.lit("TOTAL")).alias("source"),
                    F.col("raw").cast("long").alias("raw"), "inserted",
                    (F.col("raw") - F.col("inserted")).cast("long").alias("updated"))


def write_log(df: DataFrame, path: str, partition_by: str = "batch_id") -> None:
    """Append observations to the log, partitioned by batch.  Dynamic
    partition overwrite makes a replayed batch idempotent.  The rows are
    rebalanced: tasks and files follow the measured bytes of the batch (the
    session's advisory partition size), so a small batch is one file and a
    first load of any size stays as wide as it is."""
    (df.hint("rebalance").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("parquet.block.size", str(ITEM_GROUP_BYTES)).partitionBy(partition_by).parquet(path))


def write_snapshot(df: DataFrame, path: str) -> None:
    """Write a snapshot partitioned by published date (date predicates
    of the report then prune partitions), rebalanced by date: small dates
    share a task and give a file each (a few where they share it with a split
    one), a date beyond the advisory size is split between tasks."""
    (df.withColumn("published_date", F.to_date("published_at")).hint("rebalance", F.col("published_date"))
     .write.mode("overwrite").option("parquet.block.size", str(ITEM_GROUP_BYTES)).partitionBy("published_date").parquet(path))


def _keyed_table(path: str) -> str:
    return f"covlens_{hashlib.sha256(path.encode()).hexdigest()[:24]}"


def write_keyed_snapshot(df: DataFrame, path: str, buckets: int) -> None:
    """S7, the layout for a history that is large against its batches: one
    row per id, bucketed by id.  Batches then meet the snapshot bucket by
    bucket and the history is never shuffled (read_keyed_snapshot); the price
    is that a date predicate prunes row groups at best, not folders.  `path`
    must be new; the catalog entry is only how Spark is told of the buckets,
    the files are plain Parquet."""
    (df.select(*ITEM_COLUMNS).repartition(buckets, "id").write.mode("overwrite").format("parquet")
     .option("parquet.block.size", str(ITEM_GROUP_BYTES)).bucketBy(buckets, "id").sortBy("id").option("path", path).saveAsTable(_keyed_table(path)))


def read_keyed_snapshot(spark: SparkSession, path: str, buckets: int) -> DataFrame:
    """A snapshot of write_keyed_snapshot, known to the planner as bucketed
    by id also in a session that did not write it."""
    name = _keyed_table(path)
    if not spark.catalog.tableExists(name):
        quoted = path.replace("\\", "\\\\").replace("'", "\\'")
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ITEM_SCHEMA.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
                  f"CLUSTERED BY (id) SORTED BY (id) INTO {int(buckets)} BUCKETS LOCATION '{quoted}'")
    return spark.table(name)
