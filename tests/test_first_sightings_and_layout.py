"""First sightings in a stream, as-of statistics, the feed registry, date parts and the written layout."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from covlens.functions.time import parse_timestamp
from covlens.operators import normalize as N
from covlens.operators import store as ST
from covlens.sources import landing as L
from covlens.streaming import ingest as S

LOG = ("id string, title string, summary string, platform string, published_at timestamp, ingested_at timestamp, "
       "seq struct<batch: bigint, src: int, file: string, pos: bigint>, batch_id bigint")


def sighting(i, day, batch, file, pos, platform="rss"):
    at = dt.datetime(2024, 1, day, 12)
    return (f"i{i}", "a title", "text", platform, at, dt.datetime(2024, 2, 1), (batch, 0, file, pos), batch)


def coverage(spark, path, deliveries):
    """Sum of the increments after each delivery of log rows, and the rows that each emitted."""
    log, out, sums, sizes = f"{path}/log", f"{path}/out", [], []
    for k, rows in enumerate(deliveries):
        spark.createDataFrame(rows, LOG).repartition(3).write.mode("append").parquet(log)
        stream = S.coverage_increments(spark.readStream.schema(LOG).parquet(log))

        def keep(df, batch_id, k=k):
            df.write.mode("overwrite").parquet(f"{out}/run={k}-{batch_id}")
        q = (stream.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{path}/ck")
             .trigger(availableNow=True).start())
        q.awaitTermination()
        got = spark.read.parquet(out)
        sizes.append(got.count())
        sums.append({(r["day"], r["platform"]): r["n"] for r in
                     got.groupBy("day", "platform").agg(F.sum("n").alias("n")).where("n <> 0").collect()})
    return sums, sizes


def test_a_late_earlier_sighting_takes_the_place_of_the_first(spark, tmpdir_path):
    late = [sighting(1, 3, 0, "a", 1), sighting(2, 9, 2, "a", 1)]
    sums, sizes = coverage(spark, tmpdir_path, [[sighting(1, 5, 1, "a", 1), sighting(1, 6, 1, "a", 2), sighting(2, 7, 1, "b", 1)], late])
    assert sums == [{("2024-01-05", "rss"): 1, ("2024-01-07", "rss"): 1}, {("2024-01-03", "rss"): 1, ("2024-01-07", "rss"): 1}]
    assert sizes == [2, 4]  # the second delivery gave one retraction and one correction


@pytest.mark.parametrize("seed", [1, 2])
def test_coverage_does_not_depend_on_the_order_of_the_log(spark, tmpdir_path, seed):
    rng = random.Random(7)
    rows = [sighting(rng.randrange(25), rng.randrange(1, 28), rng.randrange(3), rng.choice("abc"), p, rng.choice(["rss", "gdelt"]))
            for p in range(120)]
    first = {}
    for r in sorted(rows, key=lambda r: r[6]):
        first.setdefault(r[0], (r[4].strftime("%Y-%m-%d"), r[3]))
    want = {k: list(first.values()).count(k) for k in set(first.values())}
    random.Random(seed).shuffle(rows)
    assert coverage(spark, tmpdir_path, [rows[:50], rows[50:]])[0][-1] == want


def test_statistics_are_the_newest_before_the_run(spark):
    entries = spark.createDataFrame([({"video_id": v},) for v in ("a", "b", "c", "", "a")], "entry map<string,string>")
    at = lambda d: dt.datetime(2024, 1, d)
    log = spark.createDataFrame([("a", at(1), 1, 1, None), ("a", at(5), 7, 2, 3), ("a", at(9), 99, 9, 9), ("b", at(9), 4, 4, 4), (None, at(1), 5, 5, 5)],
                                "video_id string, fetched_at timestamp, views int, likes int, comments int")
    got = sorted((r["entry"]["video_id"], tuple(sorted(r["metrics"].items()))) for r in
                 N.video_stats_join(entries, log, F.lit("2024-01-06")).collect())
    seven = (("comments", 3), ("likes", 2), ("views", 7))
    assert got == [("", ()), ("a", seven), ("a", seven), ("b", ()), ("c", ())]
    assert N.video_stats_join(entries, log.drop("fetched_at")).count() == 5
    assert N.video_stats_join(entries, log.limit(0)).count() == 5


def test_a_feed_listed_twice_names_each_document_once(spark):
    docs = spark.createDataFrame([("landing/rss/f-1.xml", "<rss/>"), ("landing/rss/g-1.xml", "<rss/>")], "path string, text string")
    feeds = spark.createDataFrame([("rss", "f", "Old", "u1", None, 1), ("rss", "f", "New", "u2", None, 2), ("rss", None, "x", "y", None, 3)],
                                  "platform string, key string, name string, url string, channel_id string, updated_at int")
    for registry, name in ((feeds, "New"), (feeds.drop("updated_at"), "Old")):
        got = {r["path"]: (r["feed_name"], r["feed_url"]) for r in L.name_feeds(docs, "rss", registry).collect()}
        assert got["landing/rss/f-1.xml"][0] == name and len(got) == 2 == L.name_feeds(docs, "rss", registry).count()


DATES = {
    "Fri, 23 Jan 26 04:05:06 GMT": "2026-01-23 04:05:06", "Fri Jan 23 04:05:06 2026": "2026-01-23 04:05:06",
    "23/01/2026 10:00": "2026-01-23 10:00:00", "01/23/2026": "2026-01-23 00:00:00", "20260123": "2026-01-23 00:00:00",
    "23-Jan-2026": "2026-01-23 00:00:00", "2026.01.23": "2026-01-23 00:00:00", "Jan 23, 2026 4:05 PM": "2026-01-23 16:05:00",
    "23 January 2026 12:00 a.m.": "2026-01-23 00:00:00", "Fri, 23 Jan 2026 04:05:06 EST": "2026-01-23 09:05:06",
    "Friday, January 23rd, 2026 4:05:06 pm PST": "2026-01-24 00:05:06", "Fri Jan 23 04:05:06 UTC 2026": "2026-01-23 04:05:06",
    "Fri Jan 23 04:05:06 +0200 2026": "2026-01-23 02:05:06", "3.4.2026": "2026-03-04 00:00:00", "1/2/99": "1999-01-02 00:00:00",
    "10:00 23-01-2026": "2026-01-23 10:00:00", "2026 Jan 23": "2026-01-23 00:00:00", "25/12/2026 11:59 pm": "2026-12-25 23:59:00",
    "30 Feb 2026": None, "13:61 23 Jan 2026": None, "99/99/2026": None, "not a date": None, "May": None, "": None, " ": None, None: None,
    "x" * 100_000: None,
}


def test_dates_are_read_by_their_parts(spark):
    df = spark.createDataFrame([(k,) for k in DATES], "s string")
    got = {r["s"]: r["t"] for r in df.select("s", F.date_format(parse_timestamp(F.col("s")), "yyyy-MM-dd HH:mm:ss").alias("t")).collect()}
    assert got == DATES


def test_written_files_follow_the_bytes(spark, tmpdir_path):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    rows = spark.range(60_000).select(F.sha2(F.col("id").cast("string"), 256).alias("id"), F.lit(1).cast("bigint").alias("batch_id"), F.when(
        F.col("id") > 20, F.lit("2024-01-01")).otherwise(F.concat(F.lit("2024-02-0"), (F.col("id") % 9 + 1).cast("string"))).cast("timestamp")
        .alias("published_at"))
    try:
        spark.conf.set(name, "256k")
        ST.write_snapshot(rows.repartition(16), f"{tmpdir_path}/snap")
        ST.write_log(rows.repartition(16), f"{tmpdir_path}/log")
        ST.write_log(rows.limit(30).repartition(8), f"{tmpdir_path}/small")
    finally:
        spark.conf.set(name, before)
    files = {r["published_date"].isoformat(): r["n"] for r in spark.read.parquet(f"{tmpdir_path}/snap").select(
        "published_date", "_metadata.file_path").groupBy("published_date").agg(
        F.count_distinct("file_path").alias("n")).collect()}
    assert files.pop("2024-01-01") > 4 and sum(files.values()) < 18 and len(files) == 9
    count = lambda p: spark.read.parquet(p).select("_metadata.file_path").distinct().count()
    assert count(f"{tmpdir_path}/log") > 4 and count(f"{tmpdir_path}/small") == 1
    assert spark.read.parquet(f"{tmpdir_path}/snap").count() == spark.read.parquet(f"{tmpdir_path}/log").count() == 60_000
