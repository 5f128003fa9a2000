"""Stream == batch: what the file-source stream leaves after two arrivals
(the even blocks, then all blocks) agrees with the batch results."""
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from covlens.config import TEST_REPORT
from covlens.operators import analytics as A
from covlens.operators import store as ST
from covlens.plans.queries_sources import all_sources
from covlens.plans.queries_streaming import _Run
from covlens.streaming import ingest as S

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def run(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return _Run(spark, SMALL)


def test_stream_snapshot_equals_batch(spark, run):
    items = S.read_items(spark, run.log, run.snap)
    ids = {r.id for r in all_sources(spark, SMALL).select("id").distinct().collect()}
    assert {r.id for r in items.collect()} == ids and items.count() == len(ids)
    log = spark.read.parquet(run.log)
    assert log.groupBy("id", "seq").count().filter("count > 1").count() == 0  # seq is unique per observation
    assert S.enrichment_log(spark, run.side).select("id").distinct().count() == len(ids)
    assert spark.read.parquet(f"{run.side}/state").select("source").distinct().count() == 4


def test_report_over_read_items_prunes_dates(spark, run):
    by_day = A.by_day(S.read_items(spark, run.log, run.snap), TEST_REPORT)
    plan = by_day._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" not in plan
    assert "published_date" in plan.split("PartitionFilters: [")[1].split("]")[0] or any(
        "published_date" in x.split("]")[0] for x in plan.split("PartitionFilters: [")[1:])


def test_delta_joins_the_snapshot(spark, run):
    """Snapshot of the first batch plus the newer log equals one fold of the whole log."""
    log = spark.read.parquet(run.log)
    first = ST.upsert_fold(log.filter("batch_id = 0"))
    merged, _ = ST.upsert_batch(first.select(*[c for c in first.columns if c not in ("n_observations", "first_seq", "last_seq")]),
                                log.filter("batch_id = 1"))
    whole = ST.upsert_fold(log).select(*merged.columns)
    assert merged.exceptAll(whole).count() == 0 and whole.exceptAll(merged).count() == 0


def test_failed_batch_is_kept_and_retried(spark, tmp_path):
    d = tmp_path / "landing" / "doc=gdelt__0.json"
    d.mkdir(parents=True)
    (d / "part-0.txt").write_text('[{"url": "https://a.example.net/1", "title": "t"}]')
    log, snap, side, at = (str(tmp_path / x) for x in ("log", "snap", "side", "ck"))

    def broken(pending):
        raise RuntimeError("model is away")
    S.run_ingest_stream(spark, str(tmp_path / "landing"), log, snap, at, F.lit("2024-01-31 00:00:00"), side=side, enrich=broken)
    failed = spark.read.parquet(f"{side}/failed").collect()
    assert len(failed) == 1 and "model is away" in failed[0].error
    S.retry_failed(spark, side, failed[0].batch_id, log, snap, F.lit("2024-01-31 00:00:00"))
    assert S.read_items(spark, log, snap).count() == 1


def test_coverage_counts_items_not_sightings(spark):
    n = E.queries()["stream_coverage"](spark, SMALL).agg(F.sum("n")).first()[0]
    assert n == all_sources(spark, SMALL).select("id").distinct().count()
