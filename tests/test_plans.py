"""Plan regression: the physical plans keep the properties the design
relies on at scale (read pruning, no Python where none is needed,
per-group top-k before the shuffle, one Expand for the rollup, no nested
loop join over data-sized inputs)."""
import re

import __spark_entry__ as E

SMALL = "/root/testdata/sf0.001"


def _plan(spark, name):
    df = E.queries()[name](spark, SMALL)
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_rollup_reads_narrow_and_stays_in_jvm(spark):
    p = _plan(spark, "rollup_once")
    assert "Expand" in p
    assert "ArrowEvalPython" not in p          # no text cleaning needed for these counts
    docs = [m for m in re.findall(r"ReadSchema: struct<([^>]*)>", p) if m.startswith("doc_id")]
    assert docs and all("text" not in m for m in docs)


def test_window_filter_narrow(spark):
    p = _plan(spark, "items_since")
    assert "ArrowEvalPython" not in p and "SortAggregate" not in p


def test_seed_urls_limits_before_shuffle(spark):
    p = _plan(spark, "seed_urls")
    assert "WindowGroupLimit" in p


def test_no_nested_loop_over_data(spark):
    for name in ("upsert_items", "by_topic", "normalize_channel", "content_lookup", "cross_platform_dup"):
        p = _plan(spark, name)
        assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p, name


def test_cluster_conf_sizing():
    from covlens.session import cluster_conf
    c = cluster_conf(100 * 2 ** 40, 8000)
    n = int(c["spark.sql.shuffle.partitions"])
    assert n % 8000 == 0 and 100 * 2 ** 40 / n <= 256 * 2 ** 20
    assert int(cluster_conf(10, 8)["spark.sql.shuffle.partitions"]) == 8


def test_written_snapshot_prunes_dates(spark):
    df = E.queries()["snapshot_by_day"](spark, SMALL)
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*published_date", p)
