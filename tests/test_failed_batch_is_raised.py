"""A batch that fails is no result: the streaming queries raise it, and a
restart does the batch again."""
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from covlens.plans import queries_streaming as Q
from covlens.streaming import ingest as S
from test_stream_building import tables

RUN_AT = "2024-01-31 00:00:00"


def broken(*_):
    raise RuntimeError("an executor is away")


@pytest.mark.parametrize("name", ["stream_coverage", "stream_dedup", "stream_enrichment", "stream_ingest_rows", "stream_upsert_state"])
def test_a_query_does_not_outlive_a_failed_batch(spark, tmp_path, monkeypatch, name):
    tables(spark, tmp_path)
    fold, calls = S.ST.list_unenriched, []
    # the second arrival fails after it has written its log
    monkeypatch.setattr(S.ST, "list_unenriched", lambda items: broken() if calls else calls.append(1) or fold(items))
    with pytest.raises(Exception, match="an executor is away"):
        E.queries()[name](spark, str(tmp_path)).collect()
    assert calls


def test_a_restart_does_a_raised_batch_again(spark, tmp_path):
    d = tmp_path / "landing" / "doc=gdelt__0.json"
    d.mkdir(parents=True)
    (d / "part-0.txt").write_text('[{"url": "https://a.example.net/1", "title": "t"}]')
    log, snap, side, at = (str(tmp_path / x) for x in ("log", "snap", "side", "ck"))

    def run(enrich):
        S.run_ingest_stream(spark, str(tmp_path / "landing"), log, snap, at, F.lit(RUN_AT), side=side, enrich=enrich, keep_failed=False)
    with pytest.raises(Exception, match="an executor is away"):
        run(broken)
    assert S.latest_snapshot(spark, snap) is None and not S._exists(spark, f"{side}/failed")
    run(lambda items: Q.keyword_enrich(items, Q.TEST_TAXONOMY, F.lit(RUN_AT)))
    assert S.read_items(spark, log, snap).count() == S.enrichment_log(spark, side).count() == 1
