"""What the streaming queries build is read and cleaned once."""
import datetime as dt

from pyspark.sql import functions as F

from covlens.functions.text import TAG_RE
from covlens.operators.normalize import _or_none
from covlens.plans import queries_streaming as Q
from covlens.sources import derived as D


def tables(spark, path):
    texts = ["a  <b>title</b> &amp; text of " + "words " * 30, "", None, "café x"]
    docs = [(i, texts[i % 4], "en", f"src{i % 3}", 9) for i in range(420)] + [(None, "t", "en", "src0", 1), (5, "again", "en", "src1", 5)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    events = [(i, dt.datetime(2024, 1, 1 + i % 28, i % 24), ("view", "click", "signup")[i % 3], i % 7 / 2) for i in range(3000)]
    spark.createDataFrame(events, "event_id long, ts timestamp, event_type string, value double").write.parquet(f"{path}/events.parquet")


def test_deliveries_are_built_from_one_pass_over_the_tables(spark, tmp_path, monkeypatch):
    tables(spark, tmp_path)
    sf, passes, inner = str(tmp_path), [], D.raw_rows
    docs = [f(spark, sf).select("path", "text") for f in (
        D.discovery_payloads, D.aggregator_payloads, D.aggregator_errors, D.keyed_feed_payloads, D.rss_xml_payloads,
        D.channel_xml_payloads, D.keyed_channel_payloads)]
    # rows that repeat a doc_id stand in any order within their document
    one = lambda rows: sorted((p, "".join(sorted(t))) for p, t in rows if p is not None)
    expected = one((r.path, r.text) for d in docs for r in d.collect())
    monkeypatch.setattr(D, "raw_rows", lambda *a: passes.append(a) or inner(*a))
    monkeypatch.setattr(Q, "_scratch", lambda s: f"{tmp_path}/run")
    run = Q._Run(spark, sf)
    assert len(passes) == 1
    landed = spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/run/landing").collect()
    by_delivery = [one((r.path.split("doc=")[1][:-1].join(["landing/", ""]).replace("__", "/"), bytes(r.content).decode()) for r in landed
                       if r.path.startswith(f"delivery={k}/")) for k in (0, 1)]
    assert by_delivery[1] == expected and len(expected) > 20
    even = [x for x in expected if int(x[0].replace("-", "/").split("/")[-1].split(".")[0]) % 2 == 0]
    assert by_delivery[0] == even
    assert spark.read.parquet(run.log).groupBy("batch_id").count().count() == 2


def test_a_text_is_cleaned_once(spark):
    df = spark.createDataFrame([("a  <i>b</i>",), ("<p>",), (None,)], "t string").select(_or_none(F.col("t")).alias("t"))
    assert [r.t for r in df.collect()] == ["a b", None, None]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(f", {TAG_RE}, ") == 1
