"""S4 by bytes: feeds in their own character set equal their UTF-8 twins, in files and in the stream."""
import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from covlens.sources import landing as L
from covlens.streaming import ingest as S

SMALL = "/root/testdata/sf0.001"
FEED = '<?xml version="1.0" encoding="{}"?><rss version="2.0"><channel><title>t</title><item><title>{}</title></item></channel></rss>'
TITLE = "Café über Ångström"
CASES = {
    "utf8": (FEED.format("UTF-8", TITLE + " € \U0001f600").encode(), TITLE + " € \U0001f600"),
    "mark8": (b"\xef\xbb\xbf" + FEED.format("utf-8", TITLE).encode(), TITLE),
    "latin": (FEED.format("ISO-8859-1", TITLE).encode("latin-1"), TITLE),
    "latin_that_is_utf8": (FEED.format("iso-8859-1", "Ã©").encode("latin-1"), "Ã©"),  # the prolog holds
    "cp1252": (FEED.format("windows-1252", TITLE + " ’ €").encode("cp1252"), TITLE + " ’ €"),
    "cp1252_called_utf8": (FEED.format("UTF-8", TITLE + " ’").encode("cp1252"), TITLE + " ’"),
    "le_mark": (b"\xff\xfe" + FEED.format("UTF-16", TITLE).encode("utf-16-le"), TITLE),
    "be_mark": (b"\xfe\xff" + FEED.format("UTF-16", TITLE).encode("utf-16-be"), TITLE),
    "le": (FEED.format("UTF-16", TITLE).encode("utf-16-le"), TITLE),
    "be": (FEED.format("UTF-16", TITLE).encode("utf-16-be"), TITLE),
    "le_odd": (FEED.format("UTF-16", TITLE).encode("utf-16-le") + b"\n", TITLE),
}


@pytest.fixture
def landing(tmp_path):
    for name, (data, _) in CASES.items():
        d = tmp_path / "landing" / f"doc=rss__{name}.xml"
        d.mkdir(parents=True)
        (d / "part-0").write_bytes(data)
    (tmp_path / "landing" / "doc=rss__empty.xml").mkdir()
    (tmp_path / "landing" / "doc=rss__empty.xml" / "part-0").write_bytes(b"")
    return str(tmp_path / "landing")


def titles(docs):
    e = L.parse_feed_xml(docs, F.regexp_extract("path", r"rss__(\w+)\.xml", 1), F.lit(None).cast("string"))
    return {r.feed_name: r.title for r in e.select("feed_name", F.col("entry")["title"].alias("title")).collect()}


def test_every_set_gives_its_text(spark, landing):
    assert titles(L.read_documents(spark, landing)) == {k: t for k, (_, t) in CASES.items()}


def test_the_stream_reads_the_same(spark, landing, tmp_path):
    out = str(tmp_path / "out")
    q = (S.landing_stream(spark, landing).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    docs = spark.read.parquet(out)  # a stream passes over empty files
    assert docs.count() == len(CASES) and titles(docs) == {k: t for k, (_, t) in CASES.items()}


def test_bytes_of_no_set(spark):
    df = spark.createDataFrame([(None,), (b"",), (b"\xff",), (b"plain",), (b"\x81\xe9",)], "b binary")
    assert [r.t for r in df.select(L.decode_document(F.col("b")).alias("t")).collect()] == [None, "", "\xff", "plain", "\x81\xe9"]


def test_oracle_agrees(spark):
    con = duckdb.connect()
    for t in ("documents", "labels", "events", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    df = E.queries()["scan_feed_charsets"](spark, SMALL)
    rel = con.execute(E.oracle_sql()["scan_feed_charsets"])
    names = [d[0] for d in rel.description]
    want = sorted(map(repr, rel.fetchall()))
    assert want and sorted(repr(tuple(r[c] for c in names)) for r in df.collect()) == want
