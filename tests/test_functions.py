"""Scalar functions against small brute-force Python equivalents."""
import html
import re

from pyspark.sql import functions as F

from covlens.functions import (clean_text, content_hash, coverage_day, item_id, parse_compact_ts,
                               parse_timestamp, publisher_from_domain, strip_think, url_domain, video_id,
                               distinct_preserve, parse_json_list)


def py_clean(t):
    if not t:
        return ""
    t = html.unescape(t)
    t = re.sub(r"<[^>]+>", " ", t)
    t = re.sub(r"https?://\S+", " ", t)
    return re.sub(r"\s+", " ", t).strip()


HOSTILE = [
    "&amp;lt;b&amp;gt;bold&amp;lt;/b&amp;gt;", "a&nbsp;b", "x y z", "<a\n href='x'>link</a> text",
    "see https://ex.com/a?b=1 now", "&eacute;t&#233; &#x41;&copy", "  lead and trail \t\n", "", None,
    "AT&T &ampx", "unit\x1csep", "tab\tand\r\nnewline", "<p>para</p><br/>next", "&&& que",
]


def test_clean_text_matches_python(spark):
    df = spark.createDataFrame([(s,) for s in HOSTILE], "s string")
    got = [r.c for r in df.select(clean_text(F.col("s")).alias("c")).collect()]
    assert got == [py_clean(s) for s in HOSTILE]


def test_url_domain(spark):
    urls = ["https://www.Example.com/a/b", "http://user:pw@host.com:8080/x", "host.org/path",
            "https://q.com?x=1", "", None, "https://m.site.net#top"]
    exp = ["www.example.com", "user:pw@host.com:8080", "host.org", "q.com?x=1", "unknown", "unknown",
           "m.site.net#top"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r.d for r in df.select(url_domain(F.col("u")).alias("d")).collect()] == exp


def test_publisher_from_domain(spark):
    cases = {"nasional.kompas.com": "kompas", "KOMPAS.com": "kompas", "www.antaranews.com": "antara",
             "bbc.co.uk": "co", "foo.": "foo", "localhost": "localhost", "": "unknown",
             "news.detik.com": "detik", "notdetik.com": "notdetik"}
    df = spark.createDataFrame([(k,) for k in cases], "d string")
    got = {r.d: r.p for r in df.select("d", publisher_from_domain(F.col("d")).alias("p")).collect()}
    assert got == cases


def test_parse_timestamps(spark):
    rows = [("Mon, 12 Jan 2026 11:06:52 +0700", "2026-01-12 04:06:52"),
            ("Mon, 12 Jan 2026 09:00:00 GMT", "2026-01-12 09:00:00"),
            ("2026-01-12T10:00:00+00:00", "2026-01-12 10:00:00"),
            ("2026-01-12T10:00:00Z", "2026-01-12 10:00:00"),
            ("garbage", None), ("", None), (None, None)]
    df = spark.createDataFrame(rows, "s string, e string")
    out = df.select(F.date_format(parse_timestamp(F.col("s")), "yyyy-MM-dd HH:mm:ss").alias("p"), "e").collect()
    assert [r.p for r in out] == [r.e for r in out]
    c = spark.createDataFrame([("20251228T091500Z",), ("2026-01-12T10:00:00+00:00",), ("x",)], "s string")
    got = [r.p for r in c.select(F.date_format(parse_compact_ts(F.col("s")), "yyyy-MM-dd HH:mm:ss").alias("p")).collect()]
    assert got == ["2025-12-28 09:15:00", "2026-01-12 10:00:00", None]


def test_video_id_takes_last(spark):
    df = spark.createDataFrame([("https://y.com/watch?v=a&x=watch?v=b&t=1",), ("https://youtu.be/z",),
                                ("https://y.com/watch?v=",)], "l string")
    assert [r.v for r in df.select(video_id(F.col("l")).alias("v")).collect()] == ["b", None, ""]


def test_hash_ids(spark):
    df = spark.createDataFrame([("gdelt", "https://x", "T", None)], "p string, u string, t string, s string")
    r = df.select(item_id(F.col("p"), F.col("u")).alias("i"), content_hash(F.col("t"), F.col("s")).alias("h")).first()
    import hashlib
    assert r.i == hashlib.sha256(b"gdelt|https://x").hexdigest()
    assert r.h == hashlib.sha256(b"T||").hexdigest()


def test_misc(spark):
    df = spark.createDataFrame([("<THINK>a\nb</think>  answer  ", '["a","a","",null,"b"]', "nope")],
                               "r string, j string, bad string")
    r = df.select(strip_think(F.col("r")).alias("s"),
                  distinct_preserve(F.from_json("j", "array<string>")).alias("d"),
                  parse_json_list(F.col("bad")).alias("b"), parse_json_list(F.col("j")).alias("l"),
                  coverage_day(F.lit(None).cast("timestamp"), F.lit("2024-01-02 03:00:00").cast("timestamp")).alias("day")).first()
    assert r.s == "answer" and r.d == ["a", "b"] and r.b == [] and r.day == "2024-01-02"
    assert r.l == ["a", "a", "", None, "b"]
