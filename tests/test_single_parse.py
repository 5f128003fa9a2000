"""Landed payloads are parsed once, and plain texts take no pattern."""
import html
import random
import re

from pyspark.sql import functions as F

from covlens.functions.text import TAG_RE, clean_text
from covlens.sources import landing as L


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_aggregator_payloads_are_parsed_once(spark):
    texts = ['{"data": [{"url": "a"}, {"url": "b"}]}', '[{"url": "c"}, 7]', '{"error": {"code": "x", "message": "m"}}',
             '{"error": {"code": "y"}, "data": [{"url": "lost"}]}', '{"\\u0065rror": {"code": "z"}}', '{"error": null, "data": [{"url": "d"}]}',
             '{"data": [{"url": "error"}]}', "{", "", None, '  [{"url": "e"}]']
    docs = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "path string, text string")
    articles, errors = L.parse_aggregator_list(docs)
    assert sorted((r.path, r.pos, r.url) for r in articles.collect()) == [
        ("0", 0, "a"), ("0", 1, "b"), ("1", 0, "c"), ("10", 0, "e"), ("5", 0, "d"), ("6", 0, "error")]
    assert sorted((r.path, r.code) for r in errors.collect()) == [("2", "x"), ("3", "y"), ("4", "z")]
    # the bare array, the wrapped one, and an article
    assert optimized(articles).count("from_json(") == 3


def test_feed_entries_are_parsed_once(spark):
    docs = spark.createDataFrame([("p", '{"f": [{"title": "t"}, null, 3, {"title": "u"}], "g": [], "h": null, "i": [{"link": "l"}]}'), ("q", "{")],
                                 "path string, text string")
    entries = L.parse_keyed_feeds(docs)
    assert sorted((r.feed_name, r.pos, r.raw, r.entry.get("title")) for r in entries.collect()) == [
        ("f", 0, '{"title":"t"}', "t"), ("f", 3, '{"title":"u"}', "u"), ("i", 3 << 32, '{"link":"l"}', None)]
    assert optimized(entries).count("from_json(") == 2


def test_plain_texts_are_cleaned_like_others(spark):
    rng = random.Random(5)
    bits = ["a", "é", "word", " ", " ", "  ", "\n", "\t", "\r", " ", " ", "　", "\x85", "\x1c", "<b>", "<", ">", "&amp;", "&eacute;",
            "&", "https://x.y/z", "http:", "://", " ", "﻿", "​"]
    texts = ["".join(rng.choice(bits[:rng.choice((5, 7, len(bits)))]) for _ in range(rng.randrange(12))) for _ in range(1500)] + [None]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, t string").select("k", clean_text(F.col("t")).alias("t"),
                                                                                  clean_text(F.col("t"), unescape=False).alias("u")).collect()

    def clean(t):
        return " ".join(re.sub(r"https?://\S+", " ", re.sub(TAG_RE, " ", t)).split())
    assert [r.t for r in sorted(rows)] == [clean(html.unescape(t or "")) for t in texts]
    assert [r.u for r in sorted(rows)] == [clean(t or "") for t in texts]
    plan = optimized(spark.range(3).select(clean_text(F.concat_ws(" ", "id")).alias("t")))
    assert plan.index("CASE WHEN") < plan.index(TAG_RE)  # the patterns are a branch
