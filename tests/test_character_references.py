"""F4b against the standard library: every name, every kind of number, hostile text."""
import html
import random
from html.entities import html5

import pytest
from pyspark.sql import functions as F

from covlens.functions.text import html_unescape


def decoded(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "n int, t string").repartition(4)
    rows = df.select("n", html_unescape(F.col("t")).alias("u")).collect()
    return [r.u for r in sorted(rows, key=lambda r: r.n)]


def check(spark, texts):
    for text, got in zip(texts, decoded(spark, texts)):
        assert got == html.unescape(text), repr(text[:200])


def test_every_name(spark):
    check(spark, [f"a &{n}{after}" for n in html5 for after in ("", "x", ";", " b", "=1")])
    check(spark, ["&notit;", "&ampamp;", "&amp;amp;lt;", "&ltlt;", "&unknown;", "&" + "a" * 40 + ";", "&", "&&", "&;", "&é;", "&#", "&#x", "&#;"])


def test_every_kind_of_number(spark):
    edges = {0, 1, 8, 9, 10, 11, 12, 13, 14, 31, 32, 38, 126, 127, *range(128, 160), 160, 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDCF,
             0xFDD0, 0xFDEF, 0xFDF0, 0xFEFF, 0xFFFD, 0xFFFE, 0xFFFF, 0x10000, 0x1F600, 0x1FFFE, 0x10FFFE, 0x10FFFF, 0x110000, 10 ** 9, 10 ** 40}
    rng = random.Random(3)
    edges |= {rng.randrange(0x110000) for _ in range(300)}
    check(spark, [form.format(n) for n in sorted(edges) for form in ("&#{};", "x&#{}y", "&#x{:x};", "&#X{:X} ", "&#000{};&#x0000{:x}")
                  if form.count("{") == 1] + ["&#000065;", "&#x0000041;", "&#0000000000;"])


@pytest.mark.parametrize("seed", range(3))
def test_hostile_text(spark, seed):
    rng = random.Random(seed)
    pieces = ["&", ";", "#", "x", "amp", "lt", "not", "in", "&copy", "&#1", "28", "é", "\U0001f600", " ", "<", "\n", "&frac12", "&Aacute;", "&#xfeff;", "0"]
    check(spark, ["".join(rng.choice(pieces) for _ in range(rng.randrange(14))) for _ in range(400)] + ["&eacute;&" * 30_000])


def test_null_and_plain_text_stay(spark):
    df = spark.createDataFrame([(None,), ("",), ("a b",)], "t string").select(html_unescape(F.col("t")).alias("u"))
    assert [r.u for r in df.collect()] == [None, "", "a b"]
