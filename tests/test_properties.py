"""Property tests: cleaning equals the Python semantics on generated
hostile text; the model adapter retries through mapInPandas."""
import html
import re

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from covlens.functions import clean_text
from covlens.operators.enrich import enrich_with_retry, pandas_model

PIECES = st.sampled_from(["&amp;", "&lt;b&gt;", "&amp;lt;i&amp;gt;", "&nbsp;", "&#233;", "&#x41;", "&eacute;",
                          "&copy", "&", "<p>", "</a >", "<a\nhref=x>", " ", "\t", "\n", " ", " ",
                          "\x1c", "https://x.y/z?q=1", "http://a", "word", "é", "Ж", "---", ";", "#"])
TEXT = st.lists(PIECES, max_size=12).map("".join)


def py_clean(t):
    if not t:
        return ""
    t = html.unescape(t)
    t = re.sub(r"<[^>]+>", " ", t)
    t = re.sub(r"https?://\S+", " ", t)
    return re.sub(r"\s+", " ", t).strip()


@settings(max_examples=4, deadline=None)
@given(st.lists(TEXT, min_size=40, max_size=40))
def test_clean_text_property(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r.c for r in df.select(clean_text(F.col("s")).alias("c")).collect()]
    assert got == [py_clean(t) for t in texts]


def test_pandas_model_retries(spark):
    calls = []

    def model(prompt, attempt):
        calls.append(attempt)
        if prompt == "boom":
            raise RuntimeError("model down")
        if prompt == "late" and attempt < 2:
            return "not json"
        return '{"topics": ["' + prompt + '"], "sentiment": "neutral"}'

    pend = spark.createDataFrame([("1", "a"), ("2", "late"), ("3", "boom")], "id string, prompt string")
    log = enrich_with_retry(pend, pandas_model(model), model="m", max_retries=2)
    got = {r.id: (r.enrich_status, r.attempts, r.topics) for r in log.collect()}
    assert got == {"1": ("ok", 1, ["a"]), "2": ("ok", 3, ["late"]), "3": ("error", 3, [])}
