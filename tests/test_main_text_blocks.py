"""Main text by blocks: nesting, unclosed marks, link density, linear time, and the SQL over well-formed pages."""
import random
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from covlens.operators.blocks import split_blocks, with_block_text
from covlens.plans.queries import ORACLES, QUERIES

from conftest import SMALL

STORY = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen"
MORE = STORY.replace("one", "uno")


def main_text(spark, *pages):
    df = spark.createDataFrame(list(enumerate(pages)), "page_id int, html string").coalesce(1)
    return [r["text"] for r in with_block_text(df).orderBy("page_id").collect()]


def visible(page):
    return [b["text"] for b in split_blocks(page) if not b["outside"]]


def test_nested_elements_leave_nothing_behind():
    page = (f"<div class='ad box'>buy <div>now <div>cheap</div></div> here</div><p>{STORY}</p>"
            "<table><tr><td><table><tr><td>in</td></tr></table>out</td></tr></table>"
            "<nav><div><nav>a</nav></div>b</nav>tail")
    assert visible(page) == [STORY, "tail"]
    assert visible("<section class='ad-free'>kept</section><p id=comments>gone</p><i role='navigation'>gone</i>kept too") == ["kept", "kept too"]
    assert visible("<p>wo<b>rd</b> a<br>b &amp; c&nbsp;d</p><!-- no --><script>x('</p>')</script><style>y</style>") == ["word a b & c d"]


def test_unclosed_marks_hide_no_article():
    assert visible(f"<body><nav><ul><li>menu<p>{STORY}</p></body>") == ["menu", STORY]      # never closed
    assert visible(f"<div><nav>menu</div><p>{STORY}</p>") == ["menu", STORY]                 # closed by its parent
    assert visible(f"<!-- <p>{STORY}</p>") == [STORY]
    assert visible(f"<p>{STORY}</p><script>var x") == [STORY]
    assert visible("<p>a < b <c") == ["a < b <c"] and visible("</div></nav>x") == ["x"] and visible("") == []


def test_links_and_neighbours_decide(spark):
    links = "<li><a href=x>alpha beta gamma</a></li>" * 5
    page = (f"<ul>{links}</ul><h1>a short title of its own</h1><p>{STORY}</p><p>yes</p><p>no</p><p>by us</p>"
            f"<ul>{links}</ul><p>three word line</p>")
    assert main_text(spark, page, f"<ul>{links}</ul>", "just this", None, "", "<nav>x</nav>") == [
        f"a short title of its own\n{STORY}\nyes", None, "just this", None, None, None]
    # a link that is never closed does not make links of what follows
    assert main_text(spark, f"<p><a href=x>{STORY}</p><p>{MORE}</p>") == [f"{STORY}\n{MORE}"]
    assert main_text(spark, f"<p>{'漢' * 60}</p><p>漢字</p>") == ["漢" * 60 + "\n漢字"]
    # repeated rows and other columns pass
    df = spark.createDataFrame([(1, f"<p>{STORY}</p>", "x")] * 2, "page_id int, html string, words string")
    assert [tuple(r) for r in with_block_text(df).select("page_id", "words", "text").collect()] == [(1, "x", STORY)] * 2


@pytest.mark.parametrize("mark", ["<div", "<div>", "<nav>", "<!--", "<script ", "<noscript>", "<a href=x>y", "<div class=\"", "</p", "<", "<svg>", "</nav>x"])
def test_five_megabytes_take_seconds(mark):
    page = f"<p>{STORY}</p>" + mark * (5_000_000 // len(mark))
    start = time.monotonic()
    found = split_blocks(page)
    assert time.monotonic() - start < 40 and found[0]["text"].startswith(STORY)


def test_time_grows_with_the_page():
    def seconds(n):
        rng = random.Random(1)
        page = "".join(rng.choice(["<div>", "<nav>", "</div>", "</nav>", "<a>", "w ", "<!--", "<p>", "<svg>"]) for _ in range(n))
        start = time.monotonic()
        split_blocks(page)
        return time.monotonic() - start
    seconds(1000)
    assert seconds(400_000) < 40 * max(seconds(40_000), 0.02)


@pytest.mark.parametrize("folder", [SMALL, SMALL.replace("0.001", "0.01")])
def test_sql_agrees(spark, folder):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet'")
    want = sorted(con.sql(f"SELECT page_id, text, n_blocks, n_content FROM ({ORACLES['main_text_blocks']})").fetchall())
    got = sorted(tuple(r) for r in QUERIES["main_text_blocks"](spark, folder).select("page_id", "text", "n_blocks", "n_content").collect())
    assert got == want and any(r[3] for r in got)


def test_one_python_stage(spark):
    plan = with_block_text(spark.createDataFrame([(1, "x")], "page_id int, html string"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan
