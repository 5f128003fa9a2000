"""Article text: main-text extraction from landed pages (E11) and the
content lookup for items lacking text (J5).

Extraction is a native regex pass over the raw HTML (comments, head,
scripts, styles, navigation, headers, footers, asides, tables, forms and
ad/comment/share blocks removed), then the common cleaner (F4).  The exact
boilerplate heuristic of the third-party extractor is not specified; this
one is ours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_text

# Removed before text extraction, in this order.
BOILERPLATE = (
    r"(?s)<!--.*?-->",
    r"(?is)<head\b[^>]*>.*?</head>",
    r"(?is)<script\b[^>]*>.*?</script>",
    r"(?is)<style\b[^>]*>.*?</style>",
    r"(?is)<noscript\b[^>]*>.*?</noscript>",
    r"(?is)<nav\b[^>]*>.*?</nav>",
    r"(?is)<header\b[^>]*>.*?</header>",
    r"(?is)<footer\b[^>]*>.*?</footer>",
    r"(?is)<aside\b[^>]*>.*?</aside>",
    r"(?is)<table\b[^>]*>.*?</table>",
    r"(?is)<form\b[^>]*>.*?</form>",
    r"(?is)<div\b[^>]*class=\"[^\"]*\b(ad|ads|advert|comment|comments|share|related|sidebar|cookie)\b[^\"]*\"[^>]*>.*?</div>",
)


def strip_boilerplate(html: Column) -> Column:
    t = F.coalesce(html, F.lit(""))
    for pat in BOILERPLATE:
        t = F.regexp_replace(t, pat, " ")
    return t


def extract_main_text(html: Column) -> Column:
    """E11 as a single expression: HTML -> main text, or NULL."""
    t = clean_text(strip_boilerplate(html))
    return F.when(t != "", t)


def with_main_text(df: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """E11 over a DataFrame: the boilerplate-stripped page is materialised
    as a column first, so the cleaning steps (and the Arrow hop for rare
    references) read one attribute instead of re-running the regex chain."""
    x = df.select("*", strip_boilerplate(F.col(html)).alias("_stripped"))
    x = x.select(*df.columns, clean_text(F.col("_stripped")).alias("_clean"))
    return x.select(*df.columns, F.when(F.col("_clean") != "", F.col("_clean")).alias(out))


def content_lookup(items: DataFrame, pages: DataFrame, item_key: str, page_key: str,
                   fetched_at: Column) -> DataFrame:
    """Text only for items lacking it.  Items without content_text join
    the landed pages on the given keys; the result is a content log
    (id, content_text, content_fetched_at, content_status='ok') holding
    only pages that yielded text.  Both sides are large, so this is a
    shuffle join on the key, never a broadcast."""
    need = items.filter(F.col("content_text").isNull()).select("id", F.col(item_key).alias("_k"))
    p = with_main_text(pages.select(F.col(page_key).alias("_k"), "html"), "html", "content_text").drop("html")
    j = need.join(p, "_k").filter(F.col("content_text").isNotNull())
    return j.select("id", "content_text", fetched_at.cast("timestamp").alias("content_fetched_at"),
                    F.lit("ok").alias("content_status"))
