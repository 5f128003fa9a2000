"""Text cleaning (F4/F4b), URL host (F14), truncation (F16), think-block
removal (F20), order-preserving distinct (F22)."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

# Characters Python's `\s` matches in str patterns.  Java's and RE2's `\s`
# are narrower (ASCII, or miss U+001C..U+001F), so the class is spelled out
# and used in every whitespace-sensitive pattern, in Spark and in the
# DuckDB oracle alike.
WS_CLASS = (r"\t\n\x{0B}\x{0C}\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
            r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")

TAG_RE = r"<[^>]+>"
URL_RE = r"https?://[^" + WS_CLASS + r"]+"
# For Spark.  What may begin a match is kept cheap, as it is tested at every
# character: a plain space by itself (single ones between words stay as they are
# and are no matches), single codes below U+0100 by one lookup, the others by
# their range first.
_WS_NARROW = r"\t\n\x{0B}\x{0C}\r\x{1C}\x{1D}\x{1E}\x{1F}\x{85}\x{A0}"
_WS_WIDE = r"[\x{1680}-\x{3000}&&[\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]]"
WS_RUN_RE = r" [" + WS_CLASS + r"]+|[" + _WS_NARROW + _WS_WIDE + r"][" + WS_CLASS + r"]*"
# What makes cleaning do more than turn line feeds into spaces: the beginning of a
# tag or a reference, or white space of another kind.  One class, so a character
# costs one lookup.
MARKED_RE = r"[<&" + _WS_NARROW.replace(r"\n", "") + _WS_WIDE + r"]"
# The character references decoded natively (the common
# ones in feed and page text), `&amp;` last so one pass is emulated.
NATIVE_ENTITIES = (
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
    ("&nbsp;", "\u00a0"), ("&copy;", "\u00a9"), ("&middot;", "\u00b7"), ("&amp;", "&"),
)
# Any other reference html.unescape could decode (numeric, hex, other
# names, legacy forms without ';') sends the row to the Python path.
_NATIVE_NAMES = "|".join(e[1:-1] for e, _ in NATIVE_ENTITIES)
EXOTIC_ENTITY_RE = (r"&(?!(?:" + _NATIVE_NAMES + r");)(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*)")


@pandas_udf(StringType())
def _unescape_batch(s: pd.Series) -> pd.Series:
    # Only rows holding a character reference arrive non-null (see
    # html_unescape); the rest cross the Arrow boundary as nulls.
    return s.map(lambda v: html.unescape(v) if isinstance(v, str) else None)


def _native_unescape(c: Column) -> Column:
    for ent, ch in NATIVE_ENTITIES:
        c = F.replace(c, F.lit(ent), F.lit(ch))
    return c


def html_unescape(c: Column) -> Column:
    """HTML5 unescape (named incl. no-semicolon forms, numeric, hex).

    The common references are decoded natively.  Spark has no built-in for
    the full 2000+ entry HTML5 table, so a row holding any other reference
    goes whole to an Arrow batch UDF over the standard library's
    unescape; every other row crosses the Arrow boundary as a NULL."""
    exotic = c.contains("&") & c.rlike(EXOTIC_ENTITY_RE)
    native = F.when(c.contains("&"), _native_unescape(c)).otherwise(c)
    return F.coalesce(_unescape_batch(F.when(exotic, c)), native)


def strip_ws(c: Column) -> Column:
    """Python str.strip(): remove leading/trailing Unicode whitespace."""
    return F.regexp_replace(c, r"^[" + WS_CLASS + r"]+|[" + WS_CLASS + r"]+$", "")


def _clean_after_unescape(t: Column) -> Column:
    t = F.regexp_replace(t, TAG_RE, " ")
    t = F.regexp_replace(t, URL_RE, " ")
    t = F.regexp_replace(t, WS_RUN_RE, " ")
    # runs are single spaces now, so a plain space trim equals str.strip()
    return F.trim(t)


def clean_text(c: Column, unescape: bool = True) -> Column:
    """NULL/empty -> ''; unescape once, tags -> space, http(s) URLs ->
    space, whitespace runs -> one space, strip.  A text in which none of these
    finds anything but single blanks and line feeds (most texts) is told by one
    search and takes no pattern."""
    t = F.coalesce(c, F.lit(""))
    lines = F.replace(t, F.lit("\n"), F.lit(" "))
    plain = ~(lines.contains("  ") | t.contains("://") | t.rlike(MARKED_RE))
    return F.when(plain, F.trim(lines)).otherwise(_clean_after_unescape(html_unescape(t) if unescape else t))


def clean_again(c: Column) -> Column:
    """Clean text that was already cleaned once.  The whitespace steps are
    idempotent; only a row still holding '&' can change (an escaped tag
    becomes a tag and disappears), so only those rows take the full path."""
    t = F.coalesce(c, F.lit(""))
    return F.when(t.contains("&"), clean_text(t)).otherwise(t)


def url_domain(url: Column) -> Column:
    """text after the first '//' (if any) up to the next '/', lower
    case; empty/NULL url -> 'unknown'.  Keeps www., port, userinfo."""
    after = F.element_at(F.split(url, "//", 2), -1)
    host = F.lower(F.element_at(F.split(after, "/", 2), 1))
    return F.when(F.coalesce(url, F.lit("")) == "", F.lit("unknown")).otherwise(host)


def truncate_content(c: Column, n: int = 4000) -> Column:
    """F16: clean, then first n code points."""
    return F.substring(clean_text(c), 1, n)


def strip_think(c: Column) -> Column:
    """drop <think>...</think> blocks (case-insensitive, dot-all,
    non-greedy) and strip."""
    return strip_ws(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?is)<think>.*?</think>", ""))


def distinct_preserve(a: Column) -> Column:
    """drop NULL/empty, de-duplicate, keep first-seen order."""
    return F.array_distinct(F.filter(a, lambda x: x.isNotNull() & (x != "")))
