"""Registered queries for scalar functions, tagging, content, enrichment
and briefings (F2-F28, E1-E11, J3-J5, P6, T4, T6)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..config import (EDITORIAL_WORDS, LANGUAGE_ID_WORDS, NEGATIVE_WORDS, POSITIVE_WORDS, PUBLISHER_DOMAINS,
                      TEST_REPORT as P, TEST_TAXONOMY, WORDS_TAXONOMY, Taxonomy)
from ..functions.ids import sha256_hex
from ..functions.jsonf import compact_json, parse_json_list
from ..functions.publisher import publisher_from_domain, video_id
from ..functions.text import WS_CLASS, clean_text, html_unescape, truncate_content, url_domain
from ..functions.time import parse_compact_ts, parse_timestamp
from ..operators import analytics as A
from ..operators import blocks as K
from ..operators import briefing as B
from ..operators import content as C
from ..operators import enrich as EN
from ..operators import store as ST
from ..operators.tagging import keyword_enrich
from ..session import ensure_checkpoint_dir
from ..sources.binding import INGESTED_AT, article_pages, media_items, table
from . import oracle as O
from .queries import register

W = O.with_binding


def _ts_out(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


# ---------------------------------------------------------------------------
# Scalar functions over the tables
# ---------------------------------------------------------------------------
@register("clean_text", f"SELECT page_id, {O.clean_sql('html')} AS text FROM pages")
def q_clean_text(spark, sf):
    """F4 (+F4b): whole pages through the cleaner."""
    return table(spark, sf, "pages").select("page_id", clean_text(F.col("html")).alias("text"))


@register("html_unescape", f"SELECT page_id, {O.unescape_sql('html')} AS html FROM pages")
def q_html_unescape(spark, sf):
    """Whole pages, character references decoded."""
    return table(spark, sf, "pages").select("page_id", html_unescape(F.col("html")).alias("html"))


@register("url_domain", f"SELECT page_id, {O.domain_sql('url')} AS domain FROM pages")
def q_url_domain(spark, sf):
    """F14."""
    return table(spark, sf, "pages").select("page_id", url_domain(F.col("url")).alias("domain"))


_MAP = " ".join(f"WHEN h = {O.q(k)} OR ends_with(h, {O.q('.' + k)}) THEN {O.q(v)}"
                for k, v in PUBLISHER_DOMAINS)


@register("publisher_from_domain", f"""
SELECT page_id, CASE WHEN coalesce(h, '') = '' THEN 'unknown' {_MAP}
  WHEN contains(h, '.') THEN string_split(h, '.')[-2] ELSE h END AS publisher
FROM (SELECT page_id, lower({O.domain_sql('url')}) AS h FROM pages)""")
def q_publisher_from_domain(spark, sf):
    """F7 over the page hosts."""
    return table(spark, sf, "pages").select(
        "page_id", publisher_from_domain(url_domain(F.col("url"))).alias("publisher"))


_TS_FORMS = """
SELECT event_id, strftime(CASE WHEN event_id % 24 IN (12, 13, 14, 15, 16) THEN date_trunc('day', ts)
  WHEN event_id % 24 IN (17, 18, 19) THEN date_trunc('minute', ts) ELSE date_trunc('second', ts) END, '%Y-%m-%d %H:%M:%S') AS parsed
FROM events"""


@register("parse_timestamp", _TS_FORMS)
def q_parse_timestamp(spark, sf):
    """F2 + F3: every event time written in one of 24 feed/API forms and
    parsed back; each must give the same instant, as far as the form holds
    it (to the second, the minute or the day)."""
    ev = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    plus7 = F.col("ts") + F.expr("INTERVAL 7 HOURS")
    minus5 = F.col("ts") - F.expr("INTERVAL 5 HOURS")
    day_first = F.dayofmonth("ts") > 12  # else the month comes first
    fmt = F.date_format
    forms = [
        fmt("ts", "yyyyMMdd'T'HHmmss'Z'"), fmt(plus7, "yyyy-MM-dd'T'HH:mm:ss'+07:00'"), fmt(plus7, "EEE, dd MMM yyyy HH:mm:ss '+0700'"),
        fmt("ts", "EEEE, d MMM yyyy HH:mm:ss 'GMT'"), fmt("ts", "yyyy-MM-dd HH:mm:ss"), fmt("ts", "yyyyMMdd'T'HHmmss"),
        fmt("ts", "d MMMM yyyy HH:mm:ss 'GMT'"), fmt("ts", "MMMM d, yyyy HH:mm:ss"), fmt(plus7, "d MMM yyyy H:mm:ss '+0700'"),
        fmt("ts", "EEE, MMM d, yyyy H:mm:ss 'UTC'"),
        fmt("ts", "EEE, dd MMM yy HH:mm:ss 'GMT'"), fmt("ts", "EEE MMM dd HH:mm:ss yyyy"),
        fmt("ts", "MM/dd/yyyy"), fmt("ts", "yyyyMMdd"), fmt("ts", "dd-MMM-yyyy"), fmt("ts", "yyyy.MM.dd"), fmt("ts", "yyyy MMM d"),
        F.when(day_first, fmt("ts", "dd/MM/yyyy HH:mm")).otherwise(fmt("ts", "MM/dd/yyyy HH:mm")),
        fmt("ts", "MMM d, yyyy h:mm a"), F.lower(fmt("ts", "M/d/yy h:mm a")),
        fmt(minus5, "EEE, d MMM yyyy HH:mm:ss 'EST'"), fmt("ts", "EEE MMM dd HH:mm:ss 'UTC' yyyy"),
        fmt(plus7, "EEE MMM dd HH:mm:ss '+0700' yyyy"), fmt("ts", "d-MMM-yyyy HH:mm:ss"),
    ]
    k = F.col("event_id") % len(forms)
    s = F.coalesce(*[F.when(k == i, f) for i, f in enumerate(forms)])
    p = F.when((k == 0) | (k == 5), parse_compact_ts(s)).otherwise(parse_timestamp(s))
    return ev.select("event_id", _ts_out(p).alias("parsed"))


@register("video_id", """
SELECT event_id, CASE event_id % 3
  WHEN 0 THEN 'u' || CAST(user_id AS VARCHAR)
  WHEN 1 THEN NULL
  ELSE 'w' || CAST(user_id AS VARCHAR) END AS video_id FROM events""")
def q_video_id(spark, sf):
    """id after the last 'watch?v=' up to '&'; none -> NULL."""
    ev = table(spark, sf, "events")
    u = F.col("user_id").cast("string")
    k = F.col("event_id") % 3
    link = (F.when(k == 0, F.concat(F.lit("https://www.youtube.com/watch?v=u"), u, F.lit("&t="),
                                    F.col("event_id").cast("string")))
            .when(k == 1, F.concat(F.lit("https://youtu.be/x"), u))
            .otherwise(F.concat(F.lit("https://www.youtube.com/watch?v=a&next=watch?v=w"), u)))
    return ev.select("event_id", video_id(link).alias("video_id"))


@register("truncate_content", f"""
SELECT doc_id, substring({O.clean_sql('text')}, 1, 4000) AS content FROM documents""")
def q_truncate_content(spark, sf):
    """F16: whole documents cleaned, then cut to 4000 characters."""
    return table(spark, sf, "documents").select("doc_id", truncate_content(F.col("text")).alias("content"))


@register("sha256_hex", "SELECT doc_id, sha256(text) AS h FROM documents")
def q_sha256_hex(spark, sf):
    """F5 over whole document texts."""
    return table(spark, sf, "documents").select("doc_id", sha256_hex(F.col("text")).alias("h"))


@register("json_roundtrip", W("""
SELECT id, to_json(topics) AS topics_json, CAST(len(topics) AS INTEGER) AS n_topics FROM items"""))
def q_json_roundtrip(spark, sf):
    """F6 + F6b: topics to compact JSON and back."""
    m = media_items(spark, sf)
    j = compact_json(F.col("topics"))
    return m.select("id", j.alias("topics_json"), F.size(parse_json_list(j)).alias("n_topics"))


@register("parse_json_list", """
SELECT event_id, CASE WHEN event_id % 3 = 1 THEN event_type || '|' || user_id ELSE '' END AS items FROM events""")
def q_parse_json_list(spark, sf):
    """Stored lists give their elements; JSON objects (the events'
    props) and broken texts are empty lists."""
    ev = table(spark, sf, "events")
    listed = F.to_json(F.array(F.col("event_type"), F.col("user_id").cast("string")))
    text = (F.when(F.col("event_id") % 3 == 1, listed).when(F.col("event_id") % 3 == 2, F.lit("[nope"))
            .otherwise(F.col("props")))
    return ev.select("event_id", F.array_join(parse_json_list(text), "|").alias("items"))


# ---------------------------------------------------------------------------
# Tagging
# ---------------------------------------------------------------------------
_ED = O.any_sql("ttext", EDITORIAL_WORDS)
_POSW = O.any_sql("ttext", POSITIVE_WORDS)
_NEGW = O.any_sql("ttext", NEGATIVE_WORDS)
_IDW = O.any_sql("ttext", LANGUAGE_ID_WORDS)


def _kw_sql(tx):
    return W(f"""
, k AS (SELECT id, lower(coalesce(title, '') || ' ' || coalesce(summary, '')) AS ttext FROM items)
SELECT id, array_to_string({O.topics_sql('ttext', tx)}, ',') AS topics,
  array_to_string({O.actors_sql('ttext', tx)}, ',') AS actors,
  CASE WHEN {_IDW} THEN 'id' END AS language,
  CASE WHEN {_ED} THEN TRUE END AS is_editorial,
  CASE WHEN {_POSW} THEN 'positive' WHEN {_NEGW} THEN 'negative' ELSE 'neutral' END AS sentiment,
  'fallback_keyword' AS enrich_model
FROM k""")


def _kw(spark, sf, tx):
    e = keyword_enrich(media_items(spark, sf), tx, F.lit(INGESTED_AT))
    return e.select("id", F.array_join("topics", ",").alias("topics"), F.array_join("actors", ",").alias("actors"),
                    "language", "is_editorial", "sentiment", "enrich_model")


@register("keyword_enrich", _kw_sql(TEST_TAXONOMY))
def q_keyword_enrich(spark, sf):
    """E1-E6 with the test taxonomy over the item snapshot."""
    return _kw(spark, sf, TEST_TAXONOMY)


@register("keyword_enrich_default", _kw_sql(WORDS_TAXONOMY))
def q_keyword_enrich_default(spark, sf):
    """E1-E6 with the shipped taxonomy and word lists."""
    return _kw(spark, sf, WORDS_TAXONOMY)


@register("keyword_enrich_table", W("""
, k AS (SELECT id, lower(coalesce(title, '') || ' ' || coalesce(summary, '')) AS ttext FROM items),
  words AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(lower(text), '[a-z]{6,}')) AS w FROM benchmark),
  hits AS (SELECT id, item_id FROM k JOIN words ON contains(ttext, w) GROUP BY ALL),
  tagged AS (SELECT id, string_agg('item ' || item_id, ',' ORDER BY item_id) AS topics, count(*) AS n_topics FROM hits GROUP BY id)
SELECT id, coalesce(topics, '') AS topics, CAST(coalesce(n_topics, 0) AS INTEGER) AS n_topics FROM k LEFT JOIN tagged USING (id)"""))
def q_keyword_enrich_table(spark, sf):
    """E1 + E2 with a taxonomy read from a table: each benchmark item is a
    topic, its words of 6 letters and more are the keywords."""
    words = table(spark, sf, "benchmark").select(
        F.col("item_id").alias("place"), F.concat(F.lit("item "), F.col("item_id")).alias("topic"), F.lit("keyword").alias("kind"),
        F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{6,}"), 0)).alias("word"))
    e = keyword_enrich(media_items(spark, sf), Taxonomy.from_frame(words), F.lit(INGESTED_AT))
    return e.select("id", F.array_join("topics", ",").alias("topics"), F.size("topics").alias("n_topics"))


# ---------------------------------------------------------------------------
# Content, enrichment application, pending list, state
# ---------------------------------------------------------------------------
def _boiler_sql(x: str) -> str:
    for pat in C.BOILERPLATE:
        flags = "g" + ("i" if "i" in pat[2:pat.index(")")] else "") + ("s" if "s" in pat[2:pat.index(")")] else "")
        body = pat[pat.index(")") + 1:]
        x = f"regexp_replace({x}, {O.q(body)}, ' ', {O.q(flags)})"
    return x


_MAIN = f"NULLIF({O.clean_sql(_boiler_sql('html'))}, '')"


@register("extract_main_text", f"SELECT page_id, {_MAIN} AS text FROM pages")
def q_extract_main_text(spark, sf):
    """Main text of every landed page."""
    return C.with_main_text(table(spark, sf, "pages").select("page_id", "html")).select("page_id", "text")


# The same blocks out of rows: tags are counted per element name over a page's tokens, so an element's end is the first
# end tag of its name at which fewer are open than at its start.  Holds for pages whose elements are closed in order.
_IN = lambda names: "(" + ", ".join(map(O.q, names)) + ")"
_PLAIN = "coalesce(html, '')"
for _pat in (r"<!--.*?-->", *(rf"<{n}\b[^>]*>.*?</{n}\s*>" for n in K.RAW_TAGS)):
    _PLAIN = f"regexp_replace({_PLAIN}, {O.q(_pat)}, '', 'gis')"
_SPACES = lambda x: f"trim(regexp_replace({x}, {O.q('[' + WS_CLASS + ']+')}, ' ', 'g'))"
_COUNT = lambda x: f"CASE WHEN {x} = '' THEN 0 ELSE length({x}) - length(replace({x}, ' ', '')) + 1 END"
_BLOCK_TEXT_SQL = f"""
WITH toks AS (SELECT page_id, regexp_extract_all({_PLAIN}, '<[^>]*>|[^<]+') AS toks FROM pages),
tok AS (SELECT page_id, unnest(toks) AS tok, unnest(range(len(toks))) AS pos FROM toks),
tag AS (
  SELECT page_id, pos, tok, starts_with(tok, '<') AS is_tag, starts_with(tok, '</') AS ends,
         lower(regexp_extract(tok, '^</?([A-Za-z][A-Za-z0-9:-]*)', 1)) AS name FROM tok),
named AS (
  SELECT *, is_tag AND NOT ends AND (name IN {_IN(K.OUTSIDE_TAGS)} OR list_has_any({_IN(K.OUTSIDE_WORDS).replace("(", "[").replace(")", "]")},
           string_split(lower(array_to_string(regexp_extract_all(tok, '\\b(?:class|id|role)="([^"]*)"', 1), ' ')), ' '))) AS outside
  FROM tag),
deep AS (
  SELECT *, sum(CASE WHEN NOT is_tag THEN 0 WHEN ends THEN -1 ELSE 1 END) OVER (PARTITION BY page_id, name ORDER BY pos) AS depth
  FROM named),
hidden AS (
  SELECT o.page_id, o.pos AS a, min(c.pos) AS b FROM deep o JOIN deep c
    ON c.page_id = o.page_id AND c.name = o.name AND c.ends AND c.pos > o.pos AND c.depth < o.depth
  WHERE o.outside GROUP BY 1, 2),
lined AS (
  SELECT *, sum(CASE WHEN name IN {_IN(K.BLOCK_TAGS)} OR outside THEN 1 ELSE 0 END) OVER (PARTITION BY page_id ORDER BY pos) AS blk,
         coalesce(last_value(CASE WHEN name = 'a' THEN NOT ends END IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY pos), false) AS linked
  FROM deep),
shown AS (
  SELECT page_id, blk, pos, CASE WHEN is_tag THEN ' ' ELSE tok END AS tok, linked AND NOT is_tag AS linked FROM lined l
  WHERE (NOT is_tag OR name = 'br') AND NOT EXISTS (SELECT 1 FROM hidden h WHERE h.page_id = l.page_id AND l.pos >= h.a AND l.pos < h.b)),
spaced AS (SELECT *, {_SPACES('tok')} AS t FROM shown),
summed AS (
  SELECT page_id, blk, {_SPACES(O.unescape_sql("string_agg(tok, '' ORDER BY pos)"))} AS text,
         sum(CASE WHEN linked THEN {_COUNT('t')} ELSE 0 END) AS links
  FROM spaced GROUP BY 1, 2),
counted AS (
  SELECT page_id, blk, text, links, greatest({_COUNT('text')}, length(regexp_replace(text, {O.q('[^' + K.UNSPACED[1:])}, '', 'g')) // 2) AS words
  FROM summed WHERE text <> ''),
dense AS (SELECT *, least(links, words) / words AS d FROM counted),
near AS (
  SELECT *, coalesce(lag(words) OVER w, 0) AS words0, coalesce(lag(d) OVER w, 0) AS d0, coalesce(lead(words) OVER w, 0) AS words2
  FROM dense WINDOW w AS (PARTITION BY page_id ORDER BY blk)),
judged AS (
  SELECT *, CASE WHEN d > {K.LINKED!r}::DOUBLE THEN false
                 WHEN d0 > {K.LINKED_BEFORE!r}::DOUBLE THEN words > {K.LONG_AFTER_LINKS} OR words2 > {K.LONG_NEXT_AFTER_LINKS}
                 ELSE words > {K.LONG} OR words2 > {K.LONG_NEXT} OR words0 > {K.NOT_TINY} END AS content
  FROM near),
done AS (
  SELECT page_id, string_agg(text, chr(10) ORDER BY blk) FILTER (content) AS main,
         string_agg(text, chr(10) ORDER BY blk) FILTER (d <= {K.LINKED!r}::DOUBLE) AS unlinked,
         count(*) AS n_blocks, count(*) FILTER (content) AS n_content FROM judged GROUP BY 1)
SELECT p.page_id, coalesce(main, unlinked) AS text, coalesce(n_blocks, 0)::INTEGER AS n_blocks, coalesce(n_content, 0)::INTEGER AS n_content
FROM pages p LEFT JOIN done d ON d.page_id = p.page_id"""


@register("main_text_blocks", _BLOCK_TEXT_SQL)
def q_main_text_blocks(spark, sf):
    """E11 by blocks: main text of every landed page from text and link density."""
    x = K.with_block_text(table(spark, sf, "pages").select("page_id", "html"))
    return x.select("page_id", "text", F.size("blocks").alias("n_blocks"), F.size(F.filter("blocks", lambda b: b["content"])).alias("n_content"))


def _content_log(spark, sf):
    m = media_items(spark, sf)
    return C.content_lookup(m, article_pages(spark, sf), "url", "url", F.lit(INGESTED_AT))


@register("content_lookup", W(f"""
, p AS (SELECT {O.article_url_sql('page_id')} AS url, {_MAIN} AS content_text FROM pages)
SELECT i.id, p.content_text FROM items i JOIN p ON p.url = i.url WHERE p.content_text IS NOT NULL"""))
def q_content_lookup(spark, sf):
    """Landed pages for items without text, looked up by url."""
    return _content_log(spark, sf).select("id", "content_text")


@register("apply_content", W(f"""
, p AS (SELECT {O.article_url_sql('page_id')} AS url, {_MAIN} AS content_text FROM pages)
SELECT i.id, CASE WHEN p.content_text IS NOT NULL THEN 'ok' END AS content_status,
  CAST(length(p.content_text) AS INTEGER) AS content_chars, i.content_hash
FROM items i LEFT JOIN p ON p.url = i.url AND p.content_text IS NOT NULL"""))
def q_apply_content(spark, sf):
    """Content log applied to the snapshot (content_hash kept: the
    log carries none)."""
    m = media_items(spark, sf)
    log = _content_log(spark, sf).withColumn("seq", F.lit(0))
    r = ST.apply_content(m, log)
    return r.select("id", "content_status", F.length("content_text").alias("content_chars"), "content_hash")


@register("apply_enrichment", W(f"""
, k AS (SELECT id, lower(coalesce(title, '') || ' ' || coalesce(summary, '')) AS ttext, sentiment AS old FROM items)
SELECT id, array_to_string({O.topics_sql('ttext', WORDS_TAXONOMY)}, ',') AS topics,
  CASE WHEN {_POSW} THEN 'positive' WHEN {_NEGW} THEN 'negative' ELSE 'neutral' END AS sentiment,
  'fallback_keyword' AS enrich_model
FROM k"""))
def q_apply_enrichment(spark, sf):
    """A keyword enrichment log (another taxonomy) overwrites the
    enrichment columns of every item it names."""
    m = media_items(spark, sf)
    log = keyword_enrich(m, WORDS_TAXONOMY, F.lit(INGESTED_AT)).withColumn("seq", F.lit(1))
    r = ST.apply_enrichment(m, log)
    return r.select("id", F.array_join("topics", ",").alias("topics"), "sentiment", "enrich_model")


def _unenriched_items(spark, sf):
    """The snapshot as ingestion leaves it: enrichment columns NULL."""
    m = media_items(spark, sf)
    from ..schema import ENRICHMENT_COLUMNS
    return m.select(*[F.lit(None).cast(m.schema[c].dataType).alias(c) if c in ENRICHMENT_COLUMNS else F.col(c)
                      for c in m.columns])


def _label_log(spark, sf):
    """Enrichment log of the items whose first document carries a label."""
    m = media_items(spark, sf)
    return m.filter(F.col("sentiment").isNotNull()).select("id")


@register("list_unenriched", W("""
SELECT id FROM items WHERE sentiment IS NULL"""))
def q_list_unenriched(spark, sf):
    """Items with no enrichment yet (no enriched_at, not in the log)."""
    return ST.list_unenriched(_unenriched_items(spark, sf), _label_log(spark, sf)).select("id")


@register("enrich_counts", W("""
SELECT count(*) AS pending, CAST(0 AS BIGINT) AS enriched_ok, CAST(0 AS BIGINT) AS enriched_error,
  count(*) AS skipped FROM items WHERE sentiment IS NULL"""))
def q_enrich_counts(spark, sf):
    """E9 for a keyword-path cycle over the pending items."""
    pend = ST.list_unenriched(_unenriched_items(spark, sf), _label_log(spark, sf))
    return EN.enrich_counts(pend, None, keyword_path=True)


@register("ingest_state", """
SELECT event_type AS source, strftime(arg_max(ts, event_id), '%Y-%m-%d %H:%M:%S') AS last_run_at,
  CAST(arg_max(user_id, event_id) AS VARCHAR) AS cursor FROM events GROUP BY event_type""")
def q_ingest_state(spark, sf):
    """T4: the event stream read as a per-source state log (source =
    event type, cursor = user id); last write per source wins."""
    ev = table(spark, sf, "events").select(
        F.col("event_type").alias("source"), F.col("event_id").alias("seq"),
        F.col("ts").cast("timestamp").alias("last_run_at"), F.col("user_id").cast("string").alias("cursor"))
    s = ST.ingest_state(ev)
    return s.select("source", _ts_out(F.col("last_run_at")).alias("last_run_at"), "cursor")


# ---------------------------------------------------------------------------
# Model responses: validation, retrying enrichment
# ---------------------------------------------------------------------------
_VARIANTS = """CASE CAST(first_seq % 9 AS INTEGER)
  WHEN 0 THEN '{}' WHEN 1 THEN '{"topics":null}' WHEN 2 THEN '{"topics":[1,"a"]}'
  WHEN 3 THEN '{"topics":["a",null]}' WHEN 4 THEN '{"is_editorial":"yes","language":"' || coalesce(language, 'xx') || '"}'
  WHEN 5 THEN '{"is_editorial":2}' WHEN 6 THEN '[]' WHEN 7 THEN 'nope'
  ELSE tags_json END"""


@register("validate_enrichment", None)
def q_validate_enrichment(spark, sf):
    """E7 over responses built from the items (valid tags and the hostile
    forms by a fixed rule)."""
    m = keyword_enrich(media_items(spark, sf), TEST_TAXONOMY, F.lit(INGESTED_AT),
                       keep=("id", "first_seq"))
    m = m.withColumn("language", F.lit(None).cast("string"))
    resp = F.expr(_VARIANTS.replace("coalesce(language, 'xx')", "'xx'"))
    v = m.select("id", resp.alias("response")).select("id", EN.validate_enrichment(F.col("response")).alias("e"))
    return v.select("id", "e.status", "e.error", F.array_join("e.topics", ",").alias("topics"),
                    "e.is_editorial", "e.language")


def stand_in_model(prompt: str, attempt: int) -> str | None:
    """A model stand-in: reads its answer out of the prompt and breaks it by
    a fixed rule of the item's number (every 64th never answers an object,
    every 16th answers a null list twice, every 4th wraps its first answer
    in prose, every 32nd from 5 on raises)."""
    number, tags = prompt.split("|", 1)
    n = int(number)
    if n % 32 == 5:
        raise TimeoutError("no answer")
    if n % 64 == 0:
        return "[]"
    if n % 16 == 0 and attempt <= 1:
        return '{"topics": null}'
    return "Sure! " + tags if n % 4 == 0 and attempt == 0 else tags


def _model_log(m, model=None, **kw):
    """(pending, enrichment log) of the items through the Arrow model path;
    the model gives no row at all for every 32nd item from 7 on."""
    pend = m.select("id", F.concat_ws("|", F.col("first_seq").cast("string"), "tags_json").alias("prompt"))
    model = model or EN.pandas_model(stand_in_model)
    silent = F.substring_index("prompt", "|", 1).cast("long") % 32 == 7
    log = EN.enrich_with_retry(pend, lambda df: model(df.filter(~silent)), model="stand-in", max_retries=2,
                               enriched_at=F.lit(INGESTED_AT), **kw)
    return pend, log


@register("enrich_counts_model", None)
def q_enrich_counts_model(spark, sf):
    """E9 for a model cycle: pending, ok and error."""
    m = keyword_enrich(media_items(spark, sf), TEST_TAXONOMY, F.lit(INGESTED_AT), keep=("id", "first_seq"))
    return EN.enrich_counts(*_model_log(m))


@register("enrich_with_retry", None)
def q_enrich_with_retry(spark, sf):
    """Retrying enrichment over every item through the Arrow model path
    with a deterministic stand-in; attempts are checkpointed."""
    m = keyword_enrich(media_items(spark, sf), TEST_TAXONOMY, F.lit(INGESTED_AT), keep=("id", "first_seq"))
    return _model_log(m)[1].select("id", "enrich_status", "enrich_error", "attempts",
                      F.array_join("topics", ",").alias("topics"))


def silent_model(prompt: str, attempt: int) -> str | None:
    """A model that is away: any answer must come from the call log."""
    raise ConnectionError("no model")


@register("enrich_resume", None)
def q_enrich_resume(spark, sf):
    """E8 through the call log: a first cycle fills it, a second one with the
    model away gives the same rows from the logged answers."""
    calls = f"{ensure_checkpoint_dir(spark).rstrip('/')}/covlens-calls-{uuid.uuid4().hex[:12]}"
    m = keyword_enrich(media_items(spark, sf), TEST_TAXONOMY, F.lit(INGESTED_AT), keep=("id", "first_seq"))
    m = m.select("id", "first_seq", "tags_json").checkpoint()  # the items are folded and tagged once for both cycles
    _model_log(m, EN.pandas_model(stand_in_model, concurrency=4), calls=calls, waves=2)
    log = _model_log(m, EN.pandas_model(silent_model), calls=calls)[1]
    return log.select("id", "enrich_status", "enrich_error", "attempts", F.array_join("topics", ",").alias("topics"))


@register("enrich_prompt", None)
def q_enrich_prompt(spark, sf):
    """the tagging prompt of every item (content from its page)."""
    m = media_items(spark, sf)
    pages = C.with_main_text(article_pages(spark, sf), "html", "content").drop("html")
    j = m.join(pages, "url", "left")
    p = EN.enrich_prompt(j, WORDS_TAXONOMY, F.col("content"))
    return j.select("id", F.length(p).alias("prompt_chars"), sha256_hex(p).alias("prompt_sha256"))


# ---------------------------------------------------------------------------
# Briefings
# ---------------------------------------------------------------------------
@register("briefing_prompt", None)
def q_briefing_prompt(spark, sf):
    """one briefing prompt per topic from its seed URLs."""
    seed = A.seed_urls(media_items(spark, sf), P)
    return B.briefing_prompts(seed, "id", f"{P.days} days").select("topic", "n_urls", F.length("prompt").alias("chars"))


def _strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^[{WS_CLASS}]+|[{WS_CLASS}]+$', '', 'g')"


@register("briefing_response", f"""
WITH c AS (
  SELECT conv_id,
    string_agg(CASE WHEN role = 'assistant' THEN text END, '\n' ORDER BY turn) AS answer,
    count(*) AS turns, min(turn) AS t0, max(turn) AS t1
  FROM conversations GROUP BY conv_id)
SELECT conv_id, {_strip_sql("coalesce(answer, '')")} AS text,
  CAST(least(turns, 20) AS INTEGER) AS n_citations,
  'https://example.org/c/' || CAST(conv_id AS VARCHAR) || '/' || CAST(t0 AS VARCHAR) AS first_citation
FROM c""")
def q_briefing_response(spark, sf):
    """F21 + F20 + T6: each conversation read as one model response (user
    turns inside a think block, assistant turns as the answer, one citation
    per turn), parsed, think block removed, citations cut to 20."""
    cv = table(spark, sf, "conversations")
    g = cv.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    think = F.array_join(F.transform(F.filter("t", lambda s: s["role"] != "assistant"), lambda s: s["text"]), "\n")
    answer = F.array_join(F.transform(F.filter("t", lambda s: s["role"] == "assistant"), lambda s: s["text"]), "\n")
    cites = F.transform("t", lambda s: F.concat(F.lit("https://example.org/c/"), F.col("conv_id").cast("string"),
                                                 F.lit("/"), s["turn"].cast("string")))
    resp = F.to_json(F.struct(
        F.array(F.struct(F.struct(F.concat(F.lit("<think>"), think, F.lit("</think>\n"), answer)
                                  .alias("content")).alias("message"))).alias("choices"),
        cites.alias("citations")))
    r = B.briefing_sections(g.select("conv_id", resp.alias("response")))
    return r.select("conv_id", "text", F.size("citations").alias("n_citations"),
                    F.element_at("citations", 1).alias("first_citation"))


# ---------------------------------------------------------------------------
# Oracles for the model-response family (DuckDB JSON functions)
# ---------------------------------------------------------------------------
def _kw_tags_sql(tx) -> str:
    """The keyword tags of an item as the compact JSON the tagger writes."""
    return (f"to_json({{'topics': {O.topics_sql('ttext', tx)}, 'actors': {O.actors_sql('ttext', tx)}, "
            f"'locations': []::VARCHAR[], 'language': CASE WHEN {_IDW} THEN 'id' END, "
            f"'is_editorial': CASE WHEN {_ED} THEN TRUE END, "
            f"'sentiment': CASE WHEN {_POSW} THEN 'positive' WHEN {_NEGW} THEN 'negative' ELSE 'neutral' END}})")


def _list_ok(r: str, f: str) -> str:
    t = f"json_type({r}, '$.{f}')"
    return (f"({t} IS NULL OR ({t} = 'ARRAY' AND NOT coalesce(list_bool_or(list_transform("
            f"json_extract({r}, '$.{f}[*]'), lambda x: json_type(x) <> 'VARCHAR')), FALSE)))")


def _validate_sql(r: str) -> str:
    """status/error/fields of a response text, mirroring the contract of
    validate_enrichment (error precedence included)."""
    ed_t = f"json_type({r}, '$.is_editorial')"
    ed_s = f"lower(json_extract_string({r}, '$.is_editorial'))"
    flag = (f"CASE WHEN {ed_t} = 'BOOLEAN' THEN CAST(json_extract_string({r}, '$.is_editorial') AS BOOLEAN) "
            f"WHEN {ed_t} = 'VARCHAR' AND {ed_s} IN {tuple(EN.TRUE_WORDS)} THEN TRUE "
            f"WHEN {ed_t} = 'VARCHAR' AND {ed_s} IN {tuple(EN.FALSE_WORDS)} THEN FALSE "
            f"WHEN {ed_t} IN ('UBIGINT', 'BIGINT', 'DOUBLE') AND TRY_CAST(json_extract_string({r}, '$.is_editorial') AS DOUBLE) = 1 THEN TRUE "
            f"WHEN {ed_t} IN ('UBIGINT', 'BIGINT', 'DOUBLE') AND TRY_CAST(json_extract_string({r}, '$.is_editorial') AS DOUBLE) = 0 THEN FALSE END")
    err = (f"CASE WHEN coalesce({r}, '') = '' THEN 'no_text' WHEN NOT json_valid({r}) THEN 'not_json' "
           f"WHEN json_type({r}) <> 'OBJECT' THEN 'not_object' "
           + " ".join(f"WHEN NOT {_list_ok(r, f)} THEN 'bad_{f}'" for f in EN.LIST_FIELDS) + " "
           + " ".join(f"WHEN coalesce(json_type({r}, '$.{f}'), 'NULL') NOT IN ('VARCHAR', 'NULL') THEN 'bad_{f}'"
                      for f in EN.TEXT_FIELDS) + " "
           f"WHEN coalesce({ed_t}, 'NULL') <> 'NULL' AND ({flag}) IS NULL THEN 'bad_is_editorial' END")
    return err, flag


_RESP = _VARIANTS.replace("coalesce(language, 'xx')", "'xx'").replace("ELSE tags_json END", "ELSE tags END")
_ERR, _FLAG = _validate_sql("safe")
ORACLE_VALIDATE = W(f"""
, k AS (SELECT id, first_seq, lower(coalesce(title, '') || ' ' || coalesce(summary, '')) AS ttext FROM items),
  t AS (SELECT id, first_seq, CAST({_kw_tags_sql(TEST_TAXONOMY)} AS VARCHAR) AS tags FROM k),
  r AS (SELECT id, {_RESP} AS response FROM t),
  r2 AS (SELECT id, response, CASE WHEN json_valid(response) THEN response ELSE 'null' END AS safe FROM r),
  v AS (SELECT id, safe, CASE WHEN coalesce(response, '') = '' THEN 'no_text' WHEN NOT json_valid(response)
                             THEN 'not_json' ELSE {_ERR} END AS error FROM r2)
SELECT id, CASE WHEN error IS NULL THEN 'ok' ELSE 'error' END AS status, error,
  CASE WHEN error IS NULL THEN array_to_string(coalesce(CAST(json_extract_string(safe, '$.topics[*]') AS VARCHAR[]), []::VARCHAR[]), ',') ELSE '' END AS topics,
  CASE WHEN error IS NULL THEN {_FLAG} END AS is_editorial,
  CASE WHEN error IS NULL THEN json_extract_string(safe, '$.language') END AS language
FROM v""")

ORACLE_RETRY = W(f"""
, k AS (SELECT id, first_seq, lower(coalesce(title, '') || ' ' || coalesce(summary, '')) AS ttext FROM items)
SELECT id, CASE WHEN lost OR first_seq % 64 = 0 THEN 'error' ELSE 'ok' END AS enrich_status,
  CASE WHEN lost THEN 'no_text' WHEN first_seq % 64 = 0 THEN 'not_object' END AS enrich_error,
  CASE WHEN lost OR first_seq % 16 = 0 THEN 3 WHEN first_seq % 4 = 0 THEN 2 ELSE 1 END AS attempts,
  CASE WHEN lost OR first_seq % 64 = 0 THEN '' ELSE array_to_string({O.topics_sql('ttext', TEST_TAXONOMY)}, ',') END AS topics
FROM (SELECT *, first_seq % 32 IN (5, 7) AS lost FROM k)""")

ORACLE_COUNTS = W("""
SELECT count(*) AS pending, count(*) FILTER (NOT bad) AS enriched_ok, count(*) FILTER (bad) AS enriched_error,
  CAST(0 AS BIGINT) AS skipped
FROM (SELECT first_seq % 32 IN (5, 7) OR first_seq % 64 = 0 AS bad FROM items)""")


def _prompt_sql() -> str:
    from ..operators.prompt_text import prompt_head_parts, prompt_tail_parts
    parts = prompt_tail_parts()
    fields = ["coalesce(platform, 'None')", "coalesce(source_type, 'None')",
              "coalesce(publisher_or_author, 'None')", "coalesce(url, 'None')",
              O.clean_sql("title"), O.clean_sql("summary"), f"substring({O.clean_sql('content')}, 1, 4000)"]
    expr = " || ".join(O.clean_sql(O.q(t)) if raw else O.q(t) for t, raw in prompt_head_parts(WORDS_TAXONOMY))
    for lit, f in zip(parts, fields):
        expr += f" || {O.q(lit)} || {f}"
    expr += f" || {O.q(parts[-1])}"
    return expr


ORACLE_PROMPT = W(f"""
, p AS (SELECT {O.article_url_sql('page_id')} AS url, {_MAIN} AS content FROM pages),
  j AS (SELECT i.*, p.content FROM items i LEFT JOIN p ON p.url = i.url),
  x AS (SELECT id, {_prompt_sql()} AS prompt FROM j)
SELECT id, CAST(length(prompt) AS INTEGER) AS prompt_chars, sha256(prompt) AS prompt_sha256 FROM x""")


def _briefing_sql() -> str:
    from ..operators.prompt_text import briefing_parts
    head, mid, urls_head, end = briefing_parts("id", f"{P.days} days")
    seed = ORACLES["seed_urls"]
    body = seed[seed.index("SELECT topic, CAST(row_number()"):]
    pre = seed[:seed.index("SELECT topic, CAST(row_number()")]
    return (pre + ", s AS (" + body + f""")
SELECT topic, CAST(count(*) AS INTEGER) AS n_urls,
  CAST(length({O.q(head)} || topic || {O.q(mid)} || 'Update ' || upper(substring(topic, 1, 1)) || substring(topic, 2)
    || {O.q(urls_head)} || string_agg('- ' || url, chr(10) ORDER BY rank) || {O.q(end)}) AS INTEGER) AS chars
FROM s GROUP BY topic""")


from .queries import ORACLES  # noqa: E402

ORACLES["validate_enrichment"] = ORACLE_VALIDATE
ORACLES["enrich_with_retry"] = ORACLES["enrich_resume"] = ORACLE_RETRY
ORACLES["enrich_counts_model"] = ORACLE_COUNTS
ORACLES["enrich_prompt"] = ORACLE_PROMPT
ORACLES["briefing_prompt"] = _briefing_sql()


@register("distinct_preserve", """
WITH w AS (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS p
           FROM (SELECT doc_id, string_split(lower(text), ' ') AS ws FROM documents)),
  f AS (SELECT doc_id, w, min(p) AS p FROM w WHERE w <> '' GROUP BY doc_id, w),
  a AS (SELECT doc_id, string_agg(w, ',' ORDER BY p) AS words FROM f GROUP BY doc_id)
SELECT d.doc_id, coalesce(a.words, '') AS words FROM documents d LEFT JOIN a USING (doc_id)""")
def q_distinct_preserve(spark, sf):
    """the words of each document, empties dropped, de-duplicated in
    first-seen order."""
    from ..functions.text import distinct_preserve
    d = table(spark, sf, "documents")
    w = F.split(F.lower(F.col("text")), " ")
    return d.select("doc_id", F.array_join(distinct_preserve(w), ",").alias("words"))
