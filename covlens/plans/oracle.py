"""DuckDB SQL oracles, written independently of the Spark code: the same
binding and the same semantics, spelled as plain SQL over the test
tables.  Used by the driver's correctness check and by tests."""

from __future__ import annotations

from ..config import EDITORIAL_WORDS, TEST_REPORT, TEST_TAXONOMY, Taxonomy
from ..functions.text import WS_CLASS

NOW = "2024-01-31 00:00:00"
SINCE = "2024-01-24 00:00:00"
PREV = "2024-01-17 00:00:00"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def unescape_sql(x: str) -> str:
    """The character references the test tables contain, &amp; last."""
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
                    ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"),
                    ("&amp;", "&")):
        x = f"replace({x}, {q(ent)}, {q(ch)})"
    return x


def clean_sql(x: str) -> str:
    t = unescape_sql(f"coalesce({x}, '')")
    t = f"regexp_replace({t}, '<[^>]+>', ' ', 'g')"
    t = f"regexp_replace({t}, 'https?://[^{WS_CLASS}]+', ' ', 'g')"
    t = f"regexp_replace({t}, '[{WS_CLASS}]+', ' ', 'g')"
    return f"trim({t})"


def any_sql(text: str, words) -> str:
    words = [w.lower() for w in words]
    if not words:
        return "FALSE"
    return "(" + " OR ".join(f"contains({text}, {q(w)})" for w in words) + ")"


def topics_sql(text: str, tx: Taxonomy) -> str:
    elems = []
    for t in tx.topics:
        cond = ["TRUE"]
        if t.keywords:
            cond.append(any_sql(text, t.keywords))
        if t.locations:
            cond.append(any_sql(text, t.locations))
        elems.append(f"CASE WHEN {' AND '.join(cond)} THEN {q(t.name)} END")
    return f"list_filter([{', '.join(elems)}]::VARCHAR[], lambda x: x IS NOT NULL)"


def actors_sql(text: str, tx: Taxonomy) -> str:
    if not tx.actors:
        return "[]::VARCHAR[]"
    elems = [f"CASE WHEN contains({text}, {q(a.lower())}) THEN {q(a)} END" for a in tx.actors]
    return f"list_filter([{', '.join(elems)}]::VARCHAR[], lambda x: x IS NOT NULL)"


def article_url_sql(a: str) -> str:
    return (f"'https://www.src' || CAST(CASE WHEN {a} % 3 = 0 THEN 0 ELSE {a} % 20 END AS VARCHAR)"
            f" || '.example.com/a/' || CAST({a} AS VARCHAR)")


def url_sql(doc_id: str) -> str:
    a = f"(CASE WHEN {doc_id} % 40 >= 36 THEN {doc_id} - 20 WHEN {doc_id} % 40 = 35 THEN {doc_id} - 18 ELSE {doc_id} END)"
    return f"CASE WHEN {doc_id} % 97 = 5 THEN '' ELSE {article_url_sql(a)} END"


EVENT_TIMES = """(SELECT event_id // 10 AS doc_id, ts FROM events QUALIFY row_number() OVER (
    PARTITION BY event_id // 10 
    ORDER BY CAST(floor(coalesce(value, -1.0) * 1000000) AS BIGINT) * 10 + event_id % 10 DESC) = 1)"""


def binding_ctes(tx: Taxonomy = TEST_TAXONOMY) -> str:
    """CTEs: obs (one row per document), items (upsert fold)."""
    return f"""
b_doc AS (
  SELECT doc_id, source, lang, substring(text, 1, 80) AS t_raw, substring(text, 81) AS s_raw
  FROM documents),
b_x AS (
  SELECT b.*, l.quality, l.toxic, e.ts
  FROM b_doc b LEFT JOIN labels l ON l.doc_id = b.doc_id
               LEFT JOIN {EVENT_TIMES} e ON e.doc_id = b.doc_id),
b_o1 AS (
  SELECT doc_id AS seq,
    CASE doc_id % 4 WHEN 0 THEN 'rss' WHEN 1 THEN 'gdelt' WHEN 2 THEN 'mediastack' ELSE 'youtube' END AS platform,
    source AS publisher_or_author,
    {url_sql('doc_id')} AS url,
    NULLIF({clean_sql('t_raw')}, '') AS title,
    NULLIF({clean_sql('s_raw')}, '') AS summary,
    CASE WHEN doc_id % 17 <> 0 THEN ts END AS published_at,
    TIMESTAMP '{NOW}' AS ingested_at,
    lang AS language,
    CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' WHEN quality = 0 THEN 'neutral' END AS sentiment,
    CAST((doc_id % 40) // 10 AS BIGINT) AS batch_id
  FROM b_x),
b_o2 AS (
  SELECT *, sha256(platform || '|' || url) AS id,
    sha256(substring(coalesce(title, ''), 1, 200) || '||' || substring(coalesce(summary, ''), 1, 200)) AS content_hash,
    lower(coalesce(title, '') || ' ' || coalesce(summary, '')) AS ttext
  FROM b_o1),
obs AS (
  SELECT *, CASE WHEN platform = 'youtube' THEN 'social' ELSE 'news' END AS source_type
  FROM b_o2),
b_last AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn FROM obs),
b_first AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq) AS rn FROM obs),
b_cnt AS (SELECT id, count(*) AS n_observations, min(seq) AS first_seq, max(seq) AS last_seq FROM obs GROUP BY id),
b_snap AS (
  SELECT l.id, l.platform, l.source_type, l.publisher_or_author, l.url, l.title, l.summary,
    l.published_at, l.ingested_at, f.content_hash, f.language, f.sentiment,
    c.n_observations, c.first_seq, c.last_seq,
    lower(coalesce(l.title, '') || ' ' || coalesce(l.summary, '')) AS stext
  FROM b_last l JOIN b_first f ON f.id = l.id AND f.rn = 1
                JOIN b_cnt c ON c.id = l.id
  WHERE l.rn = 1),
items AS (
  SELECT * EXCLUDE (stext), {topics_sql('stext', tx)} AS topics, {actors_sql('stext', tx)} AS actors,
    CASE WHEN {any_sql('stext', EDITORIAL_WORDS)} THEN TRUE END AS is_editorial
  FROM b_snap),
win AS (
  SELECT *, published_at >= TIMESTAMP '{SINCE}' AS is_current,
    coalesce(NULLIF(publisher_or_author, ''), 'unknown') AS publisher,
    {domain_sql('url')} AS domain,
    strftime(coalesce(published_at, ingested_at), '%Y-%m-%d') AS day,
    CASE WHEN lower(trim(coalesce(sentiment, ''))) IN ('positive', 'neutral', 'negative')
         THEN lower(trim(sentiment)) END AS sent
  FROM items WHERE published_at >= TIMESTAMP '{PREV}'),
cur AS (SELECT * FROM win WHERE is_current)"""


def domain_sql(url: str) -> str:
    after = f"CASE WHEN strpos({url}, '//') > 0 THEN substring({url}, strpos({url}, '//') + 2) ELSE {url} END"
    return (f"CASE WHEN coalesce({url}, '') = '' THEN 'unknown' "
            f"ELSE lower(split_part({after}, '/', 1)) END")


def with_binding(body: str, tx: Taxonomy = TEST_TAXONOMY) -> str:
    return "WITH " + binding_ctes(tx).strip() + "\n" + body


def top_k_sql(src: str, key: str, k: int | None) -> str:
    lim = f" LIMIT {k}" if k else ""
    return (f"SELECT CAST(row_number() OVER (ORDER BY n DESC, {key}) AS BIGINT) AS rank, {key}, n "
            f"FROM (SELECT {key}, count(*) AS n FROM {src} GROUP BY {key} ORDER BY n DESC, {key}{lim})")


CRITICAL = TEST_REPORT.critical_topics
