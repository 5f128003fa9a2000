"""Registered queries of the operators, with their production parameters, and their DuckDB oracles."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from covlens.llm import (bpe, decontam, impact_topk, line_templates, maglev, merkle, minhash, repetition, secret_scan, spelling,
                         toxicity, url_cascade, warc)

SHARDS, SLOTS = 64, 6563


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_subword_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels outside the held-out fold."""
    docs, labels = _table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels, ~toxicity.held_out(labels["doc_id"]))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", toxicity.held_out(scored["doc_id"]).alias("held_out"), "score", "predicted")


def op2_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of every page."""
    return warc.build(_table(spark, sf_dir, "pages"), date="2024-01-31T00:00:00Z").drop("record")


def op3_bpe_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids and of the decoded text of every document."""
    return bpe.encode(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)


def op4_impact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other vectors of every vector whose id is divisible by 50."""
    vectors = _table(spark, sf_dir, "embeddings")
    return impact_topk.search(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op5_maglev_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    placed = maglev.place(docs, "doc_id", [f"shard-{i:03d}" for i in range(SHARDS)], SLOTS, spread=["text"])
    return placed.select("doc_id", "slot", "shard")


def op6_minhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate group of every document."""
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op7_linked_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document, weak candidates where complementary parts meet."""
    return secret_scan.scan(_table(spark, sf_dir, "documents"))


def op8_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines of recurring templates."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_templates.drop_recurring(docs)


def op9_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page; the list names the keys under which some page was reached through a tracked link."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_cascade.filter_urls(pages, listed=pages["url"].rlike(r"[?&](utm_source|ref)="))


def op10_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlaps of documents with benchmark items."""
    return decontam.find_overlaps(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality counts of every document, and a verdict on what repeats within it."""
    return repetition.judge(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text", "longest_repeat")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the corpus with the frequent word it is a variant of."""
    return spelling.variants(_table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, held against the tampered rows."""
    return merkle.manifest(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_subword_toxicity": op1_subword_toxicity,
    "op2_warc_derivatives": op2_warc_derivatives,
    "op3_bpe_ranks": op3_bpe_ranks,
    "op4_impact_topk": op4_impact_topk,
    "op5_maglev_shards": op5_maglev_shards,
    "op6_minhash_components": op6_minhash_components,
    "op7_linked_secrets": op7_linked_secrets,
    "op8_line_templates": op8_line_templates,
    "op9_url_cascade": op9_url_cascade,
    "op10_spaced_seeds": op10_spaced_seeds,
    "op11_suffix_repeats": op11_suffix_repeats,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_merkle_manifest": op13_merkle_manifest,
}

#: crc32 by its definition: a table of 256 steps, folded over the bytes of a string.
_CRC = """
crc_table AS MATERIALIZED (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
           CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t)"""


def _crc(text: str) -> str:
    return f"""xor(list_reduce(list_transform(range(1, strlen({text}) + 1), lambda i: ('0x' || substr(hex(encode({text})), 2 * i - 1, 2))::BIGINT),
             lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"""


_FIELD = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

#: The other code points of words as bytes that no word holds: `levenshtein` counts bytes.
_ACCENTED = f"'{bytes(range(0xC0, 0x100)).decode('latin-1')}', '{bytes(range(33, 97)).decode().replace(chr(39), chr(39) * 2)}'"

#: The levels of a tree of digests over `nodes(g, i, h)`, `path(g, leaf, lvl, b, a)` with what stands before and after.
_TREE = """
{0}levels(g, lvl, i, h, n) AS (
  SELECT g, 0, i, h, count(*) OVER (PARTITION BY g) FROM {0}nodes
  UNION ALL
  SELECT g, lvl + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 7) // 8 FROM {0}levels WHERE n > 1
  GROUP BY g, lvl, i // 8),
{0}sides AS (
  SELECT g, lvl, i, h, n, coalesce(string_agg(h, '') OVER (PARTITION BY g, lvl, i // 8 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
         coalesce(string_agg(h, '') OVER (PARTITION BY g, lvl, i // 8 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a
  FROM {0}levels)"""

ORACLES = {
    "op11_suffix_repeats": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
pos AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
ahead AS (
  SELECT doc_id, i, word, word || ' ' || lead(word, 1) OVER doc || ' ' || lead(word, 2) OVER doc AS w3, lead(word, 3) OVER doc AS x3,
         lead(word, 4) OVER doc AS x4 FROM pos WINDOW doc AS (PARTITION BY doc_id ORDER BY i)),
win AS (SELECT doc_id, i, word, w3, w3 || ' ' || x3 || ' ' || x4 AS w5 FROM ahead),
win25 AS (
  SELECT *, w5 || ' ' || lead(w5, 5) OVER doc || ' ' || lead(w5, 10) OVER doc || ' ' || lead(w5, 15) OVER doc || ' ' || lead(w5, 20) OVER doc
         AS w25 FROM win WINDOW doc AS (PARTITION BY doc_id ORDER BY i)),
win51 AS (
  SELECT *, w25 || ' ' || lead(w25, 25) OVER doc || ' ' || lead(word, 50) OVER doc AS w51 FROM win25 WINDOW doc AS (PARTITION BY doc_id ORDER BY i)),
again AS (
  SELECT doc_id, i, w3 IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, w3) > 1 AS r3,
         w5 IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, w5) > 1 AS r5,
         w51 IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, w51) > 1 AS r51 FROM win51),
covered AS (
  SELECT doc_id, bool_or(r3) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS c3,
         bool_or(r5) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS c5, r51 FROM again),
counts AS (SELECT doc_id, count(*) FILTER (c3) AS c3, count(*) FILTER (c5) AS c5, bool_or(r51) AS r51 FROM covered GROUP BY 1),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS dup FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1),
r AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, coalesce(dup, 0)::BIGINT AS n_dup_lines,
         coalesce(c3, 0)::BIGINT AS n_repeat_words, coalesce(c5, 0)::BIGINT AS n_covered, coalesce(r51, false) AS r51
  FROM d LEFT JOIN counts USING (doc_id) LEFT JOIN lines USING (doc_id))
SELECT * EXCLUDE (r51), n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * n_covered <= 40 * n_words AND NOT r51 AS kept FROM r
""",
    "op12_spelling_variants": f"""
WITH RECURSIVE {_CRC},
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, {_AZ}), '[A-Za-zÀ-ÿ]+')) AS r FROM documents),
times AS (SELECT doc_id, r, count(*) AS k FROM runs WHERE length(r) >= 6 GROUP BY ALL),
hashed AS (SELECT r, k, {_crc("(doc_id::VARCHAR || ':' || r)")} AS h FROM times, crc_table),
words AS (SELECT CASE WHEN h % 199 = 0 THEN substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS word, k FROM hashed),
v AS (SELECT word, sum(k)::BIGINT AS n FROM words WHERE length(word) >= 6 GROUP BY 1 HAVING sum(k) >= 5),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS m FROM v a JOIN v b ON abs(length(a.word) - length(b.word)) <= 1 AND a.word <> b.word
     AND (left(a.word, 3) = left(b.word, 3) OR right(a.word, 3) = right(b.word, 3))
  WHERE levenshtein(translate(a.word, {_ACCENTED}), translate(b.word, {_ACCENTED})) = 1),
best AS (SELECT word, count(*) AS n_near, max(m) AS m FROM near GROUP BY 1),
named AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN best.m >= 5 * v.n THEN (SELECT min(other) FROM near WHERE near.word = v.word AND near.m = best.m) END AS form,
         CASE WHEN best.m >= 5 * v.n THEN best.m END AS form_n
  FROM v LEFT JOIN best ON best.word = v.word),
up(word, dest) AS (
  SELECT word, word FROM named UNION ALL
  SELECT up.word, named.form FROM up JOIN named ON named.word = up.dest WHERE named.form IS NOT NULL)
SELECT named.word, named.form, up.dest AS root, named.n, named.n_near, named.form_n
FROM named JOIN up ON up.word = named.word JOIN named l ON l.word = up.dest AND l.form IS NULL
""",
    "op13_merkle_manifest": f"""
WITH RECURSIVE {_CRC},
l AS (
  SELECT doc_id, lang, {_crc("doc_id::VARCHAR")} % 3 = 0 AS tampered,
         sha256(concat({", ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))})) AS leaf,
         sha256(concat({", ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", f"translate(text, {_AZ})"))})) AS changed
  FROM documents, crc_table),
groups AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS g FROM (SELECT DISTINCT lang FROM documents)),
leaf AS (
  SELECT doc_id, g, leaf, CASE WHEN tampered THEN changed ELSE leaf END AS now,
         row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i
  FROM l JOIN groups ON l.lang IS NOT DISTINCT FROM groups.lang),
doc_nodes AS (SELECT g, i, leaf AS h FROM leaf),
{_TREE.format("doc_")},
lang_nodes AS (SELECT 0::BIGINT AS g, g AS i, h FROM doc_levels WHERE n = 1),
{_TREE.format("lang_")},
root AS (SELECT h AS root FROM lang_levels WHERE n = 1),
walk(doc_id, g, leaf, lvl, i, k, folded, proof) AS (
  SELECT doc_id, g, leaf, 0, i, 0, now, '' FROM leaf
  UNION ALL
  SELECT w.doc_id, w.g, w.leaf,
         CASE WHEN d.n = 1 AND w.k = 0 THEN 0 ELSE w.lvl + 1 END, CASE WHEN d.n = 1 AND w.k = 0 THEN w.g ELSE w.i // 8 END,
         CASE WHEN d.n = 1 THEN w.k + 1 ELSE w.k END,
         CASE WHEN d.n = 1 THEN w.folded ELSE sha256(d.b || w.folded || d.a) END,
         CASE WHEN d.n = 1 THEN w.proof ELSE w.proof || d.b || d.a END
  FROM walk w JOIN (SELECT 0 AS k, * FROM doc_sides UNION ALL SELECT 1, * FROM lang_sides) d
    ON d.k = w.k AND d.lvl = w.lvl AND d.i = w.i AND (w.k = 1 OR d.g = w.g))
SELECT doc_id, leaf, lang_nodes.h AS subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM walk JOIN lang_nodes ON lang_nodes.i = walk.g, root WHERE k = 2
""",
    "op4_impact_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 5
""",
    "op5_maglev_shards": f"""
WITH RECURSIVE pref AS (
  SELECT i AS s,
         ('0x' || substr(md5('shard-' || lpad(i::VARCHAR, 3, '0') || '|offset'), 1, 15))::BIGINT % {SLOTS} AS o,
         ('0x' || substr(md5('shard-' || lpad(i::VARCHAR, 3, '0') || '|skip'), 1, 15))::BIGINT % {SLOTS - 1} + 1 AS k
  FROM range({SHARDS}) t(i)),
fill(turn, owner) AS (
  SELECT 0::BIGINT, list_transform(range({SLOTS}), lambda x: -1)
  UNION ALL
  SELECT turn + 1, list_transform(owner, lambda v, p: CASE WHEN p - 1 = slot THEN s ELSE v END)
  FROM (SELECT turn, owner, s,
               (o + k * list_filter(range({SLOTS}), lambda j: owner[(o + k * j) % {SLOTS} + 1] = -1)[1]) % {SLOTS} AS slot
        FROM fill JOIN pref ON pref.s = fill.turn % {SHARDS} WHERE turn < {SLOTS})),
lookup AS (SELECT owner FROM fill WHERE turn = {SLOTS}),
keyed AS (
  SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, md5(coalesce(text, chr(0))))), 1, 15))::BIGINT % {SLOTS} AS slot
  FROM documents)
SELECT doc_id, slot, 'shard-' || lpad(owner[slot + 1]::VARCHAR, 3, '0') AS shard FROM keyed, lookup
""",
    "op9_url_cascade": """
WITH p AS (
  SELECT page_id, url,
         coalesce(translate(CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*') ELSE '' END,
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END, '') AS path
  FROM pages),
k AS (SELECT host || path AS key, bool_or(coalesce(regexp_matches(url, '[?&](utm_source|ref)='), false)) AS listed FROM p GROUP BY 1),
rules(h, pre, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                            ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
best AS (
  SELECT page_id, arg_max(h || pre, length(h) * 1000 + length(pre)) AS rule, arg_max(v, length(h) * 1000 + length(pre)) AS v
  FROM p JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, pre) GROUP BY 1)
SELECT p.page_id, p.host, p.path, best.rule, coalesce(best.v, CASE WHEN k.listed THEN 'block' ELSE 'allow' END) AS verdict, k.listed
FROM p JOIN k ON k.key = p.host || p.path LEFT JOIN best ON best.page_id = p.page_id
""",
}
