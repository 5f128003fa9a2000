"""URL filter: a Bloom filter cascade over the corpus's own keys, after longest-match host and path rules.

The key universe is every distinct key of the corpus.  Level 1 is a Bloom filter of the listed keys; level 2 encodes
the unlisted keys that level 1 lets through; level 3 the listed keys that level 2 lets through; and so on until a
level has no false positive left.  Because the universe is complete, walking the levels answers membership exactly
for every key of the corpus, with a few bits per listed key and without joining the pages to the list.

Everything is DataFrame work: positions are `xxhash64` with double hashing, a level is a table of 64-bit words built
by `bit_or`, and a level reaches the tasks as a scalar subquery (an array of words).  The keys are split by hash into
as many segments as the larger of the first two levels needs to stay within `max_level_bytes`: the listed keys, and the
share of the unlisted ones that a filter lets through (all later levels are shares of these two).  Each level is counted
before it is built; if one is too large after all, the keys are split into twice as many segments.  Each segment has a
cascade of its own, and the pages are judged segment by segment.  The survivors of a level are
written to the shared checkpoint folder, so a lost executor costs one level.

Defined results: a null url, or one without `://`, has an empty host and path, no rule, and the key `""`; a null key
is never listed; an empty universe or an empty list gives verdict "not listed" for all; repeated urls share a verdict.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covlens.session import ensure_checkpoint_dir

LEAST_BITS = 1024  # of a level
#: (host, path, verdict); a rule holds for its host and all subdomains, for urls whose path starts with its path.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def url_host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end; A-Z lower-cased.  Null or no `://`: empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(_ascii_lower(host), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end.  Null or no `://`: empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule text, its verdict) of the longest fitting rule, else nulls.  Longer host first, then longer path."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0]), len(r[1]))):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text = F.when(fits, F.lit(h + p)).otherwise(text)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return text, verdict


class Cascade:
    """The levels of one segment: (word table, words, hashes) each."""

    def __init__(self, seed: int):
        self.seed, self.levels = seed, []

    def add(self, words: DataFrame, n_words: int, hashes: int) -> None:
        self.levels.append((words, n_words, hashes))

    def _passes(self, key: Column, i: int) -> Column:
        words, n_words, hashes = self.levels[i]
        dense = words.agg(F.array_sort(F.collect_list(F.struct("idx", "bits"))).alias("w")) \
                     .select(F.col("w.bits").alias("w")).scalar()
        out = F.lit(True)
        for p in bit_positions(key, self.seed + i, n_words * 64, hashes):
            out = out & (_bit(F.get(dense, F.shiftright(p, 6).cast("int")), p) == 1)
        return out

    def contains(self, key: Column) -> Column:
        """Exact for the keys of the universe: the parity of the first level that refuses the key."""
        out = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            out = F.when(~self._passes(key, i), F.lit(i % 2 == 1)).otherwise(out)
        return F.coalesce(out, F.lit(False))


def _bit(word: Column, p: Column) -> Column:
    return F.call_function("shiftrightunsigned", word, p.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1))


def bit_positions(key: Column, seed: int, bits: int, hashes: int) -> list[Column]:
    """`hashes` positions in [0, bits) by double hashing of two 64-bit hashes."""
    a, b = F.xxhash64(key, F.lit(seed)), F.xxhash64(key, F.lit(-1 - seed))
    return [F.pmod(F.shiftright(a, 2) + F.lit(j) * F.shiftright(b, 8).bitwiseOR(F.lit(1)), F.lit(bits))
            for j in range(hashes)]


def _words(keys: DataFrame, seed: int, n_words: int, hashes: int) -> DataFrame:
    set_bits = (keys.select(F.explode(F.array(*bit_positions(F.col("key"), seed, n_words * 64, hashes))).alias("p"))
                .select(F.shiftright("p", 6).alias("idx"),
                        F.expr("shiftleft(1L, cast(p & 63 as int))").alias("bits")))
    zeros = keys.sparkSession.range(n_words).select(F.col("id").alias("idx"), F.lit(0).cast("bigint").alias("bits"))
    return set_bits.unionByName(zeros).groupBy("idx").agg(F.bit_or("bits").alias("bits"))


def build(universe: DataFrame, false_rate: float = 0.02, max_level_bytes: int = 32 << 20,
          max_levels: int = 64) -> list[Cascade]:
    """One cascade per segment for `universe` (`key` string, `listed` boolean; one row per key)."""
    ensure_checkpoint_dir(universe.sparkSession)
    hashes = max(1, round(-math.log2(false_rate)))
    keys = universe.where(F.col("key").isNotNull()).select("key", "listed").checkpoint()
    listed, unlisted = keys.agg(F.count_if("listed"), F.count_if(~F.col("listed"))).first()
    bits = lambda n: max(LEAST_BITS, math.ceil(n * hashes / math.log(2)))
    largest = bits(max(listed, math.ceil(false_rate * unlisted)))
    segments = max(1, math.ceil(largest / 8 / max_level_bytes))
    while (out := _cascades(keys, segments, bits, hashes, max(max_level_bytes, LEAST_BITS // 8), max_levels)) is None:
        segments *= 2
    return out


def _cascades(keys: DataFrame, segments: int, bits: Callable[[int], int], hashes: int, max_level_bytes: int,
              max_levels: int) -> list[Cascade] | None:
    """The cascades of `segments` hash shares of the keys, or None if one of their levels is too large."""
    out = []
    for s in range(segments):
        part = keys if segments == 1 else keys.where(F.pmod(F.xxhash64("key"), F.lit(segments)) == s)
        cascade, inside, other = Cascade(1000 * s), part.where("listed"), part.where(~F.col("listed"))
        for level in range(max_levels):
            n = inside.count()
            if n == 0:
                break
            if bits(n) > 8 * max_level_bytes:
                return None
            n_words = math.ceil(bits(n) / 64)
            words = _words(inside, cascade.seed + level, n_words, hashes).checkpoint()
            cascade.add(words, n_words, hashes)
            through = other.where(cascade._passes(F.col("key"), level)).checkpoint()
            inside, other = through, inside
        else:
            raise RuntimeError(f"cascade not finished after {max_levels} levels")
        out.append(cascade)
    return out


def listed_by(cascades: list[Cascade], key: Column) -> Column:
    """Membership of a key of the universe in the list, as one expression over all segments."""
    out = F.lit(False)
    for s, c in enumerate(cascades):
        hit = c.contains(key)
        out = hit if len(cascades) == 1 else F.when(
            F.pmod(F.xxhash64(key), F.lit(len(cascades))) == s, hit).otherwise(out)
    return F.coalesce(out, F.lit(False))


def filter_urls(pages: DataFrame, listed: Column, rules: Sequence[tuple[str, str, str]] = RULES,
                false_rate: float = 0.02, max_level_bytes: int = 32 << 20) -> DataFrame:
    """page_id, host, path, rule, verdict, listed of every page.  `listed` is a condition over `pages`: a key
    (host and path) is on the block list if any page under it meets the condition.  The longest rule decides;
    where none fits, listed keys are blocked and all others allowed."""
    base = pages.select("page_id", url_host(pages["url"]).alias("host"), url_path(pages["url"]).alias("path"),
                        F.coalesce(listed, F.lit(False)).alias("hit"))
    key = F.concat("host", "path")
    universe = base.groupBy(key.alias("key")).agg(F.max("hit").alias("listed"))
    cascades = build(universe, false_rate, max_level_bytes)
    rule, by_rule = rule_of(F.col("host"), F.col("path"), rules)
    judge = lambda df, on_list: df.select(
        "page_id", "host", "path", on_list.alias("listed")).select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(by_rule, F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"), "listed")
    if len(cascades) == 1:
        return judge(base, cascades[0].contains(key))
    out = None
    for s, c in enumerate(cascades):  # one pass per segment: only one segment's levels are in memory at a time
        part = judge(base.where(F.pmod(F.xxhash64(key), F.lit(len(cascades))) == s), c.contains(key))
        out = part if out is None else out.unionByName(part)
    return out
