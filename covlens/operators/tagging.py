"""Keyword tagging (E1-E6): topics, actors, editorial flag, sentiment and
language as native column expressions.

Substring semantics are deliberate: a keyword hits anywhere inside the
lower-cased `title + " " + summary`, including inside other words.  A small
taxonomy is compiled into one OR-chain of `contains` per topic, so the whole
tagger is a projection inside whole-stage codegen: no join, no shuffle.  From
AUTOMATON_FROM words on, where such a plan and its time grow with words times
text, an Aho-Corasick automaton in an Arrow batch reads each text once for
all words.  Both give the same rows."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import (EDITORIAL_WORDS, KEYWORD_MODEL, LANGUAGE_ID_WORDS, NEGATIVE_WORDS,
                      POSITIVE_WORDS, Taxonomy)
from ..functions.jsonf import compact_json
from ..functions.text import clean_again

AUTOMATON_FROM = 200  # words of a taxonomy


def empty_array() -> Column:
    return F.array().cast("array<string>")


def tag_text(title: Column, summary: Column) -> Column:
    """lower(clean(title) + ' ' + clean(summary)); content is not used."""
    return F.lower(F.concat(clean_again(title), F.lit(" "), clean_again(summary)))


def _any(text: Column, words) -> Column:
    words = [w.lower() for w in words]
    if not words:
        return F.lit(False)
    hit = text.contains(words[0])
    for w in words[1:]:
        hit = hit | text.contains(w)
    return hit


def keyword_topics(text: Column, taxonomy: Taxonomy) -> Column:
    """Topics in config order; a topic needs (no keywords or a keyword
    hit) and (no locations or a location hit)."""
    if not taxonomy.topics:
        return empty_array()
    elems = []
    for t in taxonomy.topics:
        cond = F.lit(True)
        if t.keywords:
            cond = cond & _any(text, t.keywords)
        if t.locations:
            cond = cond & _any(text, t.locations)
        elems.append(F.when(cond, F.lit(t.name)))
    return F.array_compact(F.array(*elems)).cast("array<string>")


def keyword_actors(text: Column, taxonomy: Taxonomy) -> Column:
    """Seed actors (original spelling) whose lower form is a substring."""
    if not taxonomy.actors:
        return empty_array()
    return F.array_compact(F.array(*[F.when(text.contains(a.lower()), F.lit(a))
                                     for a in taxonomy.actors])).cast("array<string>")


def n_words(taxonomy: Taxonomy) -> int:
    return len(taxonomy.actors) + sum(len(t.keywords) + len(t.locations) for t in taxonomy.topics)


class _Matcher:
    """All words of a taxonomy in one automaton.  A word belongs to needs: the
    keywords of topic t are need (t, 0), its locations (t, 1), actor a is
    (a, 2).  A topic is given once every need that it has was met."""

    def __init__(self, taxonomy: Taxonomy):
        import ahocorasick
        self.topics, self.actors = taxonomy.topic_names, taxonomy.actors
        self.missing = [bool(t.keywords) + bool(t.locations) for t in taxonomy.topics]
        self.always = {t for t, n in enumerate(self.missing) if n == 0}
        needs: dict[str, set] = {}
        for i, t in enumerate(taxonomy.topics):
            for kind, words in enumerate((t.keywords, t.locations)):
                for w in words:
                    needs.setdefault(w.lower(), set()).add((i, kind))
        for i, a in enumerate(self.actors):
            needs.setdefault(a.lower(), set()).add((i, 2))
        self.empty = needs.pop("", set())  # the empty word stands in every text
        self.automaton = ahocorasick.Automaton()
        for w, owners in needs.items():
            self.automaton.add_word(w, (w, owners))
        self.automaton.make_automaton()

    def tags(self, text: str | None) -> tuple[list[str], list[str]]:
        met = set()
        if text is not None:
            met |= self.empty
            seen = {w: owners for _, (w, owners) in self.automaton.iter(text)} if len(self.automaton) else {}
            met.update(*seen.values())
        count: dict[int, int] = dict.fromkeys(self.always, 0)
        for i, kind in met:
            if kind < 2:
                count[i] = count.get(i, 0) + 1
        topics = [self.topics[i] for i in sorted(count) if count[i] == self.missing[i]]
        return topics, [self.actors[i] for i in sorted(i for i, kind in met if kind == 2)]


def keyword_tags(text: Column, taxonomy: Taxonomy) -> Column:
    """E1 + E2 as struct<topics, actors>, each text read once for all words.
    The automaton is built once per task from the taxonomy, whose size
    Taxonomy.from_frame checks."""
    @F.pandas_udf("struct<topics:array<string>,actors:array<string>>")
    def tag(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = _Matcher(taxonomy)
        for texts in batches:
            yield pd.DataFrame([m.tags(t) for t in texts], columns=["topics", "actors"])
    return tag(text)


def keyword_editorial(text: Column) -> Column:
    """TRUE on an editorial marker, else NULL (never FALSE)."""
    return F.when(_any(text, EDITORIAL_WORDS), F.lit(True)).cast("boolean")


def keyword_sentiment(text: Column) -> Column:
    """Positive words win over negative ones; otherwise neutral."""
    return (F.when(_any(text, POSITIVE_WORDS), F.lit("positive"))
            .when(_any(text, NEGATIVE_WORDS), F.lit("negative"))
            .otherwise(F.lit("neutral")))


def keyword_language(text: Column) -> Column:
    """E5: 'id' on an Indonesian marker, else NULL."""
    return F.when(_any(text, LANGUAGE_ID_WORDS), F.lit("id"))


def tags_json(topics, actors, locations, language, is_editorial, sentiment) -> Column:
    return compact_json(F.struct(topics.alias("topics"), actors.alias("actors"),
                                 locations.alias("locations"), language.alias("language"),
                                 is_editorial.alias("is_editorial"), sentiment.alias("sentiment")))


def keyword_enrich(items: DataFrame, taxonomy: Taxonomy, enriched_at: Column | None = None,
                   keep: tuple[str, ...] = ("id",)) -> DataFrame:
    """One enrichment row per item from the keyword path
    (model 'fallback_keyword', status 'ok', locations [])."""
    text = tag_text(F.col("title"), F.col("summary"))
    at = enriched_at if enriched_at is not None else F.current_timestamp()
    df = items.select(*[F.col(c) for c in keep], text.alias("_text"))
    if n_words(taxonomy) < AUTOMATON_FROM:
        topics, actors = keyword_topics(F.col("_text"), taxonomy), keyword_actors(F.col("_text"), taxonomy)
    else:
        df = df.withColumn("_tags", keyword_tags(F.col("_text"), taxonomy))
        topics, actors = F.col("_tags.topics"), F.col("_tags.actors")
    df = df.select(
        *[F.col(c) for c in keep],
        topics.alias("topics"),
        actors.alias("actors"),
        empty_array().alias("locations"),
        keyword_language(F.col("_text")).alias("language"),
        keyword_editorial(F.col("_text")).alias("is_editorial"),
        keyword_sentiment(F.col("_text")).alias("sentiment"),
    )
    return df.select(
        "*",
        tags_json(F.col("topics"), F.col("actors"), F.col("locations"), F.col("language"),
                  F.col("is_editorial"), F.col("sentiment")).alias("tags_json"),
        at.cast("timestamp").alias("enriched_at"),
        F.lit(KEYWORD_MODEL).alias("enrich_model"),
        F.lit("ok").alias("enrich_status"),
        F.lit(None).cast("string").alias("enrich_error"),
    )
