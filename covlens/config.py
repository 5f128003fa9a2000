"""Taxonomy and report parameters.

Word lists are parameters.  The defaults below are the fixed values the
keyword tagger must use to give the same tags as the system being
re-implemented; the test taxonomy is the one the test data binding uses.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Topic:
    name: str
    description: str = ""
    keywords: tuple[str, ...] = ()
    locations: tuple[str, ...] = ()


@dataclass(frozen=True)
class Taxonomy:
    topics: tuple[Topic, ...] = ()
    actors: tuple[str, ...] = ()

    @property
    def topic_names(self) -> list[str]:
        return [t.name for t in self.topics]

    @staticmethod
    def from_config(cfg: dict) -> "Taxonomy":
        """Build from a config dict shaped {topics: {name: {description,
        keywords, locations}}, actors: [...]}; config order is kept.  Keys
        beside `topics` are ignored, as the reference does."""
        tx = cfg.get("taxonomy", cfg) or {}
        topics = []
        for name, spec in (tx.get("topics") or {}).items():
            spec = spec or {}
            topics.append(Topic(name, spec.get("description", "") or "",
                                tuple(spec.get("keywords") or ()),
                                tuple(spec.get("locations") or ())))
        return Taxonomy(tuple(topics), tuple(tx.get("actors") or ()))

    @staticmethod
    def from_frame(words, max_words: int = 1 << 20) -> "Taxonomy":
        """Build from a taxonomy table (place, topic, kind, word) with kind
        'keyword', 'location' or 'actor' (actors have no topic): topics by
        their first place, words by place.  Rows with a NULL word are left
        out, repeated ones taken once.  The table is configuration that every
        task holds, so its size is checked before it is read; a larger one is
        an error, never cut."""
        rows = words.filter("word IS NOT NULL").groupBy("topic", "kind", "word").agg({"place": "min"})
        rows = rows.withColumnRenamed("min(place)", "place")
        n = rows.count()
        if n > max_words:
            raise ValueError(f"a taxonomy of {n} words, at most {max_words} are held in a task")
        topics, actors = {}, []
        for r in sorted(rows.collect(), key=lambda r: (r.place, r.word)):
            if r.kind == "actor":
                actors.append(r.word)
            else:
                topics.setdefault(r.topic, {"keyword": [], "location": []})[r.kind].append(r.word)
        return Taxonomy(tuple(Topic(t, "", tuple(w["keyword"]), tuple(w["location"])) for t, w in topics.items()),
                        tuple(actors))


# ---------------------------------------------------------------------------
# Fixed values (must equal the reference for identical tags).
# ---------------------------------------------------------------------------
# Editorial markers, sentiment words and language markers of the keyword
# fallback tagger, in their original order.
EDITORIAL_WORDS = ("opini", "menurut saya", "seharusnya", "kritik")
POSITIVE_WORDS = ("positif", "baik", "bagus", "apresiasi")
NEGATIVE_WORDS = ("negatif", "buruk", "jelek", "korupsi", "skandal")
LANGUAGE_ID_WORDS = ("yang", "dan", "tidak", "dengan")
KEYWORD_MODEL = "fallback_keyword"
SENTIMENT_LABELS = ("positive", "neutral", "negative")

# Domain -> publisher map (exact host or dot-suffix), in original order.
PUBLISHER_DOMAINS = (
    ("kompas.com", "kompas"),
    ("nasional.kompas.com", "kompas"),
    ("tempo.co", "tempo"),
    ("nasional.tempo.co", "tempo"),
    ("antaranews.com", "antara"),
    ("mediaindonesia.com", "mediaindonesia"),
    ("detik.com", "detik"),
    ("cnnindonesia.com", "cnnindonesia"),
    ("cnbcindonesia.com", "cnbcindonesia"),
)

# Aggregator languages accepted by the request filter.
AGGREGATOR_LANGUAGES = ("ar", "de", "en", "es", "fr", "he", "it", "nl", "no", "pt", "ru", "se", "zh")

# Content sent to a tagging model is cut to this many characters.
MAX_CONTENT_CHARS = 4000

# Report limits (top-k sizes) and health/risk thresholds.
TOP_PUBLISHERS = 15
TOP_DOMAINS = 15
TOP_TOPICS = 30
TOP_ACTORS = 25
TOP_SENTIMENT_KEYS = 15
LAST_DAYS = 31
APPENDIX_PUBLISHERS = 20
APPENDIX_TOPICS = 30
CITATION_LIMIT = 20
DEFAULT_SEED_URLS = 12

# Health score and risk thresholds: growth of mentions that counts as improving, declining, a surge and a slump;
# what a critical topic, a surge and a slump cost; and the risk points of each level.
IMPROVING, DECLINING, SURGE, SLUMP = 0.10, -0.10, 0.50, -0.30
HEALTH_BASE, CRITICAL_COST, SURGE_COST, SLUMP_COST = 80, 10, 5, 3
HIGH_RISK_POINTS, MEDIUM_RISK_POINTS = 3, 2

# No topics are built in: users pass theirs through Taxonomy.from_config.
DEFAULT_TAXONOMY = Taxonomy()

# Taxonomy used with the driver's test tables (their prose is en/fr/de/es).
TEST_TAXONOMY = Taxonomy(
    topics=(
        Topic("english", keywords=("the ",)),
        Topic("french", keywords=("que",)),
        Topic("german", keywords=("sch",)),
        Topic("spanish", keywords=("ción",)),
        Topic("license", keywords=("license", "free")),
        Topic("located", keywords=("the ",), locations=("tion",)),
        Topic("always"),
    ),
    actors=("License", "Free"),
)

# A second one, of function words, for the queries that enrich with another taxonomy than the binding's.
WORDS_TAXONOMY = Taxonomy(
    topics=(
        Topic("articles", "Texts with a definite article, &amp; <b>little</b> else.", ("the ", "der ", "les ", "los ")),
        Topic("conjunctions", "Texts that join clauses.", (" and ", " und ", " et ", " y ")),
        Topic("questions", "Texts that ask.", ("?", "¿")),
    ),
    actors=("Apache", "MIT"),
)


@dataclass(frozen=True)
class ReportParams:
    """Reporting clock and knobs.  `now` is a parameter (UTC), never read
    from the wall clock inside a query, so runs are reproducible."""
    now: str = "2024-01-31 00:00:00"
    days: int = 7
    critical_topics: tuple[str, ...] = ()
    max_urls: int = DEFAULT_SEED_URLS


TEST_REPORT = ReportParams(now="2024-01-31 00:00:00", days=7,
                           critical_topics=("license", "spanish"))
