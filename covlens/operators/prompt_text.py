"""Prompt wording for the tagging model (F27) and the topic briefing
(F28).  The structure follows the reference (taxonomy with descriptions
and indicative keywords, allowed topic list, response schema, item
metadata, cleaned title/summary, content cut to 4000 characters; for the
briefing: language, topic, window, title, seed URL bullets); the wording is
ours.  Everything except the per-item fields is built once on the driver
from the small taxonomy and enters the plan as a literal."""

from __future__ import annotations

from ..config import Taxonomy


def prompt_head_parts(taxonomy: Taxonomy) -> list[tuple[str, bool]]:
    """The prompt up to the item, as (text, still to be cleaned) pieces: the
    topics' descriptions go through the engine's text cleaner."""
    allowed = ", ".join(taxonomy.topic_names)
    start = (
        "Classify the news or social item below for a media-monitoring desk and answer with JSON only.\n\n"
        "Topics:\n"
        "- A topic is defined by its description; its keywords are hints, never sufficient alone.\n"
        "- Use a topic only when the item clearly matches its description; several may apply.\n"
        f"- Choose topics only from: [{allowed}]; return [] when none applies.\n\n"
        "Actors: public figures, institutions, parties, companies and organisations named in the item, "
        "full names where known.\n\n"
        "Answer with exactly these keys:\n"
        '{"topics": [string], "actors": [string], "locations": [string], "language": string | null, '
        '"is_editorial": boolean | null, "sentiment": "positive" | "negative" | "neutral"}\n\n'
        "Taxonomy:\n")
    pieces = [(start, False)]
    for i, t in enumerate(taxonomy.topics):
        pieces += [("\n" * bool(i) + f"- {t.name}\n  Description: ", False), (t.description, True)]
        if t.keywords:
            pieces.append((f"\n  Indicative keywords: {', '.join(t.keywords)}", False))
    return pieces + [(f"\n\nKnown actors (not exhaustive): {', '.join(taxonomy.actors)}\n\n", False)]


def prompt_tail_parts() -> list[str]:
    """Literal pieces between the per-item fields: platform, source type,
    publisher, url, title, summary, content."""
    return ["Item:\nPlatform: ", "\nSource type: ", "\nPublisher/Author: ", "\nURL: ",
            "\n\nTitle: ", "\n\nSummary:\n", "\n\nContent:\n", "\n"]


def briefing_parts(language: str, time_window: str) -> tuple[str, str, str, str]:
    """Literal pieces of the briefing prompt around topic, title and URLs."""
    head = (f"Write a media-monitoring brief in {language} as Markdown for the topic below. "
            "Start from the seed URLs and add other credible sources when useful; support every claim "
            "with a citation, do not invent figures, names, dates or quotes, and say when sources "
            "disagree. No JSON, no <think> blocks.\n\nTopic: ")
    mid = f"\nTime window: {time_window}\nTitle: "
    urls = ("\n\nSections: situation summary; data and facts; key actors and positions; timeline; "
            "controversies and reputation risks; narrative opportunities; short/medium/long-term "
            "recommendations; sources.\n\nSeed URLs:\n")
    return head, mid, urls, "\n"
