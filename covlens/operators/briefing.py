"""Topic briefings: prompt per topic from its seed URLs (F28), parsing of
the model response (F21), think-block removal (F20) and the citation limit
(T6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CITATION_LIMIT
from ..functions.jsonf import response_citations, response_text
from ..functions.text import strip_think
from .prompt_text import briefing_parts


def briefing_prompts(seed: DataFrame, language: str = "id", time_window: str = "7 days") -> DataFrame:
    """(topic, rank, url) seed rows -> one prompt per topic.  The
    URL list of a topic is at most the seed limit long, so collecting it
    per topic is bounded."""
    head, mid, urls_head, end = briefing_parts(language, time_window)
    g = seed.groupBy("topic").agg(F.array_sort(F.collect_list(F.struct("rank", "url"))).alias("_u"))
    title = F.concat(F.lit("Update "), F.initcap(F.regexp_replace("topic", "_", " ")))
    bullets = F.array_join(F.transform("_u", lambda s: F.concat(F.lit("- "), s["url"])), "\n")
    return g.select("topic", F.concat(F.lit(head), F.col("topic"), F.lit(mid), title, F.lit(urls_head),
                                      bullets, F.lit(end)).alias("prompt"),
                    F.size("_u").alias("n_urls"))


def briefing_sections(responses: DataFrame, resp_col: str = "response",
                      limit: int = CITATION_LIMIT) -> DataFrame:
    """F21 + F20 + T6: response JSON -> (text without think blocks,
    first `limit` citations)."""
    r = F.col(resp_col)
    return responses.select("*", strip_think(response_text(r)).alias("text"),
                            F.slice(response_citations(r), 1, limit).alias("citations"))
