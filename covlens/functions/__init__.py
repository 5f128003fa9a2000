"""Scalar Column expressions (no UDF except the HTML-unescape fallback)."""

from .text import (clean_text, html_unescape, url_domain, truncate_content, strip_think,
                   distinct_preserve, strip_ws, WS_CLASS, clean_again)
from .time import parse_timestamp, parse_compact_ts, coverage_day
from .ids import sha256_hex, item_id, content_hash
from .jsonf import compact_json, parse_json_list, response_text, response_citations
from .publisher import publisher_from_domain, feed_publisher, aggregator_publisher, video_id
from .scoring import normalize_sentiment, valid_sentiment, share, clamp

__all__ = [
    "clean_text", "html_unescape", "url_domain", "truncate_content", "strip_think",
    "distinct_preserve", "strip_ws", "WS_CLASS", "clean_again",
    "parse_timestamp", "parse_compact_ts", "coverage_day",
    "sha256_hex", "item_id", "content_hash",
    "compact_json", "parse_json_list", "response_text", "response_citations",
    "publisher_from_domain", "feed_publisher", "aggregator_publisher", "video_id",
    "normalize_sentiment", "valid_sentiment", "share", "clamp",
]
