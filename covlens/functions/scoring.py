"""Sentiment normalisation (F17, P7), share (F18), clamp."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import SENTIMENT_LABELS
from .text import strip_ws


def normalize_sentiment(c: Column) -> Column:
    """strip, lower."""
    return F.lower(strip_ws(F.coalesce(c, F.lit(""))))


def valid_sentiment(c: Column) -> Column:
    """The normalised label when it is one of the three, else NULL."""
    s = normalize_sentiment(c)
    return F.when(s.isin(*SENTIMENT_LABELS), s)


def share(n: Column, total: Column) -> Column:
    """n / total as DOUBLE (0 when total is 0)."""
    return F.when(total > 0, n.cast("double") / total.cast("double")).otherwise(F.lit(0.0))


def clamp(x: Column, lo, hi) -> Column:
    """max(lo, min(hi, x))."""
    return F.greatest(F.lit(lo), F.least(F.lit(hi), x))
