"""Publisher naming (F7, F10, F11) and video ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import PUBLISHER_DOMAINS


def publisher_from_domain(domain: Column, mapping=PUBLISHER_DOMAINS) -> Column:
    """map a host to a publisher name.  Exact or '.'-suffix match of the
    map (first in order wins), else the second-last label, a dot-less host
    as is, empty -> 'unknown'."""
    d = F.lower(domain)
    out = F.when(F.coalesce(domain, F.lit("")) == "", F.lit("unknown"))
    for host, name in mapping:
        out = out.when((d == host) | d.endswith("." + host), F.lit(name))
    return out.when(d.contains("."), F.element_at(F.split(d, "[.]"), -2)).otherwise(d)


def feed_publisher(feed_name: Column) -> Column:
    """part of the feed name before the first '_'."""
    return F.substring_index(feed_name, "_", 1)


def aggregator_publisher(source: Column, author: Column) -> Column:
    """first non-empty of source, author, 'unknown', stripped; a source
    that is only blanks does not fall through to author."""
    first = F.coalesce(F.when(source != "", source), F.when(author != "", author), F.lit("unknown"))
    t = F.trim(first)
    return F.when(t == "", F.lit("unknown")).otherwise(t)


def video_id(link: Column) -> Column:
    """text after the last 'watch?v=' up to '&'; NULL when absent."""
    vid = F.regexp_extract(F.coalesce(link, F.lit("")), r".*watch\?v=([^&]*)", 1)
    return F.when(F.coalesce(link, F.lit("")).contains("watch?v="), vid)
