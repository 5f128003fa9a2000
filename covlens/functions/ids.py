"""Hashes: sha256 hex (F5), item id (F8), content hash."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sha256_hex(c: Column) -> Column:
    """hex sha256 of the UTF-8 bytes."""
    return F.sha2(c, 256)


def item_id(platform: Column, url: Column) -> Column:
    """F8: sha256(platform + '|' + url); URL-less rows of one platform share
    one id, as in the reference."""
    return F.sha2(F.concat(platform, F.lit("|"), F.coalesce(url, F.lit(""))), 256)


def content_hash(title: Column, summary: Column) -> Column:
    """sha256(title[:200] + '||' + summary[:200]) in code points."""
    return F.sha2(F.concat(F.substring(F.coalesce(title, F.lit("")), 1, 200), F.lit("||"),
                           F.substring(F.coalesce(summary, F.lit("")), 1, 200)), 256)
