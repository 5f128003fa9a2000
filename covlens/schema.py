"""The item schema (one flat record per article or video)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ITEM_SCHEMA = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("platform", T.StringType(), False),
    T.StructField("source_type", T.StringType(), False),
    T.StructField("publisher_or_author", T.StringType(), False),
    T.StructField("url", T.StringType(), False),
    T.StructField("title", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("published_at", T.TimestampType()),
    T.StructField("ingested_at", T.TimestampType(), False),
    T.StructField("content_text", T.StringType()),
    T.StructField("content_fetched_at", T.TimestampType()),
    T.StructField("content_status", T.StringType()),
    T.StructField("content_hash", T.StringType()),
    T.StructField("topics", T.ArrayType(T.StringType())),
    T.StructField("actors", T.ArrayType(T.StringType())),
    T.StructField("locations", T.ArrayType(T.StringType())),
    T.StructField("language", T.StringType()),
    T.StructField("is_editorial", T.BooleanType()),
    T.StructField("sentiment", T.StringType()),
    T.StructField("tags_json", T.StringType()),
    T.StructField("signals_json", T.StringType()),
    T.StructField("raw_json", T.StringType()),
    T.StructField("enriched_at", T.TimestampType()),
    T.StructField("enrich_model", T.StringType()),
    T.StructField("enrich_status", T.StringType()),
    T.StructField("enrich_error", T.StringType()),
])
ITEM_COLUMNS = [f.name for f in ITEM_SCHEMA.fields]

# Fields an upsert never overwrites on an existing id (enrichment, content,
# signals and the content hash stay as first written).
PROTECTED = (
    "topics", "actors", "locations", "language", "is_editorial", "sentiment", "tags_json",
    "signals_json", "content_text", "content_fetched_at", "content_status", "content_hash",
    "enriched_at", "enrich_model", "enrich_status", "enrich_error",
)
UNPROTECTED = tuple(c for c in ITEM_COLUMNS if c not in PROTECTED)

ENRICHMENT_COLUMNS = ("topics", "actors", "locations", "language", "is_editorial", "sentiment",
                      "tags_json", "enriched_at", "enrich_model", "enrich_status", "enrich_error")
CONTENT_COLUMNS = ("content_text", "content_fetched_at", "content_status")

ENRICHMENT_TYPE = ("struct<topics:array<string>,actors:array<string>,locations:array<string>,"
                   "language:string,is_editorial:boolean,sentiment:string>")


def null_of(name: str) -> Column:
    return F.lit(None).cast(ITEM_SCHEMA[name].dataType).alias(name)


def conform(df, extra: tuple[str, ...] = ()):
    """Project to the item schema (missing columns NULL, types cast) plus
    any `extra` bookkeeping columns."""
    have = set(df.columns)
    cols = [(F.col(c).cast(ITEM_SCHEMA[c].dataType).alias(c) if c in have else null_of(c))
            for c in ITEM_COLUMNS]
    return df.select(*cols, *[F.col(c) for c in extra if c in have])
