"""JSON helpers: compact dumps (F6), list parse (F6b), model response
fields (F21)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_KEEP_NULLS = {"ignoreNullFields": "false"}


def compact_json(c: Column) -> Column:
    """JSON text without spaces, non-ASCII kept, null fields kept."""
    return F.to_json(c, _KEEP_NULLS)


def parse_json_list(c: Column) -> Column:
    """JSON text -> array<string>; NULL, malformed, scalar or object
    -> empty array."""
    parsed = F.try_parse_json(c)
    arr = F.when(F.schema_of_variant(parsed).startswith("ARRAY"),
                 F.try_variant_get(parsed, "$", "array<string>"))
    return F.coalesce(arr, F.array().cast("array<string>"))


def response_text(resp: Column) -> Column:
    """choices[0].message.content of a chat response, else ''."""
    return F.coalesce(F.get_json_object(resp, "$.choices[0].message.content"), F.lit(""))


def response_citations(resp: Column) -> Column:
    """top-level `citations` when it is a list (elements as text),
    else []."""
    raw = F.get_json_object(resp, "$.citations")
    lst = F.from_json(raw, "array<string>")
    return F.coalesce(F.when(raw.startswith("["), lst), F.array().cast("array<string>"))
