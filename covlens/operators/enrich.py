"""Model-based enrichment: strict response validation (E7), the retrying
enrichment pass (E8), its counters (E9), the per-item prompt (F27).

Validation is native: the response text is parsed once to VARIANT and
every field is checked by its variant type, so missing, JSON null and
wrong-typed fields are told apart without Python.  The model call itself
is the only Python: `pandas_model` wraps a per-prompt callable into an
Arrow-batched mapInPandas, retried attempt by attempt, where each attempt
only sees the items that are still failing and is checkpointed so a model
call is never replayed by lineage recomputation."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import MAX_CONTENT_CHARS, Taxonomy
from ..functions.jsonf import compact_json
from ..functions.text import clean_text
from ..session import ensure_checkpoint_dir

LIST_FIELDS = ("topics", "actors", "locations")
TEXT_FIELDS = ("language", "sentiment")
# Accepted spellings of a boolean (case-insensitive), as the reference's
# model class accepts them.
TRUE_WORDS = ("1", "on", "t", "true", "y", "yes")
FALSE_WORDS = ("0", "off", "f", "false", "n", "no")


def validate_enrichment(text: Column, strict: bool = False) -> Column:
    """Response text -> struct(topics, actors, locations, language,
    is_editorial, sentiment, status, error).

    Errors (status 'error', fields empty/NULL): no text, not JSON, not an
    object, a list field that is null / not a list / holds a non-string or
    null element, a text field that is not a string, a flag that is not a
    boolean spelling or 0/1.  Missing fields take defaults ([] or NULL)
    unless `strict`, which requires all six fields."""
    v = F.try_parse_json(text)
    is_obj = F.schema_of_variant(v).startswith("OBJECT")
    errs = [F.when(F.coalesce(text, F.lit("")) == "", F.lit("no_text")),
            F.when(v.isNull(), F.lit("not_json")),
            F.when(~is_obj, F.lit("not_object"))]
    out = {}
    for f in LIST_FIELDS:
        sub = F.variant_get(v, f"$.{f}", "variant")
        st = F.schema_of_variant(sub)
        arr = F.try_variant_get(sub, "$", "array<string>")
        ok_type = st.isin("ARRAY<STRING>", "ARRAY<VOID>")
        errs.append(F.when(sub.isNotNull() & ~(ok_type & ~F.exists(arr, lambda x: x.isNull())),
                           F.lit(f"bad_{f}")))
        if strict:
            errs.append(F.when(is_obj & sub.isNull(), F.lit(f"missing_{f}")))
        out[f] = F.coalesce(arr, F.array().cast("array<string>"))
    for f in TEXT_FIELDS:
        sub = F.variant_get(v, f"$.{f}", "variant")
        st = F.schema_of_variant(sub)
        errs.append(F.when(sub.isNotNull() & ~st.isin("STRING", "VOID"), F.lit(f"bad_{f}")))
        if strict:
            errs.append(F.when(is_obj & sub.isNull(), F.lit(f"missing_{f}")))
        out[f] = F.try_variant_get(sub, "$", "string")
    sub = F.variant_get(v, "$.is_editorial", "variant")
    st = F.schema_of_variant(sub)
    s = F.lower(F.try_variant_get(sub, "$", "string"))
    num = F.try_variant_get(sub, "$", "double")
    flag = (F.when(st == "BOOLEAN", F.try_variant_get(sub, "$", "boolean"))
            .when((st == "STRING") & s.isin(*TRUE_WORDS), F.lit(True))
            .when((st == "STRING") & s.isin(*FALSE_WORDS), F.lit(False))
            .when(~st.isin("STRING", "BOOLEAN", "VOID") & (num == 1.0), F.lit(True))
            .when(~st.isin("STRING", "BOOLEAN", "VOID") & (num == 0.0), F.lit(False)))
    errs.append(F.when(sub.isNotNull() & (st != "VOID") & flag.isNull(), F.lit("bad_is_editorial")))
    if strict:
        errs.append(F.when(is_obj & sub.isNull(), F.lit("missing_is_editorial")))
    error = F.coalesce(*errs)
    ok = error.isNull()
    empty = F.array().cast("array<string>")
    return F.struct(
        *[F.when(ok, out[f]).otherwise(empty).alias(f) for f in LIST_FIELDS],
        F.when(ok, out["language"]).alias("language"),
        F.when(ok, flag).cast("boolean").alias("is_editorial"),
        F.when(ok, out["sentiment"]).alias("sentiment"),
        F.when(ok, F.lit("ok")).otherwise(F.lit("error")).alias("status"),
        error.alias("error"))


def pandas_model(fn: Callable[[str, int], str], out_col: str = "text", concurrency: int = 1) -> Callable[[DataFrame], DataFrame]:
    """Wrap a per-prompt model call fn(prompt, attempt) -> text into a
    `respond` function for enrich_with_retry.  Batches cross the Arrow
    boundary; an exception from fn becomes a NULL text (an error).  A task
    keeps up to `concurrency` calls of a batch under way, so a run has at most
    task slots x concurrency of them."""
    def _call(batches):
        def one(call):
            try:
                return fn(call[0], int(call[1]))
            except Exception:  # a failed call is an unusable response
                return None
        with ThreadPoolExecutor(concurrency) as pool:
            for b in batches:
                yield pd.DataFrame({"id": b["id"], out_col: list(pool.map(one, zip(b["prompt"], b["attempt"])))})

    def respond(df: DataFrame) -> DataFrame:
        return df.select("id", "prompt", "attempt").mapInPandas(_call, f"id string, {out_col} string")
    return respond


CALLS = "key string, model string, attempt int, text string"


def answers(todo: DataFrame, respond: Callable[[DataFrame], DataFrame], model: str, attempt: int, calls: str,
            waves: int = 1) -> DataFrame:
    """(id, text) of one attempt through a durable call log: equal prompts are
    one call, and a prompt whose answer stands in the log (by the hash of the
    prompt, model and attempt) is not sent again, whatever run or failure lies
    between.  The calls go out in `waves`, each a share of the keys by their
    hash, and a wave's answers are logged when it ends, so a lost executor or
    a stopped run repeats at most the calls of the wave under way.  A call
    without an answer (NULL text, or no row) is not logged; a NULL prompt is no
    call."""
    spark = todo.sparkSession
    log = spark.read.schema(CALLS)
    need = todo.filter("prompt IS NOT NULL").select("id", "prompt", F.sha2("prompt", 256).alias("key")).checkpoint(eager=True)
    spark.createDataFrame([], CALLS).write.mode("append").parquet(calls)  # the folder of a first run

    def known() -> DataFrame:
        rows = log.parquet(calls).filter((F.col("model") == model) & (F.col("attempt") == attempt))
        return rows.groupBy("key").agg(F.max("text").alias("text"))

    open_calls = (need.groupBy("key").agg(F.min_by(F.struct("id", "prompt"), "id").alias("_c"))
                  .join(known(), "key", "left_anti")
                  .select("key", "_c.id", "_c.prompt", F.lit(attempt).alias("attempt")).checkpoint(eager=True))
    for wave in range(waves):
        part = open_calls.filter(F.pmod(F.crc32("key"), F.lit(waves)) == wave)
        if part.isEmpty():
            continue
        got = respond(part.select("id", "prompt", "attempt")).filter("text IS NOT NULL")
        (part.select("key", "id").join(got, "id")
         .select("key", F.lit(model).alias("model"), F.lit(attempt).cast("int").alias("attempt"), "text")
         .write.mode("append").parquet(calls))
    return need.select("id", "key").join(known(), "key").select("id", "text")


def enrich_with_retry(pending: DataFrame, respond: Callable[[DataFrame], DataFrame], model: str,
                      max_retries: int = 2, enriched_at: Column | None = None,
                      checkpoint: bool = True, calls: str | None = None, waves: int = 1) -> DataFrame:
    """(id, prompt) -> enrichment log rows.  Attempt k calls the model
    only for items whose attempts so far failed validation; after the last
    attempt the rest get status 'error', empty lists, NULLs, '{}' tags and
    an enriched_at, so they are not retried by later cycles.  Each attempt
    is checkpointed into the shared checkpoint folder.  With `calls` (a
    folder) every attempt goes through the durable call log (`answers`)."""
    at = (enriched_at if enriched_at is not None else F.current_timestamp()).cast("timestamp")
    todo = pending.select("id", "prompt")
    checkpoint = checkpoint or calls is not None
    if checkpoint:  # prompts are built once, not once per attempt
        ensure_checkpoint_dir(todo.sparkSession)
        todo = todo.checkpoint(eager=True)
    done = None
    last = None
    for attempt in range(max_retries + 1):
        # One answer per id; an item the model says nothing about is an unusable answer, not a lost item.
        asked = (answers(todo, respond, model, attempt, calls, waves) if calls
                 else respond(todo.withColumn("attempt", F.lit(attempt))))
        resp = asked.groupBy("id").agg(F.max("text").alias("text"))
        r = todo.join(resp, "id", "left").select("id", "prompt", validate_enrichment(F.col("text")).alias("e"))
        if checkpoint:
            ensure_checkpoint_dir(r.sparkSession)
            r = r.checkpoint(eager=True)
        good = r.filter(F.col("e.status") == "ok").select("id", "e", F.lit(attempt).alias("attempts"))
        done = good if done is None else done.unionByName(good)
        last = r.filter(F.col("e.status") != "ok")
        todo = last.select("id", "prompt")
    failed = last.select("id", "e", F.lit(max_retries).alias("attempts"))
    allr = done.unionByName(failed)
    e = F.col("e")
    tags = F.when(e["status"] == "ok", compact_json(F.struct(
        e["topics"].alias("topics"), e["actors"].alias("actors"), e["locations"].alias("locations"),
        e["language"].alias("language"), e["is_editorial"].alias("is_editorial"),
        e["sentiment"].alias("sentiment")))).otherwise(F.lit("{}"))
    return allr.select("id", e["topics"].alias("topics"), e["actors"].alias("actors"),
                       e["locations"].alias("locations"), e["language"].alias("language"),
                       e["is_editorial"].alias("is_editorial"), e["sentiment"].alias("sentiment"),
                       tags.alias("tags_json"), at.alias("enriched_at"), F.lit(model).alias("enrich_model"),
                       e["status"].alias("enrich_status"), e["error"].alias("enrich_error"),
                       (F.col("attempts") + 1).alias("attempts"))


def enrich_counts(pending: DataFrame, log: DataFrame, keyword_path: bool = False) -> DataFrame:
    """Pending / enriched_ok / enriched_error / skipped of one cycle.
    The keyword path counts every item as skipped."""
    p = pending.agg(F.count(F.lit(1)).alias("pending"))
    if keyword_path:
        return p.select("pending", F.lit(0).cast("long").alias("enriched_ok"),
                        F.lit(0).cast("long").alias("enriched_error"), F.col("pending").alias("skipped"))
    # one aggregation over both inputs tagged by side
    u = (pending.select(F.lit(True).alias("_pend"), F.lit(None).cast("string").alias("_st"))
         .unionByName(log.select(F.lit(False).alias("_pend"), F.col("enrich_status").alias("_st"))))
    return u.agg(F.count_if(F.col("_pend")).alias("pending"),
                 F.count_if(F.col("_st") == "ok").alias("enriched_ok"),
                 F.count_if(F.col("_st") == "error").alias("enriched_error"),
                 F.lit(0).cast("long").alias("skipped"))


def enrich_prompt(items: DataFrame, taxonomy: Taxonomy, content: Column | None = None) -> Column:
    """the per-item tagging prompt.  The taxonomy block and the rules
    are one constant built on the driver from the (small) taxonomy; only
    the item fields are per row."""
    from .prompt_text import prompt_head_parts, prompt_tail_parts
    head = [clean_text(F.lit(t)) if raw else F.lit(t) for t, raw in prompt_head_parts(taxonomy)]
    body = content if content is not None else F.col("content_text")
    parts = prompt_tail_parts()
    return F.concat(
        *head,
        F.lit(parts[0]), F.coalesce(F.col("platform"), F.lit("None")),
        F.lit(parts[1]), F.coalesce(F.col("source_type"), F.lit("None")),
        F.lit(parts[2]), F.coalesce(F.col("publisher_or_author"), F.lit("None")),
        F.lit(parts[3]), F.coalesce(F.col("url"), F.lit("None")),
        F.lit(parts[4]), clean_text(F.col("title")),
        F.lit(parts[5]), clean_text(F.col("summary")),
        F.lit(parts[6]), F.substring(clean_text(body), 1, MAX_CONTENT_CHARS),
        F.lit(parts[7]))
