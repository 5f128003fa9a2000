"""E8's call log: equal prompts are one call, answered prompts are never sent again, calls run side by side."""
import json
import time

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from covlens.operators import enrich as EN

SMALL = "/root/testdata/sf0.001"
GOOD = json.dumps({"topics": ["t"], "actors": [], "locations": [], "language": None, "is_editorial": False, "sentiment": "neutral"})


def model_of(folder, fail_at=None):
    """A model that notes each call as a file; from call `fail_at` on the process is gone."""
    def respond(df):
        def run(batches):
            import os
            import uuid

            import pandas as pd
            for b in batches:
                for p, a in zip(b["prompt"], b["attempt"]):
                    if fail_at is not None and len(os.listdir(folder)) >= fail_at:
                        raise RuntimeError("executor lost")
                    with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
                        f.write(f"{a}|{p}")
                yield pd.DataFrame({"id": b["id"], "text": [None if p == "mute" else "no json" if p == "bad" or (p == "late" and a == 0)
                                                            else GOOD for p, a in zip(b["prompt"], b["attempt"])]})
        return df.mapInPandas(run, "id string, text string")
    return respond


def made(folder):
    return sorted(p.read_text() for p in folder.iterdir())


def test_answered_prompts_are_not_sent_again(spark, tmp_path):
    notes, calls = tmp_path / "notes", str(tmp_path / "calls")
    notes.mkdir()
    rows = [("a", "same"), ("b", "same"), ("c", "late"), ("d", "bad"), ("e", "mute"), ("f", None)]
    pending = spark.createDataFrame(rows, "id string, prompt string").repartition(3)
    first = EN.enrich_with_retry(pending, model_of(str(notes)), "m", 1, F.lit("2024-01-01"), calls=calls, waves=3)
    want = {r.id: (r.enrich_status, r.attempts) for r in first.collect()}
    assert want == {"a": ("ok", 1), "b": ("ok", 1), "c": ("ok", 2), "d": ("error", 2), "e": ("error", 2), "f": ("error", 2)}
    asked = [x for x in made(notes) if x.split("|")[1] in ("same", "late", "bad")]
    assert asked == ["0|bad", "0|late", "0|same", "1|bad", "1|late"]
    before = set(notes.iterdir())
    again = EN.enrich_with_retry(pending, model_of(str(notes)), "m", 1, F.lit("2024-01-01"), calls=calls)
    assert {r.id: (r.enrich_status, r.attempts) for r in again.collect()} == want
    new = {p.read_text().split("|")[1] for p in set(notes.iterdir()) - before}
    assert new <= {"mute", "None"}  # calls that never had an answer
    other = EN.enrich_with_retry(pending.filter("id = 'a'"), model_of(str(notes)), "another model", 0, F.lit("2024-01-01"), calls=calls)
    assert other.count() == 1 and made(notes).count("0|same") == 2


def test_a_failed_run_goes_on_where_it_stopped(spark, tmp_path):
    notes, calls = tmp_path / "notes", str(tmp_path / "calls")
    notes.mkdir()
    pending = spark.range(40).select(F.col("id").cast("string"), F.concat(F.lit("p"), "id").alias("prompt")).coalesce(1)
    with pytest.raises(Exception, match="executor lost"):
        EN.enrich_with_retry(pending, model_of(str(notes), fail_at=25), "m", 0, F.lit("2024-01-01"), calls=calls, waves=8)
    logged = spark.read.parquet(calls).count()
    assert 0 < logged < 25
    done = {r.key for r in spark.read.parquet(calls).collect()}
    before = set(notes.iterdir())
    log = EN.enrich_with_retry(pending, model_of(str(notes)), "m", 0, F.lit("2024-01-01"), calls=calls, waves=8)
    assert log.filter("enrich_status = 'ok'").count() == 40
    import hashlib
    sent = {hashlib.sha256(p.read_text().split("|")[1].encode()).hexdigest() for p in set(notes.iterdir()) - before}
    assert len(sent) == 40 - logged and not sent & done  # no logged call was repeated


def test_calls_of_a_task_run_side_by_side(spark):
    def slow(prompt, attempt):
        time.sleep(0.2)
        return prompt
    df = spark.range(20).select(F.col("id").cast("string"), F.col("id").cast("string").alias("prompt"), F.lit(0).alias("attempt")).coalesce(1)
    began = time.perf_counter()
    got = {r.id: r.text for r in EN.pandas_model(slow, concurrency=20)(df).collect()}
    assert got == {str(i): str(i) for i in range(20)} and time.perf_counter() - began < 3.5


def test_resumed_rows_equal_the_oracle(spark):
    con = duckdb.connect()
    for t in ("documents", "labels", "events", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    df = E.queries()["enrich_resume"](spark, SMALL)
    rel = con.execute(E.oracle_sql()["enrich_resume"])
    names = [d[0] for d in rel.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(repr, rel.fetchall())) == sorted(repr(tuple(r[c] for c in names)) for r in df.collect())


def test_both_cycles_read_items_folded_once(spark, monkeypatch):
    from covlens.plans import queries_enrich as Q
    plans, real = [], Q._model_log
    monkeypatch.setattr(Q, "_model_log", lambda m, *a, **k: plans.append(m._jdf.queryExecution().executedPlan().toString()) or real(m, *a, **k))
    E.queries()["enrich_resume"](spark, SMALL)
    assert len(plans) == 2 and not any("Aggregate" in p or "parquet" in p for p in plans)
