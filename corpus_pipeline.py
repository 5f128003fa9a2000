"""A corpus-cleaning pipeline over `documents`: each stage is one operator of `covlens.llm`.

A stage takes (spark, docs, sf_dir) and returns the documents it keeps, with the columns of `docs`; the last returns
one row per document with its token ids.  `run` writes every stage's result as Parquet in the shared checkpoint folder
and reads it back as the next stage's documents, so a lost executor costs one stage.

1. toxicity: documents that the classifier rejects go (learned from the labels outside the held-out fold).
2. line dedup: lines of recurring templates go, the documents stay (`n_chars` follows the text).
3. near duplicates: the document with the smallest id of each group stays.
4. decontamination: documents that overlap with a benchmark item go.
5. encoding: token count, ids and digests of every text that is left.

Defined results: null texts and empty texts pass all filters; rows with a null doc_id are never dropped as duplicates;
repeated rows are judged alike, and of a near-duplicate group all rows of its smallest doc_id stay; very long texts are
read whole; an empty table gives an empty table.  All columns of documents pass, whatever their names: the stages see
doc_id and text alone, the rest travels beside them.  Documents without `n_chars` are left without it.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covlens.llm import bpe, decontam, line_templates, minhash, toxicity
from covlens.session import ensure_checkpoint_dir

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id, text and all other columns as one, so that no operator's own columns meet them."""
    return docs.select("doc_id", "text", F.struct(F.lit(0).alias("_"), *[docs[c] for c in docs.columns if c not in ("doc_id", "text")])
                       .alias("rest"))


def _unpacked(rows: DataFrame, columns: list[str], **changed) -> DataFrame:
    own = {"doc_id": F.col("doc_id"), "text": F.col("text"), **changed}
    return rows.select(*[own.get(c, F.col("rest")[c]).alias(c) for c in columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels, ~toxicity.held_out(labels["doc_id"]))
    return _unpacked(toxicity.score(_packed(docs), model).where("predicted = 0"), docs.columns)


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = line_templates.drop_recurring(_packed(docs))
    if "n_chars" not in docs.columns:
        return _unpacked(kept, docs.columns)
    before = F.col("rest")["n_chars"]
    length = F.when(F.size("dropped") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(before)
    return _unpacked(kept, docs.columns, n_chars=length)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, VOCABULARY, with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_recurring_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("encoding", encode),
]

#: No SQL: a trained classifier and a merge loop are among the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to `documents` and return the last one's rows."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
