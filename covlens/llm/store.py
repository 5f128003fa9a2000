"""Intermediate tables: written once to the shared checkpoint folder and read back, so lineage ends there and a lost
executor never repeats what is written."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from covlens.session import ensure_checkpoint_dir


def written(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
