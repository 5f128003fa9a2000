"""Arrow helpers of the operators that read whole texts in Python: bounded slices, columns in and out."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import SparkSession

SLICE_BYTES = 1 << 20
BATCH_BYTES = 2 << 20
_BOUND = "spark.sql.execution.arrow.maxBytesPerBatch"
#: glibc's; where the C library has none, nothing is given back early.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return what this worker has freed to the system.  Workers are kept between tasks and stages, and what they hold
    idle counts against the executor's memory."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def bounded(spark: SparkSession) -> None:
    """Hold the Arrow batches that a task sends to its Python worker at `BATCH_BYTES`, where the session allows more:
    batches of long texts are otherwise bounded by their number of rows and 64 MB, twice over in JVM and worker."""
    now = str(spark.conf.get(_BOUND)).rstrip("bB")
    if not (now.isdigit() and 0 < int(now) <= BATCH_BYTES):
        spark.conf.set(_BOUND, str(BATCH_BYTES))


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive row slices of `batch` whose texts come to about `most` bytes; a longer text is a slice of its
    own, so memory is bounded by the longest single text."""
    texts = batch.column(column)
    start, held = 0, 0
    for i in range(batch.num_rows):
        n = len(texts[i].as_buffer() or b"") if texts[i].is_valid else 0
        if i > start and held + n > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows or not batch.num_rows:
        yield batch.slice(start)
    give_back()
