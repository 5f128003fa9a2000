"""What a task holds of a file follows its row groups, not the size of the table."""
import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from covlens.plans import queries_streaming as Q
from covlens.sources import landing as L


def text(kilobytes):
    words = F.transform(F.sequence(F.lit(1), F.lit(16 * kilobytes)), lambda i: F.sha2(F.concat_ws("-", "id", i), 256))
    return F.array_join(words, "")


def largest_group(path):
    found = [m.row_group(g) for f in glob.glob(f"{path}/**/*.parquet", recursive=True) for m in [pq.ParquetFile(f).metadata]
             for g in range(m.num_row_groups)]
    return max(sum(g.column(c).total_compressed_size for c in range(g.num_columns)) for g in found) >> 20


def test_kept_and_packed_documents_come_in_small_groups(spark, tmp_path):
    docs = spark.range(0, 420, 1, 1).select(F.col("id").cast("string").alias("path"), text(60).alias("text"))
    kept = Q._stored(docs, f"{tmp_path}/documents")
    assert kept.exceptAll(docs).isEmpty() and kept.count() == 420
    L.pack_documents(docs.select("path", F.encode("text", "UTF-8").alias("content")), f"{tmp_path}/landing")
    assert largest_group(f"{tmp_path}/documents") < 12 and largest_group(f"{tmp_path}/landing") < 12
