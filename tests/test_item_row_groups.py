"""The log's row groups stay at some thousands of items."""
from pyspark.sql import functions as F

from covlens.operators import store as ST
from test_bounded_row_groups import largest_group, text


def test_log_comes_in_groups_of_some_thousand_items(spark, tmp_path):
    items = spark.range(0, 25_000, 1, 1).select("id", text(2).alias("raw_json"), F.lit(0).alias("batch_id"))
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        ST.write_log(items, f"{tmp_path}/log")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert spark.read.parquet(f"{tmp_path}/log").count() == 25_000
    assert largest_group(f"{tmp_path}/log") < 32
