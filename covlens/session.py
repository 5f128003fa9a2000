"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Settings every covlens job relies on.  The session time zone is pinned to
# UTC because stored timestamps are UTC instants (the reference stores
# `...+00:00` ISO text); ANSI mode stays on, so dirty input goes through
# try_* functions.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "covlens", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session.  `master` is only set when given, so a
    cluster launcher's own master wins."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(CORE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k in ("spark.sql.session.timeZone",):
        spark.conf.set(k, CORE_CONF[k])
    return spark


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Shuffle and scan sizing for a job over `input_bytes` on a cluster
    with `total_cores` task slots: about `target_partition_bytes` per
    shuffle partition (rounded up to whole waves of the cores) so a task's
    share fits executor memory, scan splits of the same size, and AQE left
    to coalesce small partitions and split skewed ones at run time.  E.g.
    100 TB on 8,000 cores -> ~400k partitions of ~256 MB."""
    parts = max(total_cores, -(-input_bytes // target_partition_bytes))
    parts = -(-parts // total_cores) * total_cores
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder: the shared folder the cluster names in
    `spark.checkpoint.dir` (or one already set on the context).  Where
    neither exists a folder of our own is created on a local master (tests);
    on a cluster, whose executors could not see it, that is an error.  The
    setting is static, so it is applied through the SparkContext, never
    written into the runtime conf."""
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="covlens-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d
