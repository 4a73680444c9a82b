"""Session helpers.

Every calendar rule in this library assumes the session time zone is UTC
(hour/day/month truncation of UTC instants, naive timestamps read as UTC).
``ensure_utc`` pins it on any session handed to us; ``build_session`` is the
local/test builder. Cluster settings (shuffle partitions, checkpoint dir,
executor sizing) are left to the cluster unless unset.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def ensure_utc(spark: SparkSession) -> SparkSession:
    """Pin the session time zone to UTC (runtime conf, cheap, idempotent)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def is_local(master: str | None) -> bool:
    """One JVM (``local``, ``local[4]``, ``local[4,2]``); ``local-cluster[...]`` has executors of its own."""
    return master is not None and (master == "local" or master.startswith("local["))


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and staging writes.

    Read from ``spark.checkpoint.dir`` (what the cluster names). Only when it is
    unset on a local master — local runs and tests — a scratch folder is created
    and registered; on a cluster an unset value is an error, never a
    machine-local folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not is_local(spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    local = tempfile.mkdtemp(prefix="gridmart-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def build_session(
    master: str | None = None,
    app_name: str = "gridmart",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session for local runs/tests (``master="local[N]"``) or a cluster (``master=None``).

    Locally the shuffle width follows the core count. On a cluster the width,
    executor sizing and ``spark.checkpoint.dir`` come from the cluster's own
    configuration; if the shuffle width is unset there, a wide default is used
    and AQE coalesces small stages (the hour/day/month marts) down to a few
    tasks while large stages (the upsert join) keep ~128 MB partitions.
    """
    local = is_local(master)
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if local:
        cpus = master[len("local["):-1] if master.startswith("local[") else "1"
        cpus = os.environ.get("BENCH_CPUS", "8") if cpus == "*" else cpus
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
        conf["spark.driver.memory"] = "8g"
    elif shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not local and not spark.sparkContext.getConf().contains("spark.sql.shuffle.partitions"):
        spark.conf.set("spark.sql.shuffle.partitions", "4000")  # nobody chose a width
    return ensure_utc(spark)
