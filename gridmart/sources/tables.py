"""Table sources and sinks: the raw observation table, the technology seed, marts.

The raw table is Parquet partitioned by ``obs_date`` (the UTC day of
``datetime_utc``). Readers that know their time range pass it, so the scan is
pruned to the touched partitions and the remaining predicates reach the Parquet
reader as pushed filters.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmart.functions.calendar import utc_literal
from gridmart.schemas import RAW_PARTITION, RAW_TABLE, RAW_VERSIONED, TECHNOLOGY, TECHNOLOGY_SEED_CSV


def hadoop_fs(spark: SparkSession, path: str):
    """(FileSystem, Path) of a storage path, through the cluster's Hadoop configuration."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def raw_exists(spark: SparkSession, path: str) -> bool:
    """Preflight: the raw table has been provisioned (a ``_SUCCESS`` or data present)."""
    fs, jpath = hadoop_fs(spark, path)
    return bool(fs.exists(jpath))


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that readers see the old or the new text: written aside, then renamed over it."""
    jvm = spark.sparkContext._jvm
    fs, target = hadoop_fs(spark, path)
    _, aside = hadoop_fs(spark, f"{path}.new")
    out = fs.create(aside, True)
    out.write(bytearray(text.encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(aside, target, options)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, None if there is none."""
    fs, jpath = hadoop_fs(spark, path)
    if not fs.exists(jpath):
        return None
    stream = fs.open(jpath)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode()
    finally:
        stream.close()


def existing_days(spark: SparkSession, path: str) -> set[dt.date]:
    """Days that already have a raw partition (directory names only, no data read)."""
    if not raw_exists(spark, path):
        return set()
    fs, jpath = hadoop_fs(spark, path)
    prefix = f"{RAW_PARTITION}="
    days = set()
    for status in fs.listStatus(jpath):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(prefix):
            days.add(dt.date.fromisoformat(name[len(prefix):]))
    return days


def provision_raw(spark: SparkSession, path: str) -> None:
    """Create the raw table (empty, typed, partitioned) if it does not exist yet."""
    if raw_exists(spark, path):
        return
    empty = spark.createDataFrame([], RAW_VERSIONED).withColumn(RAW_PARTITION, F.to_date("datetime_utc"))
    empty.write.mode("errorifexists").partitionBy(RAW_PARTITION).parquet(path)


def with_partition(df: DataFrame) -> DataFrame:
    """Add the ``obs_date`` partition column (UTC day of ``datetime_utc``)."""
    return df.withColumn(RAW_PARTITION, F.to_date("datetime_utc"))


def read_raw(
    spark: SparkSession,
    path: str,
    start: dt.datetime | None = None,
    end: dt.datetime | None = None,
    versions: bool = False,
) -> DataFrame:
    """Scan the raw table, optionally restricted to ``[start, end)``; with ``versions`` also each row's version.

    The window becomes two predicates: a literal range on ``obs_date``
    (partition pruning) and the exact range on ``datetime_utc`` (row filter).
    """
    schema = T.StructType((RAW_VERSIONED if versions else RAW_TABLE).fields + [T.StructField(RAW_PARTITION, T.DateType())])
    df = spark.read.schema(schema).parquet(path)
    if start is not None:
        df = df.where(F.col(RAW_PARTITION) >= F.lit(start.date())).where(F.col("datetime_utc") >= utc_literal(start))
    if end is not None:
        last_day = (end - dt.timedelta(microseconds=1)).date()
        df = df.where(F.col(RAW_PARTITION) <= F.lit(last_day)).where(F.col("datetime_utc") < utc_literal(end))
    return df


def technologies_seed(spark: SparkSession) -> DataFrame:
    """The six-row technology seed (fixed values in ``schemas``)."""
    rows = []
    for line in TECHNOLOGY_SEED_CSV.strip().splitlines()[1:]:
        ind, name, group, renewable = line.split(",")
        rows.append((int(ind), name, group, renewable == "true"))
    return spark.createDataFrame(rows, TECHNOLOGY)


def read_technologies(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Seed CSV with header and explicit schema; the built-in seed when no path is given."""
    if path is None:
        return technologies_seed(spark)
    return spark.read.schema(TECHNOLOGY).option("header", "true").option("encoding", "UTF-8").csv(path)


def export_marts(spark: SparkSession, mart_paths: dict[str, str], out_dir: str) -> dict[str, str]:
    """Serving extracts: ``select *`` of each mart, written next to each other."""
    written = {}
    for name, src in mart_paths.items():
        dst = os.path.join(out_dir, name)
        spark.read.parquet(src).write.mode("overwrite").parquet(dst)
        written[name] = dst
    return written
