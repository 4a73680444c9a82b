"""Shared helpers of the training-data operators."""

from __future__ import annotations

import math
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.session import checkpoint_dir

#: ASCII white space, as bytes.split() and the contracts' ``[^\x20\x09-\x0D]+`` see it.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
SPACE_RE = r"[\x20\x09-\x0D]+"
WORD_RE = r"[^\x20\x09-\x0D]+"

#: Rows of text in one Arrow batch: bounds a Python worker's memory when texts are long.
BATCH_ROWS = 1000

#: Python workers give freed memory back: large arrays are mapped, not kept in heaps that only grow.
WORKER_MEMORY = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "2", "MALLOC_MMAP_THRESHOLD_": "1048576", "MALLOC_TRIM_THRESHOLD_": "1048576"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def prepare(spark: SparkSession) -> SparkSession:
    """Python workers find this package, give memory back, and read texts in small Arrow batches."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    for name, value in WORKER_MEMORY.items():
        env.setdefault(name, value)
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder (``spark.checkpoint.dir``) and read it back.

    Parquet rather than ``checkpoint()``: columnar, compressed, and later reads prune columns.
    The files outlive any executor.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/gridmart-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(table: DataFrame) -> None:
    """Delete the files of a ``stored`` table that nothing will read again."""
    spark = table.sparkSession
    jvm, folders = spark.sparkContext._jvm, {f.rsplit("/", 1)[0] for f in table.inputFiles()}
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def words(text: Column) -> Column:
    """The words of a text as an array (null or blank text: empty array), JVM-side."""
    trimmed = F.btrim(text, F.lit(SPACES))
    empty = F.array().cast("array<string>")
    return F.when(F.coalesce(trimmed, F.lit("")) == "", empty).otherwise(F.split(trimmed, SPACE_RE))


def n_words(text: Column) -> Column:
    return F.size(words(text))


def parts(rows: int, rows_per_part: int) -> int:
    """How many buckets keep each at about ``rows_per_part`` rows: grows with the input."""
    return max(1, math.ceil(rows / rows_per_part))


def hash_unit(value: Column, digits: int = 13) -> Column:
    """A double in (0, 1) from the MD5 of a string (also computable by other engines)."""
    return (F.conv(F.substring(F.md5(value), 1, digits), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(16**digits))
