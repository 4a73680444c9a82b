"""Data-quality checks: not_null, unique, source freshness, table presence.

Each model is read once: not-null counts and, where a key must be unique, the keys
that occur more than once come from the same aggregation (NULL keys are ignored by
``unique``). The results are one row per (model, column, check) with its failures.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmart.functions.calendar import utc_literal
from gridmart.schemas import FRESHNESS_ERROR_HOURS, FRESHNESS_WARN_HOURS

CHECK_SCHEMA = T.StructType(
    [
        T.StructField("model", T.StringType(), False),
        T.StructField("column_name", T.StringType(), False),
        T.StructField("test_name", T.StringType(), False),
        T.StructField("failures", T.LongType(), False),
    ]
)

# Declared tests, in declaration order: raw source not_null; mart unique + not_null.
SOURCE = "indicator_values"
SOURCE_NOT_NULL = ("indicator_id", "datetime_utc", "geo_id", "extracted_at")
MART_TESTS = (
    ("fct_hourly_market", "hour_utc", ("unique", "not_null")),
    ("fct_hourly_market", "price_eur_mwh", ("not_null",)),
    ("fct_hourly_market", "renewable_pct", ("not_null",)),
    ("mart_daily_summary", "date_utc", ("unique", "not_null")),
    ("mart_daily_summary", "avg_price_eur_mwh", ("not_null",)),
    ("mart_daily_summary", "renewable_pct", ("not_null",)),
    ("mart_renewables_price_impact", "date_utc", ("unique", "not_null")),
    ("mart_renewables_price_impact", "renewable_pct", ("not_null",)),
    ("mart_technology_mix", "month_utc", ("unique", "not_null")),
)


def model_checks(df: DataFrame, model: str, not_null: Iterable[str], unique: str | None = None) -> DataFrame:
    """All checks of one model from one read of it, as check rows.

    NULL counts are sums. With a unique key they are taken per key first, so that
    the same aggregation also tells the non-NULL keys that occur more than once
    (the failures of ``unique`` are values, not rows).
    """
    not_null = list(not_null)
    if unique is None:
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(not_null)])
    else:
        key = F.col(unique)
        per_key = df.groupBy(key.alias("_key")).agg(
            F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(not_null)]
        )
        counts = per_key.agg(
            F.count_if(F.col("_key").isNotNull() & (F.col("_rows") > 1)).alias("u"),
            *[F.coalesce(F.sum(f"n{i}"), F.lit(0)).alias(f"n{i}") for i in range(len(not_null))],
        )
    found = [(c, "not_null", f"n{i}") for i, c in enumerate(not_null)] + ([(unique, "unique", "u")] if unique else [])
    rows = [
        F.struct(F.lit(model).alias("model"), F.lit(c).alias("column_name"),
                 F.lit(test).alias("test_name"), F.col(at).cast("bigint").alias("failures"))
        for c, test, at in found
    ]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _tests_of(model: str) -> tuple[list[str], str | None]:
    """(columns that must not be NULL, the column that must be unique) of a model."""
    if model == SOURCE:
        return list(SOURCE_NOT_NULL), None
    own = [(column, tests) for m, column, tests in MART_TESTS if m == model]
    unique = [c for c, tests in own if "unique" in tests]
    return [c for c, tests in own if "not_null" in tests], unique[0] if unique else None


def observed(df: DataFrame, model: str, within: Iterable[str] = ()) -> tuple[DataFrame, Observation]:
    """``df`` with a model's checks measured by whatever action runs over it: write it, then read the observation.

    A key that must be unique is numbered among its equals. ``within`` names columns that follow from
    the key and by which ``df`` is partitioned already: the numbering then needs no further exchange.
    """
    not_null, unique = _tests_of(model)
    metrics = [F.count_if(F.col(c).isNull()).alias(f"{c} not_null") for c in not_null]
    watch = Observation(f"{model}-{uuid.uuid4().hex}")
    if unique is None:
        return df.observe(watch, *metrics), watch
    nth = F.row_number().over(Window.partitionBy(*within, unique).orderBy(unique))
    # The second of equal keys stands for a value that occurs more than once.
    metrics.append(F.count_if(F.col(unique).isNotNull() & (F.col("_nth") == 2)).alias(f"{unique} unique"))
    return df.withColumn("_nth", nth).observe(watch, *metrics).drop("_nth"), watch


def check_rows(spark: SparkSession, found: dict[str, dict[str, int]]) -> DataFrame:
    """Observed failures ({model: {"column test": failures}}) as check rows."""
    rows = [(model, *name.rsplit(" ", 1), int(n)) for model, metrics in found.items() for name, n in metrics.items()]
    return spark.createDataFrame(rows, CHECK_SCHEMA)


def data_checks(raw: DataFrame, marts: dict[str, DataFrame]) -> DataFrame:
    """All declared tests: 4 source not_null + 4 unique + 9 not_null on the marts = 17 rows; each table read once."""
    out = model_checks(raw, SOURCE, *_tests_of(SOURCE))
    for model in dict.fromkeys(m for m, _, _ in MART_TESTS):
        out = out.unionByName(model_checks(marts[model], model, *_tests_of(model)))
    return out


def freshness(raw: DataFrame, as_of: dt.datetime | Column | list[dt.datetime] | None = None,
              loaded_at: str = "extracted_at") -> DataFrame:
    """Source freshness on ``loaded_at``: pass / warn (> 36 h) / error (> 72 h); one row a time asked for.

    The source is read once, however many times are asked for.
    """
    latest = raw.agg(F.max(loaded_at).alias("max_loaded_at"))
    now = F.current_timestamp() if as_of is None else (
        as_of if isinstance(as_of, Column) else utc_literal(as_of) if not isinstance(as_of, list) else F.col("_now"))
    if isinstance(as_of, list):
        latest = latest.select("max_loaded_at", F.explode(F.array(*map(utc_literal, as_of))).alias("_now"))
    age = F.unix_micros(now) - F.unix_micros(F.col("max_loaded_at"))
    warn_us = FRESHNESS_WARN_HOURS * 3_600_000_000
    err_us = FRESHNESS_ERROR_HOURS * 3_600_000_000
    status = (
        F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
        .when(age > err_us, F.lit("error"))
        .when(age > warn_us, F.lit("warn"))
        .otherwise(F.lit("pass"))
    )
    return latest.select(
        "max_loaded_at",
        now.alias("snapshotted_at"),
        (age / F.lit(1_000_000)).cast("decimal(20,6)").alias("age_seconds"),
        status.alias("status"),
    )


def table_exists(spark: SparkSession, path_or_table: str) -> bool:
    """Preflight: a catalog table or a storage path exists."""
    if "/" not in path_or_table and spark.catalog.tableExists(path_or_table):
        return True
    from gridmart.sources.tables import raw_exists

    return raw_exists(spark, path_or_table)  # a storage error is an error, not an absent table
