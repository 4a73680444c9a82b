"""Staging models over the raw long table: hourly price and hourly generation.

Both are one filtered scan plus one hash aggregation on the UTC hour. Spark
plans a partial (map-side) aggregate before the shuffle, so each map task ships
at most one row per hour it saw — a hot hour cannot skew the exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.functions.calendar import hour_utc
from gridmart.schemas import GENERATION_COLUMNS, PRICE_INDICATOR, SPAIN_GEO
from gridmart.sources.tables import read_technologies


def hourly_price(raw: DataFrame, geo_id: int = SPAIN_GEO) -> DataFrame:
    """Mean of the non-NULL spot prices of one geography per UTC hour.

    Output: hour_utc, price_eur_mwh (exact decimal mean).
    """
    return (
        raw.where(
            (F.col("indicator_id") == PRICE_INDICATOR)
            & (F.col("geo_id") == geo_id)
            & F.col("value").isNotNull()
        )
        .groupBy(hour_utc("datetime_utc").alias("hour_utc"))
        .agg(F.avg("value").alias("price_eur_mwh"))
    )


def _generation_rows(raw: DataFrame, geo_id: int) -> DataFrame:
    return raw.where(
        F.col("indicator_id").isin(list(GENERATION_COLUMNS)) & (F.col("geo_id") == geo_id)
    ).select(hour_utc("datetime_utc").alias("hour_utc"), "indicator_id", "value")


def generation_long(raw: DataFrame, geo_id: int = SPAIN_GEO) -> DataFrame:
    """Sum of the readings of each generation technology per UTC hour.

    Output: hour_utc, indicator_id, value_mwh (six 10-minute values summed, no
    unit conversion; the total indicator 10004 is excluded).
    """
    return (
        _generation_rows(raw, geo_id)
        .groupBy("hour_utc", "indicator_id")
        .agg(F.sum("value").alias("value_mwh"))
    )


def hourly_generation(raw: DataFrame, geo_id: int = SPAIN_GEO) -> DataFrame:
    """One row per UTC hour, one column per technology, plus the row total.

    The per-(hour, technology) sum and the pivot are fused into filtered
    aggregates over the raw rows: one shuffle instead of two, and exact because
    decimal sums are associative. A technology absent in an hour stays NULL; the
    total is the sum of the six technologies (NULL when none has a value).
    """
    ind = F.col("indicator_id")
    per_tech = [
        F.sum(F.when(ind == k, F.col("value"))).alias(name) for k, name in GENERATION_COLUMNS.items()
    ]
    return _generation_rows(raw, geo_id).groupBy("hour_utc").agg(*per_tech, F.sum("value").alias("total_mwh"))


def technologies(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Technology dimension (indicator_id, technology_name, technology_group, is_renewable)."""
    return read_technologies(spark, path).select(
        "indicator_id", "technology_name", "technology_group", "is_renewable"
    )
