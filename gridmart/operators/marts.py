"""Daily, price-impact and monthly marts.

The daily mart aggregates the hourly fact per UTC day; the impact and monthly
marts read the *daily* mart (monthly sums add rounded daily MWh, monthly means
average rounded daily values). All arithmetic is decimal; rounding is half away
from zero.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.functions.calendar import weekday_sun0
from gridmart.functions.measures import bucket, rounded, share_nonzero
from gridmart.schemas import (
    HIGH_RENEWABLE_PCT,
    PRICE_BUCKET_TOP,
    PRICE_BUCKETS,
    RENEWABLE_BUCKET_TOP,
    RENEWABLE_BUCKETS,
)

MWH_COLUMNS = (
    "wind_mwh",
    "solar_pv_mwh",
    "hydro_mwh",
    "coal_mwh",
    "combined_cycle_mwh",
    "cogen_residues_mwh",
    "total_mwh",
    "renewable_mwh",
)
SHARE_COLUMNS = (
    ("wind_pct", "wind_mwh"),
    ("solar_pv_pct", "solar_pv_mwh"),
    ("hydro_pct", "hydro_mwh"),
    ("coal_pct", "coal_mwh"),
    ("combined_cycle_pct", "combined_cycle_mwh"),
    ("cogen_residues_pct", "cogen_residues_mwh"),
)


def daily_summary(fct: DataFrame) -> DataFrame:
    """One row per UTC day: price stats, rounded MWh sums, share, negative hours, range.

    The share is the ratio of sums (Σrenewable / Σtotal), NULL only when the
    day's total is exactly 0.
    """
    price = F.col("price_eur_mwh")
    sums = [rounded(F.sum(c), 0).alias(c) for c in MWH_COLUMNS]
    daily = fct.groupBy("date_utc").agg(
        rounded(F.avg(price), 2).alias("avg_price_eur_mwh"),
        rounded(F.min(price), 2).alias("min_price_eur_mwh"),
        rounded(F.max(price), 2).alias("max_price_eur_mwh"),
        *sums,
        share_nonzero(F.sum("renewable_mwh"), F.sum("total_mwh"), 1).alias("renewable_pct"),
        F.count_if(price < 0).alias("negative_price_hours"),
        rounded(F.max(price) - F.min(price), 2).alias("price_range_eur_mwh"),
    )
    d = F.col("date_utc")
    return daily.select(
        "date_utc",
        F.year(d).cast("int").alias("year"),
        F.month(d).cast("int").alias("month"),
        weekday_sun0(d).alias("day_of_week"),
        "avg_price_eur_mwh",
        "min_price_eur_mwh",
        "max_price_eur_mwh",
        *MWH_COLUMNS,
        "renewable_pct",
        "negative_price_hours",
        "price_range_eur_mwh",
    )


def price_impact(daily: DataFrame) -> DataFrame:
    """Daily merit-order view: price and share with buckets and signal flags."""
    price, share = F.col("avg_price_eur_mwh"), F.col("renewable_pct")
    return daily.where(price.isNotNull() & share.isNotNull()).select(
        "date_utc",
        "year",
        "month",
        "avg_price_eur_mwh",
        "renewable_pct",
        "wind_mwh",
        "solar_pv_mwh",
        "hydro_mwh",
        "renewable_mwh",
        "total_mwh",
        bucket(price, PRICE_BUCKETS, PRICE_BUCKET_TOP).alias("price_bucket"),
        bucket(share, RENEWABLE_BUCKETS, RENEWABLE_BUCKET_TOP).alias("renewable_bucket"),
        (F.col("negative_price_hours") > 0).alias("had_negative_prices"),
        (share > HIGH_RENEWABLE_PCT).alias("high_renewable_day"),
    )


def technology_mix(daily: DataFrame, ordered: bool = True) -> DataFrame:
    """One row per UTC month from the daily mart.

    MWh are sums of rounded daily MWh; the price and share are unweighted means
    of the rounded daily values; technology shares are ratios of monthly sums.
    """
    month_utc = F.trunc("date_utc", "month")
    total = F.sum("total_mwh")
    out = daily.groupBy(month_utc.alias("month_utc"), "year", "month").agg(
        *[rounded(F.sum(c), 0).alias(c) for c in MWH_COLUMNS],
        rounded(F.avg("avg_price_eur_mwh"), 2).alias("avg_price_eur_mwh"),
        rounded(F.avg("renewable_pct"), 1).alias("avg_renewable_pct"),
        *[share_nonzero(F.sum(src), total, 1).alias(name) for name, src in SHARE_COLUMNS],
        F.sum("negative_price_hours").alias("total_negative_price_hours"),
        F.count_if(F.col("negative_price_hours") > 0).alias("negative_price_days"),
    )
    return out.orderBy("month_utc") if ordered else out
