"""Report queries over the marts (the dashboard's result tables).

Column names are the report's own. ``as_of`` stands for "today" in the rolling
30-day window: a date, a date string, or a Column (e.g. a scalar subquery such
as ``daily.agg(max("date_utc")).scalar()``); default ``current_date()``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.functions.measures import rounded
from gridmart.schemas import MIX_LABELS, REPORT_WINDOW_DAYS

AsOf = Column | dt.date | str | None


def _as_of(as_of: AsOf) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("date")


def _recent(daily: DataFrame, as_of: AsOf, days: int) -> DataFrame:
    """The last ``days`` days. The second condition follows from the first: on a mart stored by month it
    lies on the partition columns, so that only the window's months are read (at run time, too, where
    ``as_of`` is a subquery)."""
    first = F.date_sub(_as_of(as_of), days)
    in_months = F.col("year") * 12 + F.col("month") >= F.year(first) * 12 + F.month(first)
    return daily.where((F.col("date_utc") >= first) & in_months)


def kpis_window(daily: DataFrame, as_of: AsOf = None, days: int = REPORT_WINDOW_DAYS) -> DataFrame:
    """Headline KPIs over the last ``days`` days (one row)."""
    return _recent(daily, as_of, days).agg(
        rounded(F.avg("avg_price_eur_mwh"), 2).alias("precio_medio"),
        rounded(F.max("max_price_eur_mwh"), 2).alias("precio_max"),
        rounded(F.min("min_price_eur_mwh"), 2).alias("precio_min"),
        rounded(F.avg("renewable_pct"), 1).alias("pct_renovable_medio"),
        F.sum("negative_price_hours").alias("horas_precio_negativo"),
    )


def price_last_days(daily: DataFrame, as_of: AsOf = None, days: int = REPORT_WINDOW_DAYS) -> DataFrame:
    """Daily price and share over the last ``days`` days, by date."""
    return _recent(daily, as_of, days).select("date_utc", "avg_price_eur_mwh", "renewable_pct").orderBy("date_utc")


def mix_last_month(mix: DataFrame) -> DataFrame:
    """Technology shares of the latest month as (tecnologia, porcentaje) rows.

    One filtered pass plus an unpivot (which keeps NULL shares, so there are
    always six rows) instead of six scans each with its own max() subquery.
    """
    latest = mix.where(F.col("month_utc") == mix.agg(F.max("month_utc")).scalar())
    labelled = latest.select(*[F.col(col).alias(label) for label, col in MIX_LABELS])
    return labelled.unpivot([], [label for label, _ in MIX_LABELS], "tecnologia", "porcentaje")


def price_daily(daily: DataFrame) -> DataFrame:
    return daily.select(
        "date_utc",
        "avg_price_eur_mwh",
        "min_price_eur_mwh",
        "max_price_eur_mwh",
        "negative_price_hours",
        "renewable_pct",
    ).orderBy("date_utc")


def price_heatmap(fct: DataFrame) -> DataFrame:
    """Mean hourly price by local hour of day and weekday (unrounded)."""
    return (
        fct.groupBy("hour_of_day", "day_of_week")
        .agg(F.avg("price_eur_mwh").alias("avg_price"))
        .orderBy("day_of_week", "hour_of_day")
    )


def price_monthly(daily: DataFrame) -> DataFrame:
    """Monthly mean of the daily price and of the daily share (unrounded).

    The rounded daily share is widened before averaging so the mean keeps
    enough decimals.
    """
    return (
        daily.groupBy(F.trunc("date_utc", "month").alias("month_utc"))
        .agg(
            F.avg("avg_price_eur_mwh").alias("avg_price"),
            F.avg(F.col("renewable_pct").cast("decimal(18,6)")).alias("avg_renewable_pct"),
        )
        .orderBy("month_utc")
    )


def impact_points(impact: DataFrame) -> DataFrame:
    return impact.select(
        "date_utc",
        "avg_price_eur_mwh",
        "renewable_pct",
        "wind_mwh",
        "solar_pv_mwh",
        "hydro_mwh",
        "renewable_bucket",
        "price_bucket",
        "had_negative_prices",
        "high_renewable_day",
    ).orderBy("date_utc")


def price_by_bucket(impact: DataFrame) -> DataFrame:
    return (
        impact.groupBy("renewable_bucket")
        .agg(rounded(F.avg("avg_price_eur_mwh"), 2).alias("avg_price"), F.count(F.lit(1)).alias("dias"))
        .orderBy("renewable_bucket")
    )


def negative_price_days(impact: DataFrame) -> DataFrame:
    return (
        impact.where(F.col("had_negative_prices"))
        .select("date_utc", "avg_price_eur_mwh", "renewable_pct", "had_negative_prices")
        .orderBy("date_utc")
    )


def mix_monthly_pct(mix: DataFrame) -> DataFrame:
    return mix.select(
        "month_utc",
        "wind_pct",
        "solar_pv_pct",
        "hydro_pct",
        "coal_pct",
        "combined_cycle_pct",
        "cogen_residues_pct",
        "avg_renewable_pct",
        "avg_price_eur_mwh",
        "negative_price_days",
    ).orderBy("month_utc")


def mix_monthly_mwh(mix: DataFrame) -> DataFrame:
    return mix.select(
        "month_utc",
        "wind_mwh",
        "solar_pv_mwh",
        "hydro_mwh",
        "coal_mwh",
        "combined_cycle_mwh",
        "cogen_residues_mwh",
    ).orderBy("month_utc")
