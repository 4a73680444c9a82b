"""Hourly market (price joined to generation) and the hourly fact.

Both inputs are already aggregated to one row per UTC hour, so the join is
between two hour-keyed relations whose size is bounded by the number of hours
covered (not by the raw volume). Catalyst/AQE pick the strategy from runtime
sizes; the fact's NOT NULL filter on the generation side turns the left join
into an inner join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.functions.calendar import hour_utc, local_parts, to_local
from gridmart.functions.measures import coalesced_sum, share_if_positive
from gridmart.schemas import GENERATION_COLUMNS, PRICE_INDICATOR, RENEWABLE_COLUMNS, SPAIN_GEO

GENERATION_ORDER = (
    "wind_mwh",
    "solar_pv_mwh",
    "hydro_mwh",
    "coal_mwh",
    "combined_cycle_mwh",
    "cogen_residues_mwh",
    "total_mwh",
)


def _market_columns(hours: DataFrame) -> DataFrame:
    renewable = coalesced_sum(RENEWABLE_COLUMNS)
    return hours.select(
        "hour_utc",
        "price_eur_mwh",
        *GENERATION_ORDER,
        renewable.alias("renewable_mwh"),
        share_if_positive(renewable, "total_mwh", 1).alias("renewable_pct"),
    )


def hourly_market(prices: DataFrame, generation: DataFrame) -> DataFrame:
    """Every priced hour with its generation mix and renewable metrics (join form).

    Left join of the hourly price onto the hourly generation pivot — the form
    to use when both staging tables are stored. renewable_mwh counts a missing
    technology as 0; renewable_pct is rounded to one decimal and NULL unless the
    hour's total is positive.
    """
    return _market_columns(prices.join(generation, on="hour_utc", how="left"))


def hourly_market_from_raw(raw: DataFrame, geo_id: int = SPAIN_GEO) -> DataFrame:
    """Same result as ``hourly_market(hourly_price(raw), hourly_generation(raw))`` in one pass.

    Price and generation readings of an hour are aggregated together with
    filtered aggregates (mean of the non-NULL prices, per-technology sums, the
    six-technology total): one scan, one shuffle, no join. Keeping only hours
    with a price reproduces the left join; an hour with price but no generation
    rows gets NULL generation, exactly as the join does.
    """
    ind, value = F.col("indicator_id"), F.col("value")
    gen_ids = list(GENERATION_COLUMNS)
    rows = raw.where((F.col("geo_id") == geo_id) & ind.isin([PRICE_INDICATOR, *gen_ids]))
    hours = rows.groupBy(hour_utc("datetime_utc").alias("hour_utc")).agg(
        F.avg(F.when(ind == PRICE_INDICATOR, value)).alias("price_eur_mwh"),
        *[F.sum(F.when(ind == k, value)).alias(name) for k, name in GENERATION_COLUMNS.items()],
        F.sum(F.when(ind.isin(gen_ids), value)).alias("total_mwh"),
    )
    return _market_columns(hours.where(F.col("price_eur_mwh").isNotNull()))


def fct_hourly_market(market: DataFrame) -> DataFrame:
    """Hourly fact: hours with both a price and a generation total, plus calendars.

    ``date_utc`` is the UTC day; hour_of_day / day_of_week (Sunday = 0) / month /
    year are read on the local wall clock, and ``hour_madrid`` is that wall-clock
    time (not unique on the autumn clock change).
    """
    parts = local_parts("hour_utc")
    return market.where(F.col("price_eur_mwh").isNotNull() & F.col("total_mwh").isNotNull()).select(
        "hour_utc",
        to_local("hour_utc").alias("hour_madrid"),
        F.to_date("hour_utc").alias("date_utc"),
        parts["hour_of_day"].alias("hour_of_day"),
        parts["day_of_week"].alias("day_of_week"),
        parts["month"].alias("month"),
        parts["year"].alias("year"),
        "price_eur_mwh",
        *GENERATION_ORDER,
        "renewable_mwh",
        "renewable_pct",
    )
