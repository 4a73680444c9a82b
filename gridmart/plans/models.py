"""The model graph as one composition: raw -> staging -> hourly -> fact -> marts.

``build_models`` returns a lazy graph: each model DataFrame is built (and
analysed) only when first asked for, then reused, so a query that needs the
hourly price does not pay for planning the monthly mart. Nothing executes
until an action. The batch pipeline writes the fact and daily marts and
derives the rest from the written daily table; queries use the plan directly.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from gridmart.operators import market, marts, staging


class Models:
    def __init__(self, raw: DataFrame):
        self.raw = raw

    @cached_property
    def hourly_price(self) -> DataFrame:
        return staging.hourly_price(self.raw)

    @cached_property
    def generation_long(self) -> DataFrame:
        return staging.generation_long(self.raw)

    @cached_property
    def hourly_generation(self) -> DataFrame:
        return staging.hourly_generation(self.raw)

    @cached_property
    def hourly_market(self) -> DataFrame:
        # One filtered aggregation over raw instead of two aggregations + a join.
        return market.hourly_market_from_raw(self.raw)

    @cached_property
    def fct_hourly_market(self) -> DataFrame:
        return market.fct_hourly_market(self.hourly_market)

    @cached_property
    def daily_summary(self) -> DataFrame:
        return marts.daily_summary(self.fct_hourly_market)

    @cached_property
    def price_impact(self) -> DataFrame:
        return marts.price_impact(self.daily_summary)

    @cached_property
    def technology_mix(self) -> DataFrame:
        return marts.technology_mix(self.daily_summary)


def build_models(raw: DataFrame) -> Models:
    return Models(raw)
