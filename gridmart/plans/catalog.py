"""SQL access: stored marts as catalog tables, models as views, reports over them.

``publish`` copies the marts into a fresh folder and then switches to it: one rename
of a pointer file for other sessions, and the locations of the catalogue's tables in
this one. A reader during a refresh or a publication sees the marts as they were or
as they are, never a mixture or a gap; a query that is running keeps the files that
it began with, since the folder before is kept until the next publication.

``register`` exposes the published marts as external Parquet tables in a database (default ``analytics_marts``) and the
staging/intermediate models as temporary views over the raw table, so report SQL can
be run with ``spark.sql``. ``report`` runs one of the report queries of
``operators.reports`` on those tables.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridmart.operators import market, reports
from gridmart.plans.models import build_models
from gridmart.plans.warehouse import MART_NAMES, Layout, last_refresh, read_mart
from gridmart.schemas import RAW_KEYS
from gridmart.sources import tables

VIEW_NAMES = {
    "stg_hourly_prices": "hourly_price",
    "stg_generation_long": "generation_long",
    "stg_generation": "hourly_generation",
    "int_hourly_market": "hourly_market",
}


def _published(layout: Layout) -> str:
    return f"{layout.root.rstrip('/')}/published"


def _current(spark: SparkSession, layout: Layout) -> tuple[str | None, str | None]:
    """(folder, refresh) published last: the marts' folder and the refresh that it is a copy of."""
    text = tables.read_text(spark, f"{_published(layout)}/_current")
    name, _, refresh = (text or "").strip().partition(" ")
    return (f"{_published(layout)}/{name}" if name else None), refresh or None


def published_folder(spark: SparkSession, layout: Layout) -> str | None:
    return _current(spark, layout)[0]


def _locate(spark: SparkSession, folder: str, db: str) -> None:
    """The catalogue's tables of the marts, at a published folder."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    for name in MART_NAMES:
        table, path = f"{db}.{name}", f"{folder}/{name}"
        if spark.catalog.tableExists(table):
            quoted = path.replace("'", "\\'")
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{quoted}'")
            spark.catalog.refreshTable(table)
        else:
            spark.catalog.createTable(table, path=path, source="parquet")


def publish(spark: SparkSession, layout: Layout, db: str = "analytics_marts") -> str:
    """Copy the marts to a fresh folder, switch readers to it, and remove the folders before the last one.

    The copies are hour-grained or coarser (some thousand rows a year) and plain: a table's location
    is all that changes.
    """
    before, refresh = published_folder(spark, layout), last_refresh(spark, layout)
    name = f"run-{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    folder = f"{_published(layout)}/{name}"
    for mart in MART_NAMES:
        copy_mart(read_mart(spark, layout, mart), f"{folder}/{mart}")
    tables.replace_text(spark, f"{_published(layout)}/_current", f"{name} {refresh or ''}")
    _locate(spark, folder, db)
    fs, root = tables.hadoop_fs(spark, _published(layout))
    keep = {name, before.rsplit("/", 1)[1] if before else name}
    for status in fs.listStatus(root):
        if status.isDirectory() and status.getPath().getName() not in keep:
            fs.delete(status.getPath(), True)
    return folder


def copy_mart(mart: DataFrame, path: str) -> None:
    by_time = [c for c in mart.columns if c in ("hour_utc", "date_utc", "month_utc")][0]
    mart.repartition("year").sortWithinPartitions(by_time).write.parquet(path)


def ensure_published(spark: SparkSession, layout: Layout, db: str = "analytics_marts") -> str:
    """The folder of the marts as last refreshed: published now unless it is already."""
    folder, refresh = _current(spark, layout)
    if folder is None or refresh != last_refresh(spark, layout):
        return publish(spark, layout, db)
    return folder


def register(spark: SparkSession, layout: Layout, db: str = "analytics_marts") -> None:
    """Create/refresh the marts database (publishing the marts if they changed) and the model views."""
    _locate(spark, ensure_published(spark, layout, db), db)
    models = build_models(tables.read_raw(spark, layout.raw).select(*RAW_KEYS, "value"))
    for view, attr in VIEW_NAMES.items():
        getattr(models, attr).createOrReplaceTempView(view)


#: Hours in a bucket of the hourly tables: ten years are about 88,000.
BUCKET_HOURS = 100_000
HOURLY = {"hourly_prices_by_hour": "hourly_price", "hourly_generation_by_hour": "hourly_generation"}


def store_hourly(spark: SparkSession, layout: Layout, db: str = "analytics_staging", buckets: int | None = None) -> DataFrame:
    """Hourly prices and generation as tables bucketed and sorted by the hour; returns the market joined from them.

    Equal bucketing places the rows of an hour in the same bucket of both tables: the join (and any other
    on the hour) reads them bucket by bucket, without an exchange or a sort.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    models = build_models(tables.read_raw(spark, layout.raw).select(*RAW_KEYS, "value"))
    if buckets is None:
        days = len(tables.existing_days(spark, layout.raw))  # folder names
        buckets = max(1, -(-24 * days // BUCKET_HOURS))
    for name, attr in HOURLY.items():
        rows = getattr(models, attr).repartition(buckets, "hour_utc")  # one file a bucket
        writer = rows.write.mode("overwrite").bucketBy(buckets, "hour_utc").sortBy("hour_utc")
        writer.option("path", f"{layout.root.rstrip('/')}/hourly/{name}").saveAsTable(f"{db}.{name}")
    prices, generation = (spark.table(f"{db}.{name}") for name in HOURLY)
    return market.hourly_market(prices, generation)


def reports_over(marts: dict[str, DataFrame], as_of: dt.date | None = None) -> dict[str, Callable[[], DataFrame]]:
    """The report queries (``operators.reports``) bound to a set of marts."""
    daily, fct = marts["mart_daily_summary"], marts["fct_hourly_market"]
    impact, mix = marts["mart_renewables_price_impact"], marts["mart_technology_mix"]
    return {
        "kpis_window": lambda: reports.kpis_window(daily, as_of=as_of),
        "price_last_days": lambda: reports.price_last_days(daily, as_of=as_of),
        "mix_last_month": lambda: reports.mix_last_month(mix),
        "price_daily": lambda: reports.price_daily(daily),
        "price_heatmap": lambda: reports.price_heatmap(fct),
        "price_monthly": lambda: reports.price_monthly(daily),
        "impact_points": lambda: reports.impact_points(impact),
        "price_by_bucket": lambda: reports.price_by_bucket(impact),
        "negative_price_days": lambda: reports.negative_price_days(impact),
        "mix_monthly_pct": lambda: reports.mix_monthly_pct(mix),
        "mix_monthly_mwh": lambda: reports.mix_monthly_mwh(mix),
    }


def report(spark: SparkSession, name: str, db: str = "analytics_marts", as_of: dt.date | None = None) -> DataFrame:
    """One report over the registered marts; ``as_of`` defaults to the current date."""
    return reports_over({n: spark.table(f"{db}.{n}") for n in MART_NAMES}, as_of)[name]()
