"""Query registry: one callable ``(spark, sf_dir) -> DataFrame`` per product/operator.

Each query reads the shared test tables (``events`` drives the observation
fixture, see ``gridmart.sources.fixtures``) and runs the library operator over
all of it. Outputs are made engine-neutral for the SQL oracle check: decimals
become doubles, instants become UTC wall-clock ``timestamp_ntz``, unrounded
means are rounded to 6 decimals; values are otherwise the operator's own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmart.operators import ingest, market, quality, reports, upsert
from gridmart.plans import catalog, warehouse
from gridmart.plans.models import Models, build_models
from gridmart.schemas import RAW_KEYS, RAW_PARTITION, RAW_VERSIONED
from gridmart.session import ensure_utc
from gridmart.sources import fixtures, payload, tables

Query = Callable[[SparkSession, str], DataFrame]


def comparable(df: DataFrame, unrounded: Iterable[str] = ()) -> DataFrame:
    """Engine-neutral output types (decimal->double, timestamp->UTC ntz)."""
    unrounded = set(unrounded)
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in unrounded:
            c = F.round(c, 6)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    return df.select(cols)


def models(spark: SparkSession, sf_dir: str) -> Models:
    ensure_utc(spark)
    return build_models(fixtures.load_observations(spark, sf_dir))


def _latest_day(daily: DataFrame):
    """Fixed report date: the last day in the data (a scalar subquery, not a driver value)."""
    return daily.agg(F.max("date_utc")).scalar()


# --- models -----------------------------------------------------------------


def q_hourly_price(spark, sf_dir):
    return comparable(models(spark, sf_dir).hourly_price, unrounded=["price_eur_mwh"])


def q_generation_long(spark, sf_dir):
    return comparable(models(spark, sf_dir).generation_long)


def q_hourly_generation(spark, sf_dir):
    return comparable(models(spark, sf_dir).hourly_generation)


def q_hourly_market(spark, sf_dir):
    return comparable(models(spark, sf_dir).hourly_market, unrounded=["price_eur_mwh"])


def q_fct_hourly_market(spark, sf_dir):
    return comparable(models(spark, sf_dir).fct_hourly_market, unrounded=["price_eur_mwh"])


def q_daily_summary(spark, sf_dir):
    return comparable(models(spark, sf_dir).daily_summary)


def q_price_impact(spark, sf_dir):
    return comparable(models(spark, sf_dir).price_impact)


def q_technology_mix(spark, sf_dir):
    return comparable(models(spark, sf_dir).technology_mix)


# --- reports ----------------------------------------------------------------


def q_kpis_window(spark, sf_dir):
    daily = models(spark, sf_dir).daily_summary
    return comparable(reports.kpis_window(daily, as_of=_latest_day(daily)))


def q_price_last_days(spark, sf_dir):
    daily = models(spark, sf_dir).daily_summary
    return comparable(reports.price_last_days(daily, as_of=_latest_day(daily)))


def q_mix_last_month(spark, sf_dir):
    return comparable(reports.mix_last_month(models(spark, sf_dir).technology_mix))


def q_price_daily(spark, sf_dir):
    return comparable(reports.price_daily(models(spark, sf_dir).daily_summary))


def q_price_heatmap(spark, sf_dir):
    return comparable(reports.price_heatmap(models(spark, sf_dir).fct_hourly_market), unrounded=["avg_price"])


def q_price_monthly(spark, sf_dir):
    return comparable(
        reports.price_monthly(models(spark, sf_dir).daily_summary),
        unrounded=["avg_price", "avg_renewable_pct"],
    )


def q_impact_points(spark, sf_dir):
    return comparable(reports.impact_points(models(spark, sf_dir).price_impact))


def q_price_by_bucket(spark, sf_dir):
    return comparable(reports.price_by_bucket(models(spark, sf_dir).price_impact))


def q_negative_price_days(spark, sf_dir):
    return comparable(reports.negative_price_days(models(spark, sf_dir).price_impact))


def q_mix_monthly_pct(spark, sf_dir):
    return comparable(reports.mix_monthly_pct(models(spark, sf_dir).technology_mix))


def q_mix_monthly_mwh(spark, sf_dir):
    return comparable(reports.mix_monthly_mwh(models(spark, sf_dir).technology_mix))


# --- ingest -------------------------------------------------------------------

# Manual backfill window used by ``window_filter`` (end day included).
WINDOW = ("2024-03-01", "2024-06-30")
CATALOGUE_FILTER = "CLICK"


def _items(spark, sf_dir):
    ensure_utc(spark)
    docs = fixtures.payload_documents(fixtures.read_events(spark, sf_dir))
    return payload.explode_payload(payload.parse_payload(docs))


def _checks(spark, sf_dir):
    return ingest.indicator_checks(ingest.normalise(_items(spark, sf_dir)))


def q_payload_explode(spark, sf_dir):
    return _items(spark, sf_dir)


def q_normalise(spark, sf_dir):
    return comparable(ingest.normalise(_items(spark, sf_dir)).drop(*ingest.DOCUMENT))


def q_refetch_overlap(spark, sf_dir):
    """Two overlapping answers per indicator: the newest value of each key, duplicates judged per answer."""
    ensure_utc(spark)
    norm = ingest.normalise(fixtures.refetched_items(fixtures.read_events(spark, sf_dir)))
    return comparable(ingest.accepted(norm, ingest.rejected_indicators(ingest.indicator_checks(norm))))


def _answers(spark, sf_dir):
    ensure_utc(spark)
    norm = ingest.normalise(fixtures.answers(fixtures.read_events(spark, sf_dir)))
    return norm, ingest.answer_checks(norm)


def q_answer_status(spark, sf_dir):
    """Per indicator: answers, failed ones, those that newer good answers cover, and whether it failed."""
    return ingest.answer_status(spark, ingest.with_superseded(_answers(spark, sf_dir)[1]))


def q_accepted_answers(spark, sf_dir):
    """What loads of several answers per indicator: the good ones' newest value of each key, and its fetch day."""
    rows = ingest.accepted_answers(*_answers(spark, sf_dir))
    return comparable(rows.select(*RAW_KEYS, "value", ingest.version_day(F.col("version")).alias("fetch_day")))


def _stored(spark, sf_dir, revise: bool = False):
    """A warehouse in the shared work folder, loaded with the answers: all at once, or the newest ones first."""
    ensure_utc(spark)
    items = fixtures.answers(fixtures.read_events(spark, sf_dir))
    layout = warehouse.Layout(warehouse.work_folder(spark, "stored"))
    newest = F.col("document") == "c"
    for batch, at in ((items.where(newest), fixtures.FIRST_LOAD_TS), (items.where(~newest), fixtures.REVISION_TS)) if revise else ((items, fixtures.FIRST_LOAD_TS),):
        result = warehouse.ingest_items(spark, batch, layout, at)
        warehouse.refresh_marts(spark, layout, result.changed_days)
    return layout


def q_stored_window(spark, sf_dir):
    """A window of the stored raw table after two runs, the newest answers in the first of them."""
    layout = _stored(spark, sf_dir, revise=True)
    rows = tables.read_raw(spark, layout.raw, *ingest.extraction_window(*WINDOW), versions=True)
    out = rows.select(*RAW_KEYS, "value", "extracted_at", ingest.version_day(F.col("version")).alias("fetch_day"))
    return comparable(out)


def q_stored_daily(spark, sf_dir):
    """The daily mart of the stored warehouse, built month by month in two runs, as the catalogue's table shows it."""
    layout = _stored(spark, sf_dir, revise=True)
    catalog.publish(spark, layout, "gridmart_stored")
    return comparable(spark.table("gridmart_stored.mart_daily_summary"))


def q_stored_checks(spark, sf_dir):
    """The 17 declared checks as the writes of the stored warehouse have measured them."""
    return warehouse.checks_report(spark, _stored(spark, sf_dir))[0]


def q_ingest_rejects(spark, sf_dir):
    return ingest.rejected_indicators(_checks(spark, sf_dir))


def q_duplicate_keys(spark, sf_dir):
    return comparable(ingest.duplicate_keys(ingest.normalise(_items(spark, sf_dir))))


def q_accepted(spark, sf_dir):
    norm = ingest.normalise(_items(spark, sf_dir))
    rejected = ingest.rejected_indicators(ingest.indicator_checks(norm))
    return comparable(ingest.accepted(norm, rejected))


def q_run_status(spark, sf_dir):
    return ingest.run_status(spark, _checks(spark, sf_dir))


def q_window_filter(spark, sf_dir):
    ensure_utc(spark)
    start, end = ingest.extraction_window(*WINDOW)
    return comparable(ingest.window_filter(fixtures.load_observations(spark, sf_dir), start, end))


def q_registry_coverage(spark, sf_dir):
    ensure_utc(spark)
    return comparable(ingest.registry_coverage(spark, fixtures.load_observations(spark, sf_dir)))


def q_catalogue_search(spark, sf_dir):
    ensure_utc(spark)
    docs = fixtures.catalogue_documents(fixtures.read_events(spark, sf_dir))
    entries = payload.explode_catalogue(payload.parse_catalogue(docs))
    return payload.search_catalogue(entries, CATALOGUE_FILTER)


# --- upsert --------------------------------------------------------------------


def _merge(spark, sf_dir):
    ensure_utc(spark)
    events = fixtures.read_events(spark, sf_dir)
    return upsert.merge_plan(
        fixtures.upsert_target(events), fixtures.upsert_source(events), fixtures.REVISION_TS
    )


def _merged_by_slices(spark, target, source, run_ts):
    """What the stored upsert runs: days cut into key buckets by their row counts, each merged in place."""
    target, source = tables.with_partition(target), tables.with_partition(source)
    keys = target.select(RAW_PARTITION).unionByName(source.select(RAW_PARTITION))
    per_day = {r[RAW_PARTITION]: r["count"] for r in keys.groupBy(RAW_PARTITION).count().collect()}  # one row a day
    k_by_day, slots = warehouse.slices(per_day, warehouse._shuffle_width(spark))
    sides = [warehouse._with_bucket(side, k_by_day) for side in (target, source)]
    return upsert.merge_plan_clustered(*sides, run_ts, warehouse._CLUSTER, slots)


def _merge_clustered(spark, sf_dir):
    ensure_utc(spark)
    events = fixtures.read_events(spark, sf_dir)
    return _merged_by_slices(spark, fixtures.upsert_target(events), fixtures.upsert_source(events), fixtures.REVISION_TS)


def q_upsert_clustered(spark, sf_dir):
    return comparable(upsert.merged_table(_merge_clustered(spark, sf_dir)))


def q_upsert_clustered_counts(spark, sf_dir):
    return upsert.merge_counts(_merge_clustered(spark, sf_dir))


def q_upsert_versioned(spark, sf_dir):
    """Four answers that arrive in three batches, newer ones first: the newest value of each key and its fetch day."""
    ensure_utc(spark)
    events = fixtures.read_events(spark, sf_dir)
    table = spark.createDataFrame([], RAW_VERSIONED)
    for batch in fixtures.ARRIVALS:
        rows = fixtures.versioned_batch(events, batch).withColumn("version", ingest.version_of(F.col("fetched_at"), F.col("document")))
        newest = rows.groupBy(*RAW_KEYS).agg(F.max_by("value", "version").alias("value"), F.max("version").alias("version"))
        table = upsert.merged_table(_merged_by_slices(spark, table, newest, fixtures.REVISION_TS))
    return comparable(table.select(*RAW_KEYS, "value", ingest.version_day(F.col("version")).alias("fetch_day")))


def q_hourly_market_join(spark, sf_dir):
    """The join form of the hourly fact: prices left-joined with generation."""
    m = models(spark, sf_dir)
    return comparable(market.hourly_market(m.hourly_price, m.hourly_generation), unrounded=["price_eur_mwh"])


def q_upsert(spark, sf_dir):
    return comparable(upsert.merged_table(_merge(spark, sf_dir)))


def q_upsert_counts(spark, sf_dir):
    return upsert.merge_counts(_merge(spark, sf_dir))


# --- quality -------------------------------------------------------------------


def _planted(df: DataFrame, group: str, twice: int, null: int, *columns: str) -> DataFrame:
    """The rows, those of one group once more, and those of another group with NULLs instead of ``columns``."""
    nulls = df.where(F.col(group) == null).withColumns({c: F.lit(None).cast(df.schema[c].dataType) for c in columns})
    return df.unionByName(df.where(F.col(group) == twice)).unionByName(nulls)


def q_data_checks(spark, sf_dir):
    """All declared checks over tables with planted duplicates and NULLs."""
    m = models(spark, sf_dir)
    raw = fixtures.raw_table(fixtures.read_events(spark, sf_dir))
    marts = {
        "fct_hourly_market": _planted(m.fct_hourly_market, "hour_of_day", 3, 5, "hour_utc", "price_eur_mwh", "renewable_pct"),
        "mart_daily_summary": _planted(m.daily_summary, "day_of_week", 2, 4, "date_utc", "avg_price_eur_mwh", "renewable_pct"),
        "mart_renewables_price_impact": _planted(m.price_impact, "month", 3, 5, "date_utc", "renewable_pct"),
        "mart_technology_mix": _planted(m.technology_mix, "month", 2, 4, "month_utc"),
    }
    return quality.data_checks(_planted(raw, "geo_id", 0, 1, "indicator_id", "datetime_utc", "geo_id", "extracted_at"), marts)


def q_freshness(spark, sf_dir):
    """Source freshness of the merged table, just after the load, a day later and a week later."""
    merged = upsert.merged_table(_merge_clustered(spark, sf_dir))
    return comparable(quality.freshness(merged, as_of=list(fixtures.FRESHNESS_TIMES)))


QUERIES: dict[str, Query] = {
    "payload_explode": q_payload_explode,
    "normalise": q_normalise,
    "ingest_rejects": q_ingest_rejects,
    "duplicate_keys": q_duplicate_keys,
    "accepted": q_accepted,
    "run_status": q_run_status,
    "window_filter": q_window_filter,
    "registry_coverage": q_registry_coverage,
    "catalogue_search": q_catalogue_search,
    "refetch_overlap": q_refetch_overlap,
    "answer_status": q_answer_status,
    "accepted_answers": q_accepted_answers,
    "stored_window": q_stored_window,
    "stored_daily": q_stored_daily,
    "stored_checks": q_stored_checks,
    "upsert": q_upsert,
    "upsert_clustered": q_upsert_clustered,
    "upsert_clustered_counts": q_upsert_clustered_counts,
    "upsert_counts": q_upsert_counts,
    "upsert_versioned": q_upsert_versioned,
    "hourly_price": q_hourly_price,
    "generation_long": q_generation_long,
    "hourly_generation": q_hourly_generation,
    "hourly_market": q_hourly_market,
    "hourly_market_join": q_hourly_market_join,
    "fct_hourly_market": q_fct_hourly_market,
    "daily_summary": q_daily_summary,
    "price_impact": q_price_impact,
    "technology_mix": q_technology_mix,
    "kpis_window": q_kpis_window,
    "price_last_days": q_price_last_days,
    "mix_last_month": q_mix_last_month,
    "price_daily": q_price_daily,
    "price_heatmap": q_price_heatmap,
    "price_monthly": q_price_monthly,
    "impact_points": q_impact_points,
    "price_by_bucket": q_price_by_bucket,
    "negative_price_days": q_negative_price_days,
    "mix_monthly_pct": q_mix_monthly_pct,
    "mix_monthly_mwh": q_mix_monthly_mwh,
    "data_checks": q_data_checks,
    "freshness": q_freshness,
}
