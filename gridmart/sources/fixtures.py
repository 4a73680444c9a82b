"""Observation fixtures derived from the shared test tables.

The test tables carry no market data, so a fixed mapping turns every row of
``events`` into one observation of the long raw table: the indicator cycles over
all eight registry ids, instants are spread over twelve 30-day shifts of January
(both clock changes fall inside), one row in five is geography 1 (the rest
Spain), one in 37 is NULL and the price indicator is shifted down by 20 so
negative prices occur. Every events row is used; the work grows with the table.

The same mapping, written in DuckDB SQL, is in ``gridmart.plans.oracle``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.functions.calendar import utc_literal
from gridmart.schemas import INDICATORS, VALUE_TYPE

# Fixed run timestamps used by the ingest/upsert fixtures (deterministic audit columns).
FIRST_LOAD_TS = dt.datetime(2025, 1, 2, 6, 15, 0)
REVISION_TS = dt.datetime(2025, 1, 3, 6, 15, 0)
FRESHNESS_TIMES = (dt.datetime(2025, 1, 3, 7, 0, 0), dt.datetime(2025, 1, 5, 6, 15, 0), dt.datetime(2025, 1, 10, 6, 15, 0))


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def _indicator_of(event_id: Column) -> Column:
    ids = F.array(*[F.lit(i) for i in INDICATORS])
    return F.element_at(ids, (event_id % 8).cast("int") + 1)


def observations_with_id(events: DataFrame) -> DataFrame:
    """events -> (event_id, indicator_id, datetime_utc, geo_id, value)."""
    eid = F.col("event_id")
    shift_days = (F.lit(30) * (F.expr("event_id div 8") % 12)).cast("int")
    base = F.col("value").cast(VALUE_TYPE)
    value = (
        F.when(eid % 37 == 0, F.lit(None).cast(VALUE_TYPE))
        .when(eid % 8 == 0, base - F.lit(20))
        .otherwise(base)
        .cast(VALUE_TYPE)
    )
    return events.select(
        eid.alias("event_id"),
        _indicator_of(eid).alias("indicator_id"),
        (F.col("ts").cast("timestamp") + F.make_dt_interval(days=shift_days)).alias("datetime_utc"),
        F.when(eid % 5 == 0, F.lit(1)).otherwise(F.lit(3)).alias("geo_id"),
        value.alias("value"),
    )


def observations(events: DataFrame) -> DataFrame:
    """events -> long observations (indicator_id, datetime_utc, geo_id, value)."""
    return observations_with_id(events).drop("event_id")


def load_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(read_events(spark, sf_dir))


def raw_table(events: DataFrame) -> DataFrame:
    """The observation fixture as a loaded raw table (audit columns = first load)."""
    first = utc_literal(FIRST_LOAD_TS)
    return observations(events).withColumn("extracted_at", first).withColumn("updated_at", first)


# --- ingest fixture: observations rendered as landed payload documents --------
#
# Every observation becomes one payload item. Deterministic variations exercise
# the normalisation rules: one item in six carries only a naive ``datetime``
# (empty ``datetime_utc``), one in six an explicit "+00:00" offset, one in six
# the basic form, one in nine no geo_id. Three indicators are corrupted so they
# must be rejected whole: 10004 gets values that are no numbers or have seven
# decimals, 2051 times that are not ISO 8601, 2040 duplicated keys.

BAD_TIMES = ("not-a-date", "12:34", "2024", "T10:00", "2024-01-01T10:00:00 Europe/Madrid", "2024-1-1")
_ISO_BASIC = "yyyyMMdd'T'HHmmss.SSSSSS'Z'"
_ISO_Z = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
_ISO_OFFSET = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"
_ISO_NAIVE = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
DOC_CHUNK = 64  # items per landed document (bounded group size)


def payload_items(events: DataFrame) -> DataFrame:
    """(event_id, indicator_id, value, datetime, datetime_utc, geo_id) as the API would send them."""
    o = observations_with_id(events)
    eid, ind, ts = F.col("event_id"), F.col("indicator_id"), F.col("datetime_utc")
    value = (
        F.when((ind == 10004) & (eid % 101 == 0) & (eid % 3 == 0), F.lit("n/a"))
        .when((ind == 10004) & (eid % 101 == 0), F.concat(F.col("value").cast("string"), F.lit("1")))  # seven decimals
        .otherwise(F.col("value").cast("string"))
    )
    dt_utc = (
        F.when((ind == 2051) & (eid % 103 == 0), F.element_at(F.lit(list(BAD_TIMES)), (eid % len(BAD_TIMES)).cast("int") + 1))
        .when(eid % 6 == 0, F.lit(""))
        .when(eid % 6 == 2, F.date_format(ts, _ISO_BASIC))
        .when(eid % 6 == 1, F.date_format(ts, _ISO_OFFSET))
        .otherwise(F.date_format(ts, _ISO_Z))
    )
    naive = F.when(eid % 6 == 0, F.date_format(ts, _ISO_NAIVE))
    geo = F.when(eid % 9 != 0, F.col("geo_id"))
    items = o.select(
        "event_id",
        "indicator_id",
        value.alias("value"),
        naive.alias("datetime"),
        dt_utc.alias("datetime_utc"),
        geo.alias("geo_id"),
    )
    dups = o.where((ind == 2040) & (eid % 89 == 0)).select(
        "event_id",
        "indicator_id",
        (F.col("value") + F.lit(1)).cast("string").alias("value"),
        F.lit(None).cast("string").alias("datetime"),
        F.date_format(ts, _ISO_Z).alias("datetime_utc"),
        geo.alias("geo_id"),
    )
    return items.unionByName(dups)


def payload_documents(events: DataFrame) -> DataFrame:
    """Items grouped into JSON documents of at most ``DOC_CHUNK`` events per indicator.

    Output: (indicator_id, payload) — ``payload`` is the API's JSON text.
    """
    items = payload_items(events)
    item = F.struct("value", "datetime", "datetime_utc", "geo_id")
    doc = F.struct(F.struct(F.collect_list(item).alias("values")).alias("indicator"))
    return items.groupBy("indicator_id", F.expr(f"event_id div {DOC_CHUNK}").alias("chunk")).agg(
        F.to_json(doc).alias("payload")
    ).drop("chunk")


# --- re-fetch fixture ------------------------------------------------------------
#
# Two answers per indicator: the first holds every observation, the second (fetched a
# day later) a third of them revised, one in eleven to NULL, and new keys. One
# indicator repeats keys inside its second answer and must be rejected.


def refetched_items(events: DataFrame) -> DataFrame:
    o = observations_with_id(events)
    eid, ts = F.col("event_id"), F.col("datetime_utc")
    text = F.col("value").cast("string")
    revised = F.when(eid % 11 != 0, (F.coalesce("value", F.lit(0).cast(VALUE_TYPE)) + F.lit(1)).cast(VALUE_TYPE).cast("string"))

    def answer(rows, value, at, document, fetched_at):
        return rows.select(
            "indicator_id", value.alias("value"), F.lit(None).cast("string").alias("datetime"),
            F.date_format(at, _ISO_Z).alias("datetime_utc"), "geo_id", F.lit(False).alias("bad_doc"),
            F.lit(fetched_at).alias("fetched_at"), F.lit(document).alias("document"),
        )

    later = ("b", "2025-01-03")
    again = o.where(eid % 3 == 0)
    return (
        answer(o, text, ts, "a", "2025-01-02")
        .unionByName(answer(again, revised, ts, *later))
        .unionByName(answer(o.where((eid % 3 == 1) & (eid % 5 == 2)), text, ts + F.make_dt_interval(days=F.lit(400)), *later))
        .unionByName(answer(again.where((F.col("indicator_id") == 2040) & (eid % 29 == 0)), text, ts, *later))
    )


# --- answers fixture ---------------------------------------------------------------
#
# Three answers per indicator, a to c, fetched a day apart: a holds every observation, b a third of
# them revised, c (of two indicators only) new values. Bad answers: a of 2040 repeats keys, and c
# covers all its days; a of 2051 holds a text for a value, and c covers the days before July only;
# b of 2041 repeats keys, and nothing newer covers it.


def _answer(rows: DataFrame, value: Column, document: str, fetched_at: str) -> DataFrame:
    return rows.select(
        "indicator_id", value.alias("value"), F.lit(None).cast("string").alias("datetime"),
        F.date_format("datetime_utc", _ISO_Z).alias("datetime_utc"), "geo_id", F.lit(False).alias("bad_doc"),
        F.lit(fetched_at).alias("fetched_at"), F.lit(document).alias("document"),
    )


def answers(events: DataFrame) -> DataFrame:
    """Payload items of several answers per indicator, some of them bad."""
    o = observations_with_id(events)
    eid, ind, text = F.col("event_id"), F.col("indicator_id"), F.col("value").cast("string")
    plus = lambda n: (F.coalesce("value", F.lit(0).cast(VALUE_TYPE)) + F.lit(n)).cast(VALUE_TYPE).cast("string")
    first, again = ("a", "2025-01-02 2025-01-02T05:00:00.000000"), ("b", "2025-01-03 2025-01-03T05:00:00.000000")
    last = ("c", "2025-01-04 2025-01-01T05:00:00.000000")  # landed with an earlier file time
    a_value = F.when((ind == 2051) & (eid % 31 == 7), F.lit("n/a")).otherwise(text)
    c_rows = o.where((ind == 2040) | ((ind == 2051) & (F.col("datetime_utc") < F.lit(dt.datetime(2024, 7, 1)))))
    return (
        _answer(o, a_value, *first)
        .unionByName(_answer(o.where((ind == 2040) & (eid % 29 == 2)), text, *first))
        .unionByName(_answer(o.where(eid % 3 == 0), F.when(eid % 11 != 0, plus(1)), *again))
        .unionByName(_answer(o.where((ind == 2041) & (eid % 3 == 0) & (eid % 29 == 3)), text, *again))
        .unionByName(_answer(c_rows, plus(2), *last))
    )


#: Versions fixture: (document, fetch day, every how many observations it holds, what it adds to their values).
VERSIONS = (("a", "2025-01-02", 1, 0), ("b", "2025-01-03", 2, 1), ("c", "2025-01-04", 3, 1), ("d", "2025-01-05", 5, 0))
#: The order in which they arrive, and in how many batches.
ARRIVALS = (("c",), ("a", "d"), ("b",))


def versioned_batch(events: DataFrame, documents: tuple[str, ...]) -> DataFrame:
    """Observations of some of the answers, each with its version (not merged)."""
    o = observations_with_id(events)
    out = None
    for document, day, every, more in VERSIONS:
        if document in documents:
            value = F.when(F.col("event_id") % 13 != every, F.col("value") + F.lit(more)).cast(VALUE_TYPE)
            rows = o.where(F.col("event_id") % every == 0).select(
                "indicator_id", "datetime_utc", "geo_id", value.alias("value"), F.lit(day).alias("fetched_at"), F.lit(document).alias("document")
            )
            out = rows if out is None else out.unionByName(rows)
    return out


# --- catalogue fixture ---------------------------------------------------------


def catalogue_documents(events: DataFrame) -> DataFrame:
    """Catalogue JSON documents whose entries come from events (id, "<type> <user> <props>").

    One entry in thirteen has no name. Documents hold at most ``DOC_CHUNK`` entries.
    """
    eid = F.col("event_id")
    name = F.when(eid % 13 != 0, F.concat_ws(" ", "event_type", F.col("user_id").cast("string"), "props"))
    entries = events.select(eid.alias("id"), name.alias("name"), eid)
    doc = F.struct(F.collect_list(F.struct("id", "name")).alias("indicators"))
    return entries.groupBy(F.expr(f"event_id div {DOC_CHUNK}")).agg(F.to_json(doc).alias("payload")).select(
        "payload"
    )


# --- upsert fixture --------------------------------------------------------------
#
# Target = the raw table after a first load (two thirds of the observations);
# source = a revised batch overlapping it: new keys, untouched target keys,
# changed values, value -> NULL, NULL -> value and unchanged values.


def upsert_target(events: DataFrame) -> DataFrame:
    first = utc_literal(FIRST_LOAD_TS)
    return (
        observations_with_id(events)
        .where(F.col("event_id") % 3 != 0)
        .select("indicator_id", "datetime_utc", "geo_id", "value",
                first.alias("extracted_at"), first.alias("updated_at"))
    )


def upsert_source(events: DataFrame) -> DataFrame:
    o = observations_with_id(events).where(F.col("event_id") % 3 != 1)
    eid, v = F.col("event_id"), F.col("value")
    revised = (
        F.when(eid % 11 == 0, F.lit(None).cast(VALUE_TYPE))
        .when(v.isNull(), F.lit(1.5).cast(VALUE_TYPE))
        .when(eid % 7 == 0, v + F.lit(1))
        .otherwise(v)
        .cast(VALUE_TYPE)
    )
    return o.select("indicator_id", "datetime_utc", "geo_id", revised.alias("value"))
