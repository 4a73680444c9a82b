"""Ingest: normalise payload items, reject bad indicators, window, run status.

All indicators are processed in one DataFrame (no per-indicator driver loop).

``rejected_indicators`` / ``accepted`` judge a batch of one answer per indicator: a
malformed item or a duplicated key rejects every row of *that* indicator, the
others load. Where a batch holds several answers (``answer_checks``,
``with_superseded``, ``accepted_answers``) each is judged by itself, as if it had
been fetched in a run of its own: a bad answer loads nothing and fails its
indicator, unless newer good answers cover all the days that it stands for; the
good ones load, the newest value of each key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmart.functions.calendar import iso_timestamp, utc_literal
from gridmart.schemas import (
    AUTO_WINDOW_DAYS,
    DEFAULT_GEO,
    INDICATORS,
    RAW_KEYS,
    VALUE_TYPE,
    VERSION_TYPE,
)


def registry(spark: SparkSession) -> DataFrame:
    """The indicator registry as a small dimension (indicator_id, slug)."""
    schema = T.StructType(
        [T.StructField("indicator_id", T.IntegerType(), False), T.StructField("slug", T.StringType(), False)]
    )
    return spark.createDataFrame(list(INDICATORS.items()), schema)


#: Columns that say which answer an item came from; missing ones are NULL (one unnamed answer).
DOCUMENT = ("fetched_at", "document")


def item_time(items: DataFrame) -> Column:
    """The instant of a payload item: ``datetime_utc`` unless missing or empty, else ``datetime``."""
    return iso_timestamp(F.coalesce(F.nullif(F.col("datetime_utc"), F.lit("")), F.col("datetime")))


def _number(text: Column) -> tuple[Column, Column]:
    """(decimal(18,6), whether the text is not exactly such a number)."""
    text = F.trim(text)
    value, wide = text.try_cast(VALUE_TYPE), text.try_cast("decimal(38,18)")
    cut = text.rlike(r"\.\d{6}\d*[1-9]") & ~text.rlike("[eE]")
    return value, text.isNotNull() & (value.isNull() | wide.isNull() | (value != wide) | cut)


def normalise(items: DataFrame) -> DataFrame:
    """Payload items -> (indicator_id, datetime_utc, geo_id, value) + validity flags + their answer.

    * time: ``datetime_utc`` unless missing/empty, else ``datetime``; ISO-8601
      with offsets honoured, naive read as UTC (session time zone is UTC).
    * geo: missing / NULL / empty / 0 -> 0; otherwise it must be an integer.
    * value: text -> decimal(18,6); a JSON NULL stays NULL.
    * ``bad_time``: no time at all or not ISO; ``bad_value``: text present but
      not a number that decimal(18,6) holds exactly; ``bad_geo``: geo present
      but not an integer; ``bad_doc``: the item stands for a document that did
      not parse.
    * ``fetched_at``, ``document``: the answer that the item came from.
    """
    ts = item_time(items)
    value, bad_value = _number(F.col("value"))
    raw_geo = F.nullif(F.col("geo_id").cast("string"), F.lit(""))
    geo = raw_geo.try_cast("int")
    bad_doc = F.coalesce(F.col("bad_doc"), F.lit(False)) if "bad_doc" in items.columns else F.lit(False)
    named = {c: F.col(c) if c in items.columns else F.lit(None) for c in DOCUMENT}
    return items.select(
        F.col("indicator_id").try_cast("int").alias("indicator_id"),
        ts.alias("datetime_utc"),
        F.coalesce(geo, F.lit(DEFAULT_GEO)).alias("geo_id"),
        value.alias("value"),
        ts.isNull().alias("bad_time"),
        bad_value.alias("bad_value"),
        (raw_geo.isNotNull() & geo.isNull()).alias("bad_geo"),
        bad_doc.alias("bad_doc"),
        named["fetched_at"].cast("string").alias("fetched_at"),
        named["document"].cast("string").alias("document"),
    )


def duplicate_keys(staged: DataFrame) -> DataFrame:
    """Keys that occur more than once in one answer (indicator_id, datetime_utc, geo_id, copies).

    The same key in two answers is a revision, not a duplicate. One aggregation
    on the key and its answer; the partial aggregate collapses repeated keys
    map-side, so a heavily duplicated key does not skew the shuffle.
    """
    named = [c for c in DOCUMENT if c in staged.columns]
    return (
        staged.where(F.col("datetime_utc").isNotNull())
        .groupBy(*RAW_KEYS, *named)
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
        .select(*RAW_KEYS, "copies")
    )


def newest(rows: DataFrame) -> DataFrame:
    """One row per key: that of the newest answer (latest fetch, then the greater document name).

    An aggregation with map-side combine, not a sort per indicator: the number of times that
    a key was fetched does not matter.
    """
    rank = F.struct(*[F.coalesce(F.col(c), F.lit("")) for c in DOCUMENT])
    best = F.max_by(F.struct("value"), rank)
    return rows.groupBy(*RAW_KEYS).agg(best.alias("_best")).select(*RAW_KEYS, F.col("_best.value").alias("value"))


def fetch_day(fetched_at: Column) -> Column:
    """The day of the fetch (the first part of ``fetched_at``), NULL if there is none."""
    return F.split_part(fetched_at, F.lit(" "), F.lit(1)).try_cast("date")


#: Digits of a version: fetch day since 1970, microsecond of the file, hash of the document's name.
_DIGITS = (6, 17, 15)


def version_of(fetched_at: Column, document: Column) -> Column:
    """The version of an answer: grows with the fetch day, then the file time; a hash of the name parts the rest.

    ``fetched_at`` is ``<fetch date> <file time>``, either part may be missing. A number, so that
    merges aggregate it in place. NULL where neither column is known (one unnamed answer).
    """
    at = F.split_part(fetched_at, F.lit(" "), F.lit(2)).try_cast("timestamp")
    name = F.pmod(F.xxhash64(F.coalesce(document, F.lit(""))), F.lit(10 ** _DIGITS[2]))
    given = (F.unix_date(fetch_day(fetched_at)), F.unix_micros(at), name)
    digits = [F.lpad(F.greatest(F.coalesce(x, F.lit(0)), F.lit(0)).cast("string"), n, "0") for x, n in zip(given, _DIGITS, strict=True)]
    return F.when(fetched_at.isNotNull() | document.isNotNull(), F.concat(*digits).cast(VERSION_TYPE))


def version_day(version: Column) -> Column:
    """The fetch day of a version (NULL if it had none)."""
    days = F.substring(F.lpad(version.cast("string"), sum(_DIGITS), "0"), 1, _DIGITS[0]).cast("int")
    return F.when(days > 0, F.date_from_unix_date(days))


def _per_answer(normalised: DataFrame, *answer: str) -> DataFrame:
    """Checks by answer: rows, malformed items, keys that it repeats, and the span of its times."""
    per_key = normalised.groupBy(*RAW_KEYS, *answer).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("bad_time").alias("bt"),
        F.count_if("bad_value").alias("bv"),
        F.count_if("bad_geo").alias("bg"),
        F.count_if("bad_doc").alias("bd"),
    )
    return per_key.groupBy("indicator_id", *answer).agg(
        F.sum("n").alias("staged_rows"),
        F.sum("bt").alias("bad_times"),
        F.sum("bv").alias("bad_values"),
        F.sum("bg").alias("bad_geos"),
        F.sum("bd").alias("bad_docs"),
        F.count_if((F.col("n") > 1) & F.col("datetime_utc").isNotNull()).alias("duplicate_keys"),
        F.to_date(F.min("datetime_utc")).alias("first_day"),
        F.to_date(F.max("datetime_utc")).alias("last_day"),
    )


COUNTS = ("staged_rows", "bad_times", "bad_values", "bad_geos", "bad_docs", "duplicate_keys")


def answer_checks(normalised: DataFrame) -> DataFrame:
    """One row per answer: indicator_id, fetched_at, document, version, the counts, first and last day, failed.

    The batch is read once; keys are pre-aggregated map-side. The days are those
    of the answer's valid times; an answer without any stands for the automatic
    window before its fetch day (``AUTO_WINDOW_DAYS``), and for no known days if
    it has no fetch day either.
    """
    checks = _per_answer(normalised, *DOCUMENT)
    fetched = fetch_day(F.col("fetched_at"))
    return checks.select(
        "indicator_id",
        *DOCUMENT,
        version_of(F.col("fetched_at"), F.col("document")).alias("version"),
        *COUNTS,
        F.coalesce("first_day", F.date_sub(fetched, AUTO_WINDOW_DAYS)).alias("first_day"),
        F.coalesce("last_day", F.date_sub(fetched, 1)).alias("last_day"),
        failed_column().alias("failed"),
    )


def _comparable(version: str) -> Column:
    """A version to compare: an unnamed answer is older than any other."""
    return F.coalesce(F.col(version), F.lit(-1).cast(VERSION_TYPE))


def with_superseded(checks: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``answer_checks`` rows with ``superseded``: a failed answer whose every day a newer good answer covers.

    ``known`` are further answers (of earlier runs) that may cover them. Answers are taken as
    intervals of days, and what counts of a day is the newest good version that covers it: one
    maximum per (indicator, day), joined to the days of the failed answers. Neither side is
    compared pair by pair. A failed answer that stands for no known days is superseded by any newer
    good answer of its indicator.
    """
    columns = ["indicator_id", "version", "first_day", "last_day", "failed"]
    every = checks.select(columns)
    if known is not None:
        every = every.unionByName(known.select(columns))
    good = every.where(~F.col("failed")).withColumn("_v", _comparable("version"))
    days = F.explode(F.sequence("first_day", "last_day"))
    by_day = good.where(F.col("first_day").isNotNull()).select("indicator_id", days.alias("_day"), "_v")
    newest = by_day.groupBy(F.col("indicator_id").alias("_id"), "_day").agg(F.max("_v").alias("_best"))
    anyhow = good.groupBy(F.col("indicator_id").alias("_id"), F.lit(None).cast("date").alias("_day")).agg(F.max("_v").alias("_best"))
    cover = newest.unionByName(anyhow).withColumnRenamed("_day", "_cover")
    failed = checks.where("failed").select("indicator_id", "version", "first_day", "last_day").distinct()
    spans = F.coalesce(F.sequence("first_day", "last_day"), F.array(F.lit(None).cast("date")))
    each = failed.select("indicator_id", "version", F.explode(spans).alias("_day"))
    found = each.join(cover, (F.col("indicator_id") == F.col("_id")) & F.col("_day").eqNullSafe(F.col("_cover")), "left")
    covered = F.coalesce(F.col("_best") > _comparable("version"), F.lit(False))
    verdict = found.groupBy(F.col("indicator_id").alias("_id"), F.col("version").alias("_version")).agg(F.bool_and(covered).alias("_superseded"))
    same = F.col("indicator_id").eqNullSafe(F.col("_id")) & F.col("version").eqNullSafe(F.col("_version"))
    out = checks.join(verdict, same, "left")
    superseded = (F.col("failed") & F.coalesce("_superseded", F.lit(False))).alias("superseded")
    return out.select(*checks.columns, superseded)


def accepted_answers(normalised: DataFrame, checks: DataFrame) -> DataFrame:
    """Observations of the good answers of registered indicators: keys, the newest value, its version.

    Superseded or not, nothing of a failed answer loads. The anti join is on (indicator, version):
    Spark broadcasts the failed answers where they are few and joins them by key otherwise.
    """
    registered = list(INDICATORS)
    failed = checks.where("failed").select(F.col("indicator_id").alias("_id"), F.col("version").alias("_version"))
    rows = normalised.where(F.col("indicator_id").isin(registered))
    rows = rows.withColumn("version", version_of(F.col("fetched_at"), F.col("document")))
    kept = rows.join(failed, (F.col("indicator_id") == F.col("_id")) & F.col("version").eqNullSafe(F.col("_version")), "left_anti")
    return kept.groupBy(*RAW_KEYS).agg(F.max_by("value", _comparable("version")).alias("value"), F.max("version").alias("version"))


def answer_status(spark: SparkSession, checks: DataFrame) -> DataFrame:
    """Per registry indicator: its answers, how many failed, how many of those are superseded, and whether it failed.

    ``checks`` come from ``with_superseded``. The run's status is 1 when a failed answer is left,
    one with an unregistered id included.
    """
    known = F.when(F.col("indicator_id").isin(list(INDICATORS)), F.col("indicator_id"))
    counts = checks.groupBy(known.alias("indicator_id")).agg(
        F.count(F.lit(1)).alias("answers"),
        F.count_if("failed").alias("failed_answers"),
        F.count_if("superseded").alias("superseded_answers"),
    )
    named = registry(spark).withColumnRenamed("indicator_id", "id")
    left = F.col("failed_answers") > F.col("superseded_answers")
    everything = Window.partitionBy(F.lit(0))  # at most nine rows
    out = counts.join(named, F.col("indicator_id") == F.col("id"), "full_outer").select(
        F.col("id").alias("indicator_id"),
        "slug",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("answers", "failed_answers", "superseded_answers")],
        F.coalesce(left, F.lit(False)).alias("failed"),
        F.coalesce(F.max(left.cast("int")).over(everything), F.lit(0)).alias("run_status"),
    )
    return out.where(F.col("indicator_id").isNotNull())


def indicator_checks(normalised: DataFrame) -> DataFrame:
    """Per indicator: staged rows, malformed items and keys duplicated within an answer.

    The input is read once: one aggregation on the key and its answer counts
    rows and malformed items, and is rolled up to the indicator. Ids that are not
    in the registry are rolled up into one row with a NULL id: the result has at
    most one row more than the registry.
    """
    named = [c for c in DOCUMENT if c in normalised.columns]
    known = F.when(F.col("indicator_id").isin(list(INDICATORS)), F.col("indicator_id"))
    per_key = normalised.groupBy(*RAW_KEYS, *named).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("bad_time").alias("bt"),
        F.count_if("bad_value").alias("bv"),
        F.count_if("bad_geo").alias("bg"),
        F.count_if("bad_doc").alias("bd"),
    )
    return per_key.groupBy(known.alias("indicator_id")).agg(
        F.sum("n").alias("staged_rows"),
        F.sum("bt").alias("bad_times"),
        F.sum("bv").alias("bad_values"),
        F.sum("bg").alias("bad_geos"),
        F.sum("bd").alias("bad_docs"),
        F.count_if((F.col("n") > 1) & F.col("datetime_utc").isNotNull()).alias("duplicate_keys"),
    )


def failed_column() -> Column:
    """The failure rule over check rows: an indicator id that is missing or not
    in the registry, or any malformed document / time / value / geo, or any
    duplicated key."""
    known = F.col("indicator_id").isin(list(INDICATORS))
    return (
        ~F.coalesce(known, F.lit(False))
        | (F.col("bad_docs") > 0)
        | (F.col("bad_times") > 0)
        | (F.col("bad_values") > 0)
        | (F.col("bad_geos") > 0)
        | (F.col("duplicate_keys") > 0)
    )


def rejected_indicators(checks: DataFrame) -> DataFrame:
    """Indicators whose batch must not load (see ``failed_column``)."""
    return checks.where(failed_column())


def accepted(normalised: DataFrame, rejected: DataFrame) -> DataFrame:
    """Observations of the registered indicators that passed, one per key: the newest answer's.

    ``rejected`` is cut to registry ids, so it has at most eight rows and is
    broadcast: the batch is not shuffled on a handful of ids.
    """
    registered = list(INDICATORS)
    failed = rejected.where(F.col("indicator_id").isin(registered)).select("indicator_id")
    kept = normalised.where(F.col("indicator_id").isin(registered)).join(F.broadcast(failed), "indicator_id", "left_anti")
    return newest(kept)


def extraction_window(
    start: str | None = None, end: str | None = None, today: dt.date | None = None
) -> tuple[dt.datetime, dt.datetime]:
    """UTC ``[start, end)`` of a run.

    Manual when both dates (``YYYY-MM-DD``) are given: from ``start`` midnight to
    the midnight after ``end`` (end day included). Otherwise automatic: the two
    days before ``today`` (UTC), the older one as an overlap for revisions.
    """
    if start and end:
        s = dt.datetime.strptime(start, "%Y-%m-%d")
        e = dt.datetime.strptime(end, "%Y-%m-%d") + dt.timedelta(days=1)
        return s, e
    day = today or dt.datetime.now(dt.timezone.utc).date()
    midnight = dt.datetime(day.year, day.month, day.day)
    return midnight - dt.timedelta(days=AUTO_WINDOW_DAYS), midnight


def window_filter(obs: DataFrame, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """Observations with ``start <= datetime_utc < end`` (literal bounds, pushed to the scan)."""
    ts = F.col("datetime_utc")
    return obs.where((ts >= utc_literal(start)) & (ts < utc_literal(end)))


def run_status(spark: SparkSession, checks: DataFrame) -> DataFrame:
    """Per registry indicator: staged / loaded rows and whether it failed; plus the run's status.

    An indicator with no payload rows loads nothing and does not fail. The run
    status is 1 when any indicator failed, an unregistered id included: both
    come from the one evaluation of the checks (at most nine rows).
    """
    failed = checks.withColumn("failed", failed_column())
    named = registry(spark).withColumnRenamed("indicator_id", "id")
    both = failed.join(named, F.col("indicator_id") == F.col("id"), "full_outer")
    everything = Window.partitionBy(F.lit(0))
    out = both.select(
        F.col("id").alias("indicator_id"),
        "slug",
        F.coalesce("staged_rows", F.lit(0)).cast("bigint").alias("staged_rows"),
        F.when(F.col("failed"), F.lit(0)).otherwise(F.coalesce("staged_rows", F.lit(0))).cast("bigint").alias("loaded_rows"),
        F.coalesce("failed", F.lit(False)).alias("failed"),
        F.coalesce(F.max(F.col("failed").cast("int")).over(everything), F.lit(0)).cast("int").alias("run_status"),
    )
    return out.where(F.col("indicator_id").isNotNull())


def registry_coverage(spark: SparkSession, obs: DataFrame) -> DataFrame:
    """Registry indicators with their observation count and time span (0 / NULL if absent).

    The observation side is aggregated first (partial + final, one row per
    indicator) and then joined to the 8-row registry.
    """
    stats = obs.groupBy("indicator_id").agg(
        F.count(F.lit(1)).alias("observations"),
        F.count("value").alias("valued"),
        F.min("datetime_utc").alias("first_utc"),
        F.max("datetime_utc").alias("last_utc"),
    )
    return registry(spark).join(stats, "indicator_id", "left").select(
        "indicator_id",
        "slug",
        F.coalesce("observations", F.lit(0)).alias("observations"),
        F.coalesce("valued", F.lit(0)).alias("valued"),
        "first_utc",
        "last_utc",
    )
