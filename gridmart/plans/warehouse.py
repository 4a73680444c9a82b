"""End-to-end batch pipeline with storage: ingest -> upsert -> marts -> checks.

Storage layout under one root (a shared filesystem / object store path):

* ``raw/``   — the observation table, Parquet partitioned by ``obs_date``
* ``marts/<name>/`` — fct_hourly_market, mart_daily_summary,
  mart_renewables_price_impact, mart_technology_mix (Parquet)

Scale notes:

* The staged batch is written once (columnar) to the shared work folder; the
  checks and the load both read that copy, so the JSON is parsed once and the
  lineage is cut (a lost executor recomputes from the staged files).
* The upsert only reads the raw partitions (days) present in the batch, shuffles
  them and the batch once by (day, key bucket), resolves each key by an
  aggregation (no join) and rewrites only partitions that actually changed, with
  dynamic partition overwrite. Cost is O(batch days), not O(table).
* The marts are stored by month. The hourly fact depends only on raw rows of the
  same UTC day, so a run recomputes it for the changed days, and only the months
  of those days are rewritten, in this mart and in those above it (``_refresh``).
* Readers get published copies (``plans.catalog.publish``): a fresh folder, then
  one switch.
* Driver collects are limited to provably small results: per-indicator checks
  (at most one row per registry indicator) and the list of touched days.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmart.operators import ingest, marts, quality, upsert
from gridmart.operators.market import fct_hourly_market, hourly_market_from_raw
from gridmart.schemas import INDICATORS, OBSERVATION, RAW_KEYS, RAW_PARTITION, RAW_TABLE, RAW_VERSIONED, VERSION_TYPE
from gridmart.session import checkpoint_dir, ensure_utc
from gridmart.sources import payload, tables

MART_NAMES = (
    "fct_hourly_market",
    "mart_daily_summary",
    "mart_renewables_price_impact",
    "mart_technology_mix",
)


@dataclass(frozen=True)
class Layout:
    root: str

    @property
    def raw(self) -> str:
        return f"{self.root.rstrip('/')}/raw"

    def mart(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/marts/{name}"


@dataclass
class RunResult:
    status: int
    checks: list = field(default_factory=list)
    counts: list = field(default_factory=list)
    changed_days: list = field(default_factory=list)
    failed: list = field(default_factory=list)  # indicator ids (None: unregistered)


def work_folder(spark: SparkSession, tag: str) -> str:
    """A fresh folder in the shared checkpoint location for one run's staging data."""
    return f"{checkpoint_dir(spark)}/gridmart-{tag}-{uuid.uuid4().hex[:12]}"


def remove_work(spark: SparkSession, work: str) -> None:
    """Delete a run's staging folder (it only holds data already committed or abandoned)."""
    fs, jpath = tables.hadoop_fs(spark, work)
    fs.delete(jpath, True)


def stage_batch(spark: SparkSession, items: DataFrame, work: str) -> DataFrame:
    """Normalise payload items and write the staged batch (columnar, lineage cut)."""
    path = f"{work}/staged"
    ingest.normalise(items).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


# Physical order of raw rows: by day (the partition), then indicator, geo, time.
_LAYOUT = (RAW_PARTITION, "indicator_id", "geo_id", "datetime_utc")
# Rows per (day, bucket) slice of a raw write (~100 MB in memory, tens of MB of Parquet).
SLICE_ROWS = 1_000_000
_CLUSTER = [RAW_PARTITION, "_bucket"]


def _shuffle_width(spark: SparkSession) -> int:
    """The session's shuffle width; platforms may set a non-numeric value ("auto")."""
    try:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    except ValueError:
        return spark.sparkContext.defaultParallelism


def slices(per_day: dict[dt.date, int], width: int) -> tuple[dict[dt.date, int], int]:
    """(key buckets by day, tasks): one bucket per about SLICE_ROWS rows of a day, one task per so many rows of all.

    Pairs of (day, bucket) are hashed onto the tasks, at least ``width`` of them and at most one per pair:
    a task may hold several small days but never a hot day alone.
    """
    k_by_day = {d: max(1, -(-n // SLICE_ROWS)) for d, n in per_day.items()}
    return k_by_day, max(1, min(sum(k_by_day.values()), max(width, -(-sum(per_day.values()) // SLICE_ROWS))))


def _with_bucket(df: DataFrame, k_by_day: dict[dt.date, int]) -> DataFrame:
    """Adds the hash bucket of the key within its day; a day with k slices has k buckets.

    Only days with more than one slice are looked up, in a broadcast table of at most one row per
    day of the batch (days that the driver has counted already); a row costs the same for one day
    as for ten years of them.
    """
    split = [(d, k) for d, k in sorted(k_by_day.items()) if k > 1]
    if not split:
        return df.withColumn("_bucket", F.lit(0).cast("bigint"))
    slices = df.sparkSession.createDataFrame(split, "_day date, _k bigint")
    joined = df.join(F.broadcast(slices), F.col(RAW_PARTITION) == F.col("_day"), "left")
    bucket = F.pmod(F.xxhash64("indicator_id", "geo_id", "datetime_utc"), F.coalesce(F.col("_k"), F.lit(1)))
    return joined.withColumn("_bucket", bucket).drop("_day", "_k")


def _write_raw_days(rows: DataFrame, raw_path: str) -> None:
    """Replace exactly the day partitions present in ``rows`` (dynamic overwrite,
    set on the writer so a session in static mode cannot wipe other days)."""
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(RAW_PARTITION)
        .parquet(raw_path)
    )


def _typed(batch: DataFrame) -> tuple[DataFrame, Column]:
    """The batch in the raw table's types, plus a flag for rows the cast would change.

    ``try_cast`` keeps the check independent of ANSI mode, and a round trip back
    to the source type catches what a NULL check alone misses: overflow (NULL),
    truncated keys (600.7 -> 600) and rounded values (1.12345678 -> 1.123457).
    """
    cols, lossy = [], F.lit(False)
    for f in OBSERVATION.fields:
        src = F.col(f.name)
        src_type = batch.schema[f.name].dataType
        if src_type == f.dataType:
            cols.append(src.alias(f.name))
        else:
            cast = src.try_cast(f.dataType)
            cols.append(cast.alias(f.name))
            lossy = lossy | (src.isNotNull() & ~F.coalesce(cast.try_cast(src_type).eqNullSafe(src), F.lit(False)))
    return batch.select(*cols, "version", lossy.alias("_lossy")), F.col("_lossy")


def upsert_raw(
    spark: SparkSession,
    raw_path: str,
    batch: DataFrame,
    run_ts: dt.datetime,
    work: str,
    _day_counts: dict[tuple[int, dt.date], int] | None = None,
    before_write: Callable[[str, list[dt.date], list[dt.date]], None] | None = None,
) -> tuple[list[dict], list[dt.date]]:
    """Merge ``batch`` (indicator_id, datetime_utc, geo_id, value[, version]) into the raw table.

    Returns per-indicator counts (staged / inserted / updated / unchanged) and
    the days whose rows changed; an empty batch is a no-op. Days on which only
    versions moved on are rewritten too, but are not among them. A
    batch with a NULL key or a value that does not fit the table's types is
    refused (ValueError), whatever the session's ANSI setting.

    * A batch with no stored day is all inserts: written straight into the
      table, laid out by (day, key-hash bucket), no join.
    * Otherwise the stored days' partitions and the batch are merged by one
      shuffle on (day, bucket) and a per-key aggregation (no join); the plan is
      staged and only days with an insert or update are rewritten, without a
      second shuffle.

    ``_day_counts`` ((indicator, day) -> rows) is passed by ``ingest_items`` for
    a validated batch; other callers omit it and one small aggregation computes
    and validates it. ``before_write(kind, days, changed)`` is called when the
    rows of those days are complete in the work folder (kind ``merge``: its merge
    plan; ``insert``: the batch itself) and before the first partition is touched.
    """
    ensure_utc(spark)
    tables.provision_raw(spark, raw_path)
    version = F.col("version").cast(VERSION_TYPE) if "version" in batch.columns else F.lit(None).cast(VERSION_TYPE)
    typed, lossy = _typed(batch.select(*RAW_KEYS, "value", version.alias("version")))
    batch = tables.with_partition(typed)
    if _day_counts is None:
        # A caller's batch is staged once (its lineage is evaluated once, and
        # validation and the writes see the same rows), then validated.
        path = f"{work}/batch"
        batch.write.mode("overwrite").parquet(path)
        batch = spark.read.parquet(path)
        per_day = (
            batch.groupBy("indicator_id", RAW_PARTITION)
            .agg(F.count(F.lit(1)).alias("n"), F.count_if("_lossy").alias("lossy"),
                 F.count_if(F.col("geo_id").isNull()).alias("no_geo"))
            .collect()
        )  # <= indicators x days rows
        bad = [r for r in per_day if r.indicator_id is None or r[RAW_PARTITION] is None or r.lossy or r.no_geo]
        if bad:
            raise ValueError(f"batch has NULL keys or values outside the table's types: {bad[:5]}")
        dup = ingest.duplicate_keys(batch).limit(1).collect()
        if dup:
            raise ValueError(f"batch repeats a key: {dup[0].asDict()}")
        _day_counts = {(r.indicator_id, r[RAW_PARTITION]): r.n for r in per_day}
    batch = batch.drop("_lossy")
    days = sorted({d for _, d in _day_counts})
    if not days:
        return [], []
    indicators = sorted({i for i, _ in _day_counts})
    # Never write outside what was counted.
    batch = batch.where(F.col(RAW_PARTITION).isin(days) & F.col("indicator_id").isin(indicators))
    stored_days = tables.existing_days(spark, raw_path)
    merge_days = [d for d in days if d in stored_days]

    # Slices of (day, hash bucket of the key). Row counts are exact: the batch's from
    # the checks, the stored days' from a footer-level count.
    per_day: dict[dt.date, int] = {}
    for (_, d), n in _day_counts.items():
        per_day[d] = per_day.get(d, 0) + n
    if merge_days:
        stored = tables.read_raw(spark, raw_path, versions=True).where(F.col(RAW_PARTITION).isin(merge_days))
        for r in stored.groupBy(RAW_PARTITION).count().collect():
            per_day[r[RAW_PARTITION]] = per_day.get(r[RAW_PARTITION], 0) + r["count"]
    k_by_day, slots = slices(per_day, _shuffle_width(spark))

    counts: dict[int, dict] = {}

    def add(ind: int, staged: int, inserted: int = 0, updated: int = 0, unchanged: int = 0) -> None:
        c = counts.setdefault(ind, dict(indicator_id=ind, staged_rows=0, inserted=0, updated=0, unchanged=0))
        c["staged_rows"] += staged
        c["inserted"] += inserted
        c["updated"] += updated
        c["unchanged"] += unchanged

    if not merge_days:
        # Nothing stored on these days: the batch is all inserts, written
        # straight into the table (one shuffle to lay it out, no join).
        for (ind, _), n in _day_counts.items():
            add(ind, n, inserted=n)
        if before_write:
            before_write("insert", days, days)
        inserts = upsert.merged_table(upsert.insert_plan(batch.drop(RAW_PARTITION), run_ts))
        rows = _with_bucket(tables.with_partition(inserts), k_by_day).repartition(slots, *_CLUSTER)
        _write_raw_days(rows.sortWithinPartitions(*_LAYOUT).select(*RAW_VERSIONED.fieldNames(), RAW_PARTITION), raw_path)
        return [c for c in counts.values() if c["staged_rows"]], days

    # Stored days are merged (new days in the same batch come out as inserts):
    # ONE shuffle by (day, bucket) feeds a per-key aggregation, no join. The
    # plan is staged (it is built from partitions about to be overwritten), one
    # file per slot; the summary and the rewrite re-read it, and the rewrite
    # needs no further shuffle because the plan is already clustered.
    target = _with_bucket(stored, k_by_day)
    source = _with_bucket(batch, k_by_day)
    plan = upsert.merge_plan_clustered(target, source, run_ts, _CLUSTER, slots)
    plan_path = f"{work}/merge_plan"
    plan.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(plan_path)
    plan = spark.read.schema(plan.schema).parquet(plan_path)
    summary = (
        plan.groupBy("indicator_id", RAW_PARTITION)
        .agg(
            F.count_if("staged").alias("staged_rows"),
            F.count_if(F.col("op") == upsert.INSERT).alias("inserted"),
            F.count_if(F.col("op") == upsert.UPDATE).alias("updated"),
            F.count_if(F.col("staged") & F.col("op").isin(upsert.KEEP, upsert.TOUCH)).alias("unchanged"),
            F.count_if(F.col("op") == upsert.TOUCH).alias("touched"),
        )
        .collect()
    )  # <= indicators x days rows
    for r in summary:
        add(r.indicator_id, r.staged_rows, r.inserted, r.updated, r.unchanged)
    changed = sorted({r[RAW_PARTITION] for r in summary if r.inserted or r.updated})
    rewritten = sorted({r[RAW_PARTITION] for r in summary if r.inserted or r.updated or r.touched})
    if rewritten:
        if before_write:
            before_write("merge", rewritten, changed)
        rows = plan.where(F.col(RAW_PARTITION).isin(rewritten))
        _write_raw_days(rows.sortWithinPartitions(*_LAYOUT).select(*RAW_VERSIONED.fieldNames(), RAW_PARTITION), raw_path)
    return [c for c in counts.values() if c["staged_rows"]], changed


def _pending_path(layout: Layout) -> str:
    return f"{layout.root.rstrip('/')}/_pending_days"


def pending_days(spark: SparkSession, layout: Layout) -> list[dt.date]:
    """Days loaded into raw whose marts have not been refreshed yet."""
    path = _pending_path(layout)
    if not tables.raw_exists(spark, f"{path}/_SUCCESS"):
        return []
    return sorted(r.day for r in spark.read.schema("day date").parquet(path).collect())


def _set_pending(spark: SparkSession, layout: Layout, days: list[dt.date]) -> None:
    rows = spark.createDataFrame([(d,) for d in sorted(set(days))], "day date")
    rows.coalesce(1).write.mode("overwrite").parquet(_pending_path(layout))


def add_pending_days(spark: SparkSession, layout: Layout, days: list[dt.date]) -> None:
    """Record days whose raw partitions changed; the next mart refresh picks them up
    even if this run's refresh fails or is skipped (a small list: days, not rows)."""
    if days:
        _set_pending(spark, layout, pending_days(spark, layout) + list(days))


def _complete(spark: SparkSession, path: str) -> bool:
    """A table written to completion (Spark's job commit leaves ``_SUCCESS``)."""
    return tables.raw_exists(spark, f"{path}/_SUCCESS")


def _refreshed_path(layout: Layout) -> str:
    return f"{layout.root.rstrip('/')}/_refreshed"


def last_refresh(spark: SparkSession, layout: Layout) -> str | None:
    """A name for the content of the marts: another one after every refresh that changed them."""
    return tables.read_text(spark, _refreshed_path(layout))


def refresh_marts(
    spark: SparkSession, layout: Layout, days: list[dt.date] | None = None, work: str | None = None
) -> dict[str, DataFrame]:
    """Rebuild the marts; with ``days``, only the months of those days.

    Days recorded as pending by earlier loads are added to ``days`` (and ``days``
    are recorded as pending until the end), and a mart that is missing or was not
    written to completion is rebuilt in full, so a refresh that failed or was
    skipped is repaired by the next one.
    """
    ensure_utc(spark)
    tables.provision_raw(spark, layout.raw)  # a build before any load gives empty marts
    own_work = work is None
    work = work or work_folder(spark, "marts")
    pending = pending_days(spark, layout)
    if days is not None:
        if set(days) - set(pending):
            add_pending_days(spark, layout, days)
        days = sorted(set(days) | set(pending))
    try:
        out = _refresh(spark, layout, days, work)
        if days is None or days or last_refresh(spark, layout) is None:
            tables.replace_text(spark, _refreshed_path(layout), uuid.uuid4().hex)
        if pending or days:
            _set_pending(spark, layout, [])
        return out
    finally:
        if own_work and not _unfinished_months(spark, layout, work):
            remove_work(spark, work)


#: The marts are stored by month: UTC months, the hourly fact by the local month that its own columns hold.
MONTH = ("year", "month")
Month = tuple[int, int]


def _month_of(day: dt.date) -> Month:
    return day.year, day.month


def _in_months(months: set[Month]) -> Column:
    """A predicate on the partition columns alone."""
    return (F.col("year") * 12 + F.col("month")).isin(sorted(12 * y + m for y, m in months))


def stored_months(spark: SparkSession, path: str) -> set[Month]:
    """Months that have a folder (directory names only)."""
    if not tables.raw_exists(spark, path):
        return set()
    fs, jpath = tables.hadoop_fs(spark, path)
    out = set()
    for year in fs.listStatus(jpath):
        if year.isDirectory() and (name := year.getPath().getName()).startswith("year="):
            for month in fs.listStatus(year.getPath()):
                if month.getPath().getName().startswith("month="):
                    out.add((int(name[5:]), int(month.getPath().getName()[6:])))
    return out


def _checks_path(layout: Layout, model: str) -> str:
    return f"{layout.root.rstrip('/')}/_checks/{model}"


def observed_checks(spark: SparkSession, layout: Layout, model: str) -> dict[str, int] | None:
    """Failures of a model's checks as its writes have measured them; None where they are not known."""
    text = tables.read_text(spark, _checks_path(layout, model))
    return json.loads(text) if text else None


def _keep_checks(spark: SparkSession, layout: Layout, model: str, found: dict[str, int], whole: bool) -> None:
    """What a write has measured: of the whole table, or of the parts that it has replaced.

    The failures of replaced parts are not known by themselves. Where the table had none, what the
    write has found is all there is; where it had some, they are unknown from then on, and the next
    report counts them (and keeps the counts).
    """
    before = {} if whole else observed_checks(spark, layout, model)
    clean = before is not None and not any(before.values())
    tables.replace_text(spark, _checks_path(layout, model), json.dumps(found) if clean else "")


def write_months(df: DataFrame, path: str, mode: str) -> dict[str, int]:
    """One folder and file a month; a mart without rows is one empty file (a readable table still).

    Returns the failures of the mart's declared checks among the rows written, measured by the write.
    """
    placed, watch = quality.observed(df.repartition(*MONTH), path.rstrip("/").rsplit("/", 1)[1], MONTH)
    placed.write.mode(mode).option("partitionOverwriteMode", "static").partitionBy(*MONTH).parquet(path)
    if not stored_months(df.sparkSession, path):
        empty = df.sparkSession.createDataFrame([], df.schema)
        empty.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return watch.get


def put_months(df: DataFrame, path: str, months: set[Month]) -> dict[str, int]:
    """``df`` holds the whole content of ``months``: their folders are replaced, the others are not touched.

    ``df`` must not read from ``path``. A month that has no rows any more loses its folder.
    """
    fs, _ = tables.hadoop_fs(df.sparkSession, path)
    for year, month in sorted(months & stored_months(df.sparkSession, path)):
        fs.delete(tables.hadoop_fs(df.sparkSession, f"{path}/year={year}/month={month}")[1], True)
    return write_months(df, path, "append")


_SCHEMAS: dict[str, T.StructType] = {}


def mart_models(raw: DataFrame) -> dict[str, DataFrame]:
    """The four marts of a raw table, unordered."""
    fct = fct_hourly_market(hourly_market_from_raw(raw.select(*RAW_KEYS, "value")))
    daily = marts.daily_summary(fct)
    return dict(zip(MART_NAMES, (fct, daily, marts.price_impact(daily), marts.technology_mix(daily, ordered=False)), strict=True))


def read_mart(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    """A stored mart; predicates on year and month read their folders only."""
    if not _SCHEMAS:
        _SCHEMAS.update({n: df.schema for n, df in mart_models(spark.createDataFrame([], RAW_TABLE)).items()})
    return spark.read.schema(_SCHEMAS[name]).parquet(layout.mart(name)).select(_SCHEMAS[name].fieldNames())


def _months_path(layout: Layout) -> str:
    return f"{layout.root.rstrip('/')}/_unfinished_months"


def _unfinished_months(spark: SparkSession, layout: Layout, work: str | None = None) -> list:
    """Months of the fact that a refresh had begun to replace (rows year, month, work)."""
    if not _complete(spark, _months_path(layout)):
        return []
    rows = spark.read.schema("year int, month int, work string").parquet(_months_path(layout)).collect()  # one a month
    return [r for r in rows if work is None or r.work == work]


def _finish_months(spark: SparkSession, layout: Layout) -> None:
    """Put the fact's staged months in place: now, or after a run that died while it did."""
    if rows := _unfinished_months(spark, layout):
        staged = spark.read.schema(read_mart(spark, layout, MART_NAMES[0]).schema).parquet(f"{rows[0].work}/fct_hourly_market")
        found = put_months(staged, layout.mart("fct_hourly_market"), {(r.year, r.month) for r in rows})
        _keep_checks(spark, layout, "fct_hourly_market", found, False)
        remove_work(spark, _months_path(layout))


def _refresh(spark: SparkSession, layout: Layout, days: list[dt.date] | None, work: str) -> dict[str, DataFrame]:
    """Hours, then days, then months: each level is the mergeable state of the next, and only changed months move.

    The hourly fact of a UTC day depends on that day's raw partition alone, so only changed days are computed
    anew; their months are staged with the unchanged days of the stored fact and put in place. Daily and impact
    rows of a month come from its hours, a row of the monthly mix from its days.
    """
    _finish_months(spark, layout)
    paths = {n: layout.mart(n) for n in MART_NAMES}
    usable = {n: _complete(spark, p) and bool(stored_months(spark, p)) for n, p in paths.items()}
    read = lambda n: read_mart(spark, layout, n)
    if days == [] and all(_complete(spark, p) for p in paths.values()):
        return {n: read(n) for n in MART_NAMES}
    raw = tables.read_raw(spark, layout.raw)
    fct_name, daily_name, impact_name, mix_name = MART_NAMES
    months: set[Month] | None = None
    if days is None or not usable[fct_name]:
        _keep_checks(spark, layout, fct_name, write_months(mart_models(raw)[fct_name], paths[fct_name], "overwrite"), True)
    else:
        months = {_month_of(d) for d in days}
        if days:
            # A UTC day's hours lie in its own local month or, at the end of one, in the next.
            local = months | {_month_of(d + dt.timedelta(days=1)) for d in days}
            fresh = mart_models(raw.where(F.col(RAW_PARTITION).isin(days)))[fct_name]
            kept = read(fct_name).where(_in_months(local) & ~F.col("date_utc").isin(days))
            staged = f"{work}/fct_hourly_market"
            kept.unionByName(fresh).repartition(*MONTH).write.mode("overwrite").parquet(staged)
            marks = spark.createDataFrame([(y, m, work) for y, m in sorted(local)], "year int, month int, work string")
            marks.coalesce(1).write.mode("overwrite").parquet(_months_path(layout))
            _finish_months(spark, layout)

    following = lambda wanted: wanted | {(y + m // 12, m % 12 + 1) for y, m in wanted}

    def put(name: str, of: str, model: Callable[[DataFrame], DataFrame], source_months: Callable[[set[Month]], set[Month]]) -> None:
        if months is None or not usable[name]:
            _keep_checks(spark, layout, name, write_months(model(read(of)), paths[name], "overwrite"), True)
        elif months:
            source = read(of).where(_in_months(source_months(months)))
            own = F.col("date_utc")
            source = source.where((F.year(own) * 12 + F.month(own)).isin(sorted(12 * y + m for y, m in months)))
            _keep_checks(spark, layout, name, put_months(model(source), paths[name], months), False)

    put(daily_name, fct_name, marts.daily_summary, following)
    put(impact_name, daily_name, marts.price_impact, lambda m: m)
    put(mix_name, daily_name, lambda daily: marts.technology_mix(daily, ordered=False), lambda m: m)
    return {n: read(n) for n in MART_NAMES}


def _unfinished_path(layout: Layout) -> str:
    return f"{layout.root.rstrip('/')}/_unfinished_write"


_UNFINISHED = "work string, kind string, run_ts timestamp, day date"


def finish_write(spark: SparkSession, layout: Layout) -> list[dt.date]:
    """Complete a raw write that an earlier run began and did not end.

    That run's folder still holds the whole content of the days it was replacing (the merge plan, or the
    batch where the days were new), so they are written once more from there: the same rows, whatever
    part of them had been committed. Returns the days.
    """
    path = _unfinished_path(layout)
    if not tables.raw_exists(spark, f"{path}/_SUCCESS"):
        return []
    marks = spark.read.schema(_UNFINISHED).parquet(path).collect()  # one row per changed day
    if marks:
        work, kind, days = marks[0].work, marks[0].kind, [m.day for m in marks]
        if kind == "merge":
            rows = spark.read.parquet(f"{work}/merge_plan").where(F.col(RAW_PARTITION).isin(days))
        else:
            batch = spark.read.parquet(f"{work}/newest")
            inserts = upsert.merged_table(upsert.insert_plan(batch, F.lit(marks[0].run_ts.replace(tzinfo=dt.timezone.utc))))
            rows = tables.with_partition(inserts).where(F.col(RAW_PARTITION).isin(days)).repartition(*_LAYOUT[:2])
        _write_raw_days(rows.sortWithinPartitions(*_LAYOUT).select(*RAW_VERSIONED.fieldNames(), RAW_PARTITION), layout.raw)
        remove_work(spark, path)
        remove_work(spark, work)
        return sorted(days)
    remove_work(spark, path)
    return []


def _answers_path(layout: Layout) -> str:
    return f"{layout.root.rstrip('/')}/_answers"


_ANSWERS = "indicator_id int, version decimal(38,0), document string, fetched_at string, first_day date, last_day date, failed boolean, staged_rows long"


def known_answers(spark: SparkSession, layout: Layout) -> DataFrame:
    """Every answer that was loaded or rejected so far (one row each, not one per item)."""
    path = _answers_path(layout)
    if not tables.raw_exists(spark, path):
        return spark.createDataFrame([], _ANSWERS)
    return spark.read.schema(_ANSWERS).parquet(path).dropDuplicates(["indicator_id", "version"])


def open_failures(spark: SparkSession, layout: Layout) -> DataFrame:
    """Failed answers whose days no newer good answer covers: the same whatever order they came in."""
    return ingest.with_superseded(known_answers(spark, layout)).where(F.col("failed") & ~F.col("superseded"))


def _log_answers(spark: SparkSession, layout: Layout, checks: DataFrame) -> None:
    """Adds this run's answers to the known ones (unnamed answers cannot be told apart and are not kept)."""
    fields = [f.strip().split()[0] for f in _ANSWERS.replace("decimal(38,0)", "decimal").split(",")]
    named = checks.where(F.col("version").isNotNull()).select(fields)
    old = known_answers(spark, layout).select(F.col("indicator_id").alias("_id"), F.col("version").alias("_version"))
    new = named.join(old, F.col("indicator_id").eqNullSafe(F.col("_id")) & (F.col("version") == F.col("_version")), "left_anti")
    new.coalesce(1).write.mode("append").parquet(_answers_path(layout))


def ingest_items(
    spark: SparkSession,
    items: DataFrame,
    layout: Layout,
    run_ts: dt.datetime | None = None,
    keep_work: bool = False,
    quarantine: str | None = None,
) -> RunResult:
    """Stage, validate and upsert a batch of payload items; answers fail independently.

    An answer fails on any malformed item or key that it repeats, and so do answers
    whose indicator id is missing or not registered (``ingest.failed_column``); nothing
    of it loads. It fails its indicator unless newer good answers, of this batch or of
    earlier ones, cover its days (``ingest.with_superseded``). Of the good answers that
    hold a key, the newest counts, over batches too: rows carry the version of their
    answer. With ``quarantine`` the items of failed answers are kept there as they came.

    Before the first raw partition is replaced, the days are recorded as pending
    for the mart refresh and the write as unfinished; a run that dies in between
    keeps its folder, and the next one completes the write first (``finish_write``).
    The folder is removed after success, and after a failure that had not begun
    to write, unless ``keep_work``.
    """
    ensure_utc(spark)
    finished = finish_write(spark, layout)
    run_ts = run_ts or dt.datetime.now(dt.timezone.utc)
    work = work_folder(spark, "ingest")
    begun = False

    def before_write(kind: str, days: list[dt.date], changed: list[dt.date]) -> None:
        nonlocal begun
        add_pending_days(spark, layout, changed)
        at = run_ts if run_ts.tzinfo else run_ts.replace(tzinfo=dt.timezone.utc)
        marks = spark.createDataFrame([(work, kind, at, d) for d in days], _UNFINISHED)
        marks.coalesce(1).write.mode("overwrite").parquet(_unfinished_path(layout))
        begun = True

    try:
        staged = stage_batch(spark, items, work)
        judged = ingest.answer_checks(staged)
        judged.write.mode("overwrite").parquet(f"{work}/answers")
        judged = spark.read.schema(judged.schema).parquet(f"{work}/answers")
        weighed = ingest.with_superseded(judged, known_answers(spark, layout))
        known = F.when(F.col("indicator_id").isin(list(INDICATORS)), F.col("indicator_id"))
        checks = weighed.groupBy(known.alias("indicator_id")).agg(
            *[F.sum(c).alias(c) for c in ingest.COUNTS],
            F.count_if("failed").alias("failed_answers"),
            F.bool_or(F.col("failed") & ~F.col("superseded")).alias("failed"),
        ).collect()  # <= 9 rows
        if quarantine and any(r.failed_answers for r in checks):
            failed = judged.where("failed").select(*[F.col(c).alias(f"_{c}") for c in ("indicator_id", *ingest.DOCUMENT)])
            answer = [F.col(c) if c in items.columns else F.lit(None).cast("string") for c in ingest.DOCUMENT]
            same = F.col("indicator_id").try_cast("int").eqNullSafe(F.col("_indicator_id"))
            for own, other in zip(answer, ingest.DOCUMENT, strict=True):
                same = same & own.eqNullSafe(F.col(f"_{other}"))
            items.join(failed, same, "left_semi").write.mode("overwrite").parquet(quarantine)
        batch = ingest.accepted_answers(staged, judged)
        batch.write.mode("overwrite").parquet(f"{work}/newest")
        batch = spark.read.schema(batch.schema).parquet(f"{work}/newest")
        per_day = tables.with_partition(batch).groupBy("indicator_id", RAW_PARTITION).count().collect()  # <= indicators x days
        day_counts = {(r.indicator_id, r[RAW_PARTITION]): r["count"] for r in per_day}
        counts, changed = upsert_raw(spark, layout.raw, batch, run_ts, work, day_counts, before_write)
        _log_answers(spark, layout, judged)
    except BaseException:
        if not (begun or keep_work):
            remove_work(spark, work)
        raise
    if begun:
        remove_work(spark, _unfinished_path(layout))
    if not keep_work:
        remove_work(spark, work)
    return RunResult(
        status=1 if any(r.failed for r in checks) else 0,
        checks=[{k: v for k, v in r.asDict().items() if k != "failed"} for r in checks],
        counts=counts,
        changed_days=sorted({*changed, *finished}),
        failed=[r.indicator_id for r in checks if r.failed],
    )


def run(
    spark: SparkSession,
    landing_path: str,
    root: str,
    run_ts: dt.datetime | None = None,
    full_refresh: bool = False,
    multiline: bool = True,
) -> RunResult:
    """Daily run: landed payloads -> raw upsert -> marts (incremental unless ``full_refresh``)."""
    layout = Layout(root)
    work = work_folder(spark, "landing")
    try:
        items = payload.read_items(spark, landing_path, multiline, work=work)
        result = ingest_items(spark, items, layout, run_ts)
    finally:
        remove_work(spark, work)
    refresh_marts(spark, layout, None if full_refresh else result.changed_days)
    return result


def checks_report(spark: SparkSession, layout: Layout, as_of: dt.datetime | None = None) -> tuple[DataFrame, DataFrame]:
    """Declared data tests over the stored tables and the source freshness.

    The tests of the marts are those that their writes have measured; a mart whose failures are not known
    (``_keep_checks``) is read, and the raw table always is, together with its freshness.
    """
    raw = tables.read_raw(spark, layout.raw)
    known, out = {n: observed_checks(spark, layout, n) for n in MART_NAMES}, quality.model_checks(raw, quality.SOURCE, quality.SOURCE_NOT_NULL)
    for name in MART_NAMES:
        if known[name] is None:
            rows = quality.model_checks(read_mart(spark, layout, name), name, *quality._tests_of(name)).collect()  # one a test
            known[name] = {f"{r.column_name} {r.test_name}": r.failures for r in rows}
            tables.replace_text(spark, _checks_path(layout, name), json.dumps(known[name]))
    return out.unionByName(quality.check_rows(spark, known)), quality.freshness(raw, as_of)
