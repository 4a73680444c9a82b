"""Revision-aware upsert of a staged batch into the raw observation table.

Semantics (matched on indicator_id, datetime_utc, geo_id):

* key only in the batch           -> insert (extracted_at = updated_at = run_ts)
* key in both, value distinct     -> update value (NULL overwrites a value and
                                     vice versa), updated_at = run_ts,
                                     extracted_at unchanged
* key in both, same value         -> keep the target row untouched
* key only in the target          -> keep (never delete)

Rows may carry the version of the answer that they come from (a number that
grows with the fetch, ``ingest.version_of``). The newest version wins, whatever the
order in which batches arrive: a batch row older than the stored one is kept
out, and a newer one with the same value moves the version on (``touch``: the
value, ``updated_at`` and so the marts stay as they are), so that an answer in
between cannot overwrite it later. Without a version on either side a batch row
is taken as the newer one.

``merge_plan`` is the pure DataFrame form: a full outer join on the keys with
presence markers (so a NULL source value is distinguishable from "no source
row") and a null-safe comparison. The I/O form that restricts the target to the
batch's partitions and rewrites only changed partitions lives in
``gridmart.plans.warehouse``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.functions.calendar import utc_literal
from gridmart.schemas import RAW_KEYS, VERSION_TYPE

INSERT, UPDATE, TOUCH, KEEP = "insert", "update", "touch", "keep"
VERSION = "version"


def _ts(run_ts: dt.datetime | Column) -> Column:
    return run_ts if isinstance(run_ts, Column) else utc_literal(run_ts)


def _resolved(t_in: Column, s_in: Column, t_value: Column, s_value: Column,
              t_extracted: Column, t_updated: Column, now: Column,
              versions: tuple[Column, Column] | None = None) -> list[Column]:
    """value / extracted_at / updated_at / [version /] op / staged of one key, from both sides."""
    wins, later, version = s_in, F.lit(False), []
    if versions:
        t_version, s_version = versions
        wins = s_in & (~t_in | F.coalesce(s_version >= t_version, F.lit(True)))
        later = wins & F.coalesce(s_version > F.coalesce(t_version, F.lit(-1).cast(VERSION_TYPE)), F.lit(False))
        version = [F.greatest(t_version, s_version).alias(VERSION)]
    op = (
        F.when(~t_in, F.lit(INSERT))
        .when(wins & ~t_value.eqNullSafe(s_value), F.lit(UPDATE))
        .when(later, F.lit(TOUCH))
        .otherwise(F.lit(KEEP))
    )
    return [
        F.when(wins, s_value).otherwise(t_value).alias("value"),
        F.coalesce(t_extracted, now).alias("extracted_at"),
        F.when(op.isin(INSERT, UPDATE), now).otherwise(t_updated).alias("updated_at"),
        *version,
        op.alias("op"),
        s_in.alias("staged"),
    ]


def _version(df: DataFrame) -> Column:
    return F.col(VERSION) if VERSION in df.columns else F.lit(None).cast(VERSION_TYPE)


def merge_plan(target: DataFrame, source: DataFrame, run_ts: dt.datetime | Column) -> DataFrame:
    """Merged rows with the action taken: keys, value, extracted_at, updated_at, op.

    Both sides are unique on the keys (the target by construction, the source
    after duplicate-key rejection), so the join emits at most one row per key
    and no key can skew it.
    """
    now = _ts(run_ts)
    versioned = VERSION in target.columns or VERSION in source.columns
    t = target.select(
        *RAW_KEYS,
        F.col("value").alias("t_value"),
        "extracted_at",
        "updated_at",
        _version(target).alias("t_version"),
        F.lit(True).alias("t_in"),
    )
    s = source.select(*RAW_KEYS, F.col("value").alias("s_value"), _version(source).alias("s_version"), F.lit(True).alias("s_in"))
    j = t.join(s, list(RAW_KEYS), "full_outer")
    return j.select(
        *RAW_KEYS,
        *_resolved(F.col("t_in").isNotNull(), F.col("s_in").isNotNull(), F.col("t_value"), F.col("s_value"),
                   F.col("extracted_at"), F.col("updated_at"), now,
                   (F.col("t_version"), F.col("s_version")) if versioned else None),
    )


def merge_plan_clustered(
    target: DataFrame,
    source: DataFrame,
    run_ts: dt.datetime | Column,
    cluster: list[str],
    partitions: int,
) -> DataFrame:
    """Same rows as ``merge_plan``, computed without a join.

    Both sides are unioned and repartitioned ONCE by ``cluster`` (columns that
    are functions of the keys, e.g. day and a hash bucket of the key, present on
    both inputs); each key is then resolved by one aggregation, which Spark runs
    in place because the grouping contains the partitioning columns. The output
    stays clustered by ``cluster``. Each side must be unique on the keys (a key
    has at most one target and one source row).
    """
    now = _ts(run_ts)
    none_ts = F.lit(None).cast("timestamp")
    versioned = VERSION in target.columns or VERSION in source.columns
    t = target.select(*RAW_KEYS, *cluster, "value", "extracted_at", "updated_at", _version(target).alias("_version"), F.lit(True).alias("_t"))
    s = source.select(*RAW_KEYS, *cluster, "value", none_ts.alias("extracted_at"), none_ts.alias("updated_at"),
                      _version(source).alias("_version"), F.lit(False).alias("_t"))
    is_t = F.col("_t")
    found = [
        F.first(F.when(side, F.col("_version")), ignorenulls=True).alias(name)
        for side, name in ((is_t, "_t_version"), (~is_t, "_s_version"))
    ]
    grouped = (
        t.unionByName(s)
        .repartition(partitions, *cluster)
        .groupBy(*RAW_KEYS, *cluster)
        .agg(
            F.max(is_t.cast("int")).alias("_has_t"),
            F.min(is_t.cast("int")).alias("_min_t"),
            F.first(F.when(is_t, F.col("value")), ignorenulls=True).alias("_t_value"),
            F.first(F.when(~is_t, F.col("value")), ignorenulls=True).alias("_s_value"),
            F.first(F.when(is_t, F.col("extracted_at")), ignorenulls=True).alias("_t_extracted"),
            F.first(F.when(is_t, F.col("updated_at")), ignorenulls=True).alias("_t_updated"),
            *(found if versioned else []),
        )
    )
    return grouped.select(
        *RAW_KEYS,
        *cluster,
        *_resolved(F.col("_has_t") == 1, F.col("_min_t") == 0, F.col("_t_value"), F.col("_s_value"),
                   F.col("_t_extracted"), F.col("_t_updated"), now,
                   (F.col("_t_version"), F.col("_s_version")) if versioned else None),
    )


def insert_plan(source: DataFrame, run_ts: dt.datetime | Column) -> DataFrame:
    """Plan rows for keys known to be absent from the target (e.g. a day with no
    stored partition yet): every row is an insert, no join needed."""
    now = _ts(run_ts)
    return source.select(
        *RAW_KEYS,
        "value",
        now.alias("extracted_at"),
        now.alias("updated_at"),
        *([VERSION] if VERSION in source.columns else []),
        F.lit(INSERT).alias("op"),
        F.lit(True).alias("staged"),
    )


def merged_table(plan: DataFrame) -> DataFrame:
    """The raw table after the merge (drops the bookkeeping columns)."""
    return plan.select(*RAW_KEYS, "value", "extracted_at", "updated_at", *([VERSION] if VERSION in plan.columns else []))


def merge_counts(plan: DataFrame) -> DataFrame:
    """Per indicator: rows staged (the run's "rows merged" figure) and rows inserted / updated / unchanged."""
    staged = F.col("staged")
    return plan.where(staged).groupBy("indicator_id").agg(
        F.count(F.lit(1)).alias("staged_rows"),
        F.count_if(F.col("op") == INSERT).alias("inserted"),
        F.count_if(F.col("op") == UPDATE).alias("updated"),
        F.count_if(F.col("op").isin(KEEP, TOUCH)).alias("unchanged"),
    )
