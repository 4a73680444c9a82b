"""Physical-plan properties the design relies on (checked with explain output)."""

import datetime as dt
import os
from decimal import Decimal

from pyspark.sql import functions as F

from gridmart.operators import market, staging
from gridmart.plans import warehouse
from gridmart.sources import tables

D0 = dt.datetime(2024, 5, 1)


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def stored_raw(spark, root, rows):
    rows = [(i, t, g, Decimal(v)) for i, t, g, v in rows]
    df = spark.createDataFrame(rows, "indicator_id int, datetime_utc timestamp, geo_id int, value decimal(18,6)")
    warehouse.upsert_raw(spark, f"{root}/raw", df, D0, f"{root}/w")
    return tables.read_raw(spark, f"{root}/raw")


def sample_rows(days=3, per_hour=6):
    rows = []
    for d in range(days):
        for h in range(24):
            for m in range(per_hour):
                t = D0 + dt.timedelta(days=d, hours=h, minutes=10 * m)
                for ind in (600, 2038, 2040, 10004):
                    rows.append((ind, t, 3, 1))
    return rows


def test_hourly_market_is_one_scan_one_exchange_with_pushdown(spark, scratch):
    raw = stored_raw(spark, scratch, sample_rows()).where(F.col("obs_date") == F.lit(dt.date(2024, 5, 2)))
    hm = market.hourly_market_from_raw(raw.select("indicator_id", "datetime_utc", "geo_id", "value"))
    text = plan_text(hm)
    assert text.count("Exchange") == 1
    assert "partial_avg" in text and "partial_sum" in text
    assert "BroadcastHashJoin" not in text and "SortMergeJoin" not in text
    assert "PartitionFilters: [isnotnull(obs_date" in text
    assert "EqualTo(geo_id,3)" in text and "In(indicator_id" in text
    assert hm.count() == 24


def test_pivot_is_fused_into_one_aggregation(spark, scratch):
    raw = stored_raw(spark, scratch, sample_rows(days=1)).select("indicator_id", "datetime_utc", "geo_id", "value")
    assert plan_text(staging.hourly_generation(raw)).count("Exchange") == 1


def test_fact_turns_left_join_into_inner(spark, scratch):
    raw = stored_raw(spark, scratch, sample_rows(days=1)).select("indicator_id", "datetime_utc", "geo_id", "value")
    joined = market.fct_hourly_market(market.hourly_market(staging.hourly_price(raw), staging.hourly_generation(raw)))
    text = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in text and "LeftOuter" not in text


def test_hot_day_is_split_over_several_files(spark, scratch, monkeypatch):
    """A day holding most of the batch is written by several tasks, not one."""
    monkeypatch.setattr(warehouse, "SLICE_ROWS", 1000)  # 4000-row day = "large" at test scale
    # At test size every file is tiny, so turn off the two small-data packings
    # (post-shuffle coalescing and packing small files into one read split)
    # that at scale never apply to a hot day's multi-hundred-MB slices.
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.files.maxPartitionBytes": "1024", "spark.sql.files.openCostInBytes": "1024"}
    prev = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        rows = [(600, D0 + dt.timedelta(seconds=s), 3, 1) for s in range(4000)]  # hot day
        rows += [(600, D0 + dt.timedelta(days=1 + d), 3, 1) for d in range(20)]   # 20 thin days
        stored_raw(spark, scratch, rows)  # insert-only path
        hot_dir = f"{scratch}/raw/obs_date=2024-05-01"
        first = [f for f in os.listdir(hot_dir) if f.endswith(".parquet")]
        assert len(first) > 1
        revised = spark.createDataFrame([(i, t, g, Decimal(v) + 1) for i, t, g, v in rows[:4000]],
                                        "indicator_id int, datetime_utc timestamp, geo_id int, value decimal(18,6)")
        counts, changed = warehouse.upsert_raw(spark, f"{scratch}/raw", revised, D0, f"{scratch}/w2")  # merge path
        assert changed == [dt.date(2024, 5, 1)] and counts[0]["updated"] == 4000
    finally:
        for k, v in prev.items():
            spark.conf.set(k, v)
    # Range partitioning split the hot day over several tasks -> several files.
    hot_dir = f"{scratch}/raw/obs_date=2024-05-01"
    files = [f for f in os.listdir(hot_dir) if f.endswith(".parquet")]
    assert len(files) > 1
    assert tables.read_raw(spark, f"{scratch}/raw").count() == 4020


def test_clustered_merge_is_one_exchange_without_join(spark, scratch):
    from gridmart.operators import upsert

    raw = stored_raw(spark, scratch, sample_rows(days=2))
    cluster = ["obs_date", "_bucket"]
    bucket = F.pmod(F.xxhash64("indicator_id", "geo_id", "datetime_utc"), F.lit(2)).alias("_bucket")
    tgt = raw.select("*", bucket)
    src = raw.select("indicator_id", "datetime_utc", "geo_id", "value", "obs_date", bucket)
    plan = upsert.merge_plan_clustered(tgt, src, D0, cluster, 4)
    text = plan_text(plan)
    assert text.count("Exchange") == 1 and "Join" not in text
    assert {r.op for r in plan.collect()} == {"keep"}
