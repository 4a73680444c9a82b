"""Upsert semantics (pure merge) and the stored, partitioned upsert."""

import datetime as dt
from decimal import Decimal

from gridmart.operators import upsert
from gridmart.plans import warehouse
from gridmart.sources import tables

D = Decimal
T = dt.datetime
RUN0, RUN1, RUN2 = T(2025, 1, 1, 6), T(2025, 1, 2, 6), T(2025, 1, 3, 6)
TGT = "indicator_id int, datetime_utc timestamp, geo_id int, value decimal(18,6), extracted_at timestamp, updated_at timestamp"
SRC = "indicator_id int, datetime_utc timestamp, geo_id int, value decimal(18,6)"


def _d(v):
    return None if v is None else D(str(v))


def target(spark, rows):
    return spark.createDataFrame([(i, t, g, _d(v), RUN0, RUN0) for i, t, g, v in rows], TGT)


def source(spark, rows):
    return spark.createDataFrame([(i, t, g, _d(v)) for i, t, g, v in rows], SRC)


A, B, C, E, N = (T(2024, 5, 1, h) for h in range(5))


def test_merge_actions(spark):
    tgt = target(spark, [(600, A, 3, 1), (600, B, 3, None), (600, C, 3, 5), (600, E, 3, 7)])
    src = source(spark, [(600, A, 3, None), (600, B, 3, 2), (600, C, 3, 5), (600, N, 3, 9)])
    rows = {r.datetime_utc: r for r in upsert.merge_plan(tgt, src, RUN1).collect()}
    assert rows[A].op == "update" and rows[A].value is None and rows[A].updated_at == RUN1
    assert rows[B].op == "update" and rows[B].value == D(2)
    assert rows[C].op == "keep" and rows[C].updated_at == RUN0
    assert rows[E].op == "keep" and rows[E].value == D(7) and not rows[E].staged
    assert rows[N].op == "insert" and rows[N].extracted_at == RUN1 == rows[N].updated_at
    assert all(r.extracted_at == RUN0 for k, r in rows.items() if k != N)
    (c,) = upsert.merge_counts(upsert.merge_plan(tgt, src, RUN1)).collect()
    assert (c.staged_rows, c.inserted, c.updated, c.unchanged) == (4, 1, 2, 1)


def test_geo_is_part_of_the_key(spark):
    tgt = target(spark, [(600, A, 3, 1)])
    src = source(spark, [(600, A, 1, 1)])
    ops = sorted(r.op for r in upsert.merge_plan(tgt, src, RUN1).collect())
    assert ops == ["insert", "keep"]


def stored(spark, root):
    return {
        (r.indicator_id, r.datetime_utc, r.geo_id): (r.value, r.extracted_at, r.updated_at)
        for r in tables.read_raw(spark, warehouse.Layout(root).raw).collect()
    }


def test_stored_upsert_rewrites_only_changed_days(spark, scratch):
    layout = warehouse.Layout(f"{scratch}/wh")
    work = f"{scratch}/work"
    day1, day2 = T(2024, 5, 1, 10), T(2024, 5, 2, 10)
    first = source(spark, [(600, day1, 3, 1), (600, day2, 3, 2), (2038, day2, 3, None)])
    counts, changed = warehouse.upsert_raw(spark, layout.raw, first, RUN0, work + "1")
    assert changed == [day1.date(), day2.date()]
    assert sorted(c["inserted"] for c in counts) == [1, 2]
    before = stored(spark, layout.root)

    # Same batch again: nothing changes, no partition is rewritten (idempotent rerun).
    _, changed = warehouse.upsert_raw(spark, layout.raw, first, RUN1, work + "2")
    assert changed == [] and stored(spark, layout.root) == before

    # Revision on day 2 only (NULL -> value); day 1 untouched, a new day 3 inserted.
    day3 = T(2024, 5, 3, 0)
    rev = source(spark, [(2038, day2, 3, 4), (600, day3, 3, 8)])
    _, changed = warehouse.upsert_raw(spark, layout.raw, rev, RUN2, work + "3")
    assert changed == [day2.date(), day3.date()]
    after = stored(spark, layout.root)
    assert after[(600, day1, 3)] == before[(600, day1, 3)]
    assert after[(600, day2, 3)] == before[(600, day2, 3)]
    assert after[(2038, day2, 3)] == (D(4), RUN0, RUN2)
    assert after[(600, day3, 3)] == (D(8), RUN2, RUN2)
    assert len(after) == 4


def test_empty_batch_is_a_noop(spark, scratch):
    layout = warehouse.Layout(f"{scratch}/wh")
    counts, changed = warehouse.upsert_raw(spark, layout.raw, source(spark, []), RUN0, f"{scratch}/w")
    assert changed == [] and counts == []
    assert tables.raw_exists(spark, layout.raw)
    assert tables.read_raw(spark, layout.raw).count() == 0


def test_window_read_prunes_partitions(spark, scratch):
    layout = warehouse.Layout(f"{scratch}/wh")
    rows = [(600, T(2024, 5, d, 12), 3, d) for d in range(1, 6)]
    warehouse.upsert_raw(spark, layout.raw, source(spark, rows), RUN0, f"{scratch}/w")
    df = tables.read_raw(spark, layout.raw, T(2024, 5, 2), T(2024, 5, 4))
    assert sorted(r.value for r in df.collect()) == [D(2), D(3)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "obs_date" in plan


def test_stored_upsert_equals_pure_merge_on_fixture(spark, scratch):
    from gridmart.sources import fixtures

    from data_paths import SF001

    events = fixtures.read_events(spark, SF001)
    tgt, src = fixtures.upsert_target(events), fixtures.upsert_source(events)
    layout = warehouse.Layout(f"{scratch}/wh")
    keys = ["indicator_id", "datetime_utc", "geo_id", "value"]
    warehouse.upsert_raw(spark, layout.raw, tgt.select(*keys), fixtures.FIRST_LOAD_TS, f"{scratch}/w1")
    counts, changed = warehouse.upsert_raw(spark, layout.raw, src, fixtures.REVISION_TS, f"{scratch}/w2")

    plan = upsert.merge_plan(tgt, src, fixtures.REVISION_TS)
    expected = {(r.indicator_id, r.datetime_utc, r.geo_id): (r.value, r.extracted_at, r.updated_at)
                for r in upsert.merged_table(plan).collect()}
    assert stored(spark, layout.root) == expected
    want = [r.asDict() for r in upsert.merge_counts(plan).collect()]
    assert sorted(counts, key=lambda c: c["indicator_id"]) == sorted(want, key=lambda c: c["indicator_id"])


def test_new_days_skip_the_join(spark, scratch):
    layout = warehouse.Layout(f"{scratch}/wh")
    day1, day2 = T(2024, 5, 1, 10), T(2024, 5, 2, 10)
    warehouse.upsert_raw(spark, layout.raw, source(spark, [(600, day1, 3, 1)]), RUN0, f"{scratch}/w1")
    assert tables.existing_days(spark, layout.raw) == {day1.date()}
    counts, changed = warehouse.upsert_raw(
        spark, layout.raw, source(spark, [(600, day1, 3, 2), (600, day2, 3, 5)]), RUN1, f"{scratch}/w2")
    assert changed == [day1.date(), day2.date()]
    assert counts == [{"indicator_id": 600, "staged_rows": 2, "inserted": 1, "updated": 1, "unchanged": 0}]
    got = stored(spark, layout.root)
    assert got[(600, day1, 3)] == (D(2), RUN0, RUN1) and got[(600, day2, 3)] == (D(5), RUN1, RUN1)


def test_static_session_mode_cannot_wipe_other_days(spark, scratch):
    layout = warehouse.Layout(f"{scratch}/wh")
    day1, day2 = T(2024, 5, 1, 10), T(2024, 5, 2, 10)
    warehouse.upsert_raw(spark, layout.raw, source(spark, [(600, day1, 3, 1)]), RUN0, f"{scratch}/w1")
    prev = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        warehouse.upsert_raw(spark, layout.raw, source(spark, [(600, day2, 3, 2)]), RUN1, f"{scratch}/w2")
        warehouse.upsert_raw(spark, layout.raw, source(spark, [(600, day1, 3, 5)]), RUN2, f"{scratch}/w3")
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", prev)
    got = stored(spark, layout.root)
    assert got == {(600, day1, 3): (D(5), RUN0, RUN2), (600, day2, 3): (D(2), RUN1, RUN1)}


def test_batch_types_are_cast_to_the_table(spark, scratch):
    layout = warehouse.Layout(f"{scratch}/wh")
    wide = spark.createDataFrame([(600, T(2024, 5, 1, 10), 3, D("1.25"))],
                                 "indicator_id bigint, datetime_utc timestamp, geo_id bigint, value decimal(29,6)")
    warehouse.upsert_raw(spark, layout.raw, wide, RUN0, f"{scratch}/w1")
    assert stored(spark, layout.root) == {(600, T(2024, 5, 1, 10), 3): (D("1.25"), RUN0, RUN0)}


def test_rows_without_indicator_never_load(spark, scratch):
    items = spark.createDataFrame(
        [(None, "1", None, "2024-05-01T00:00:00Z", 3), (600, "2", None, "2024-05-01T00:00:00Z", 3)],
        "indicator_id int, value string, datetime string, datetime_utc string, geo_id int")
    layout = warehouse.Layout(f"{scratch}/wh")
    result = warehouse.ingest_items(spark, items, layout, RUN0)
    assert result.status == 1
    assert stored(spark, layout.root) == {(600, T(2024, 5, 1, 0), 3): (D(2), RUN0, RUN0)}


def test_refuses_null_keys_and_lossy_casts(spark, scratch):
    import pytest

    layout = warehouse.Layout(f"{scratch}/wh")
    with pytest.raises(ValueError):
        warehouse.upsert_raw(spark, layout.raw, source(spark, [(None, T(2024, 5, 1), 3, 1)]), RUN0, f"{scratch}/w1")
    too_big = spark.createDataFrame([(600, T(2024, 5, 1), 3, D("1e15"))],
                                    "indicator_id int, datetime_utc timestamp, geo_id int, value decimal(29,6)")
    prev = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")  # the check must not rely on ANSI casts
    try:
        with pytest.raises(ValueError):
            warehouse.upsert_raw(spark, layout.raw, too_big, RUN0, f"{scratch}/w2")
    finally:
        spark.conf.set("spark.sql.ansi.enabled", prev)
    assert tables.read_raw(spark, layout.raw).count() == 0


def test_null_indicator_fails_the_run_everywhere(spark):
    from gridmart.operators import ingest

    items = spark.createDataFrame(
        [(None, "1", None, "2024-05-01T00:00:00Z", 3), (600, "2", None, "2024-05-01T00:00:00Z", 3)],
        "indicator_id int, value string, datetime string, datetime_utc string, geo_id int")
    checks = ingest.indicator_checks(ingest.normalise(items))
    assert {r.run_status for r in ingest.run_status(spark, checks).collect()} == {1}
    assert [r.indicator_id for r in ingest.rejected_indicators(checks).collect()] == [None]


def test_refuses_rounding_truncation_and_duplicates(spark, scratch):
    import pytest

    layout = warehouse.Layout(f"{scratch}/wh")
    rounded = spark.createDataFrame([(600, T(2024, 5, 1), 3, D("1.12345678"))],
                                    "indicator_id int, datetime_utc timestamp, geo_id int, value decimal(20,8)")
    truncated = spark.createDataFrame([(600.7, T(2024, 5, 1), 3, D("1"))],
                                      "indicator_id double, datetime_utc timestamp, geo_id int, value decimal(18,6)")
    dup = source(spark, [(600, T(2024, 5, 1), 3, 1), (600, T(2024, 5, 1), 3, 2)])
    for i, bad in enumerate([rounded, truncated, dup]):
        with pytest.raises(ValueError):
            warehouse.upsert_raw(spark, layout.raw, bad, RUN0, f"{scratch}/w{i}")
    assert tables.read_raw(spark, layout.raw).count() == 0


def test_unregistered_indicator_fails(spark, scratch):
    items = spark.createDataFrame(
        [(9999, "1", None, "2024-05-01T00:00:00Z", 3), (600, "2", None, "2024-05-01T00:00:00Z", 3)],
        "indicator_id int, value string, datetime string, datetime_utc string, geo_id int")
    layout = warehouse.Layout(f"{scratch}/wh")
    result = warehouse.ingest_items(spark, items, layout, RUN0)
    assert result.status == 1
    assert set(stored(spark, layout.root)) == {(600, T(2024, 5, 1, 0), 3)}
