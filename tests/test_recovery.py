"""Overlapping answers, interrupted writes, stream state: what a daily run meets in production."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from gridmart.__main__ import main
from gridmart.operators import ingest
from gridmart.plans import warehouse
from gridmart.sources import fixtures, payload, tables
from gridmart.streaming import ingest_stream

from data_paths import SF001

RUN_1, RUN_2 = dt.datetime(2027, 1, 5, 6), dt.datetime(2027, 1, 6, 6)


def answer(*values):
    """values: (time, value[, geo])"""
    items = [{"value": v[1], "datetime_utc": v[0], "geo_id": v[2] if len(v) > 2 else 3} for v in values]
    return json.dumps({"indicator": {"values": items}})


def land(folder, indicator, name, text, fetched=None, at=None):
    path = f"{folder}/indicator_id={indicator}" + (f"/fetch_date={fetched}" if fetched else "")
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}.json", "w") as f:
        f.write(text)
    if at:
        os.utime(f"{path}/{name}.json", (at, at))


def raw_rows(spark, root):
    raw = tables.read_raw(spark, warehouse.Layout(root).raw)
    return sorted((r.indicator_id, str(r.datetime_utc), None if r.value is None else float(r.value)) for r in raw.collect())


FIRST = answer(("2027-01-01T00:00:00Z", 1), ("2027-01-02T00:00:00Z", 2), ("2027-01-02T01:00:00Z", 3))
SECOND = answer(("2027-01-02T00:00:00Z", 20), ("2027-01-02T01:00:00Z", None), ("2027-01-03T00:00:00Z", 4))
BOTH = [
    (600, "2027-01-01 00:00:00", 1.0), (600, "2027-01-02 00:00:00", 20.0), (600, "2027-01-02 01:00:00", None), (600, "2027-01-03 00:00:00", 4.0),
]


def test_two_overlapping_answers_load_from_the_command_line(spark, scratch, capsys):
    args = ["--master", "local[4]", "ingest", "--landing", f"{scratch}/l", "--root", f"{scratch}/wh", "--start", "2027-01-01", "--end", "2027-01-31"]
    land(f"{scratch}/l", 600, "a", FIRST, "2027-01-03")
    assert main(args) == 0
    land(f"{scratch}/l", 600, "b", SECOND, "2027-01-04")
    assert main(args) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["checks"][0]["duplicate_keys"] == 0 and out["counts"][0]["updated"] == 2 and out["counts"][0]["inserted"] == 1
    assert raw_rows(spark, f"{scratch}/wh") == BOTH


def test_the_newest_fetch_wins_whatever_the_file_names(spark, scratch):
    land(f"{scratch}/l", 600, "z", FIRST, "2027-01-03")
    land(f"{scratch}/l", 600, "a", SECOND, "2027-01-04")
    assert warehouse.run(spark, f"{scratch}/l", f"{scratch}/wh", RUN_1).status == 0
    assert raw_rows(spark, f"{scratch}/wh") == BOTH


def test_earlier_fetches_are_pruned(spark, scratch):
    for day in (1, 2, 3, 4):
        land(f"{scratch}/l", 600, "a", answer((f"2027-01-0{day}T00:00:00Z", day)), f"2027-01-0{day}")
    docs = payload.read_payload_files(spark, f"{scratch}/l", since=dt.date(2027, 1, 3))
    assert sorted(r.fetched_at[:10] for r in docs.collect()) == ["2027-01-03", "2027-01-04"]
    assert "PartitionFilters: [(isnull(fetch_date" in docs._jdf.queryExecution().executedPlan().toString()


def items_of(spark, rows, document="d", fetched="2027-01-05"):
    full = [(i, str(v) if v is not None else None, None, t, "3", False, fetched, document) for i, t, v in rows]
    schema = "indicator_id int, value string, datetime string, datetime_utc string, geo_id string, bad_doc boolean, fetched_at string, document string"
    return spark.createDataFrame(full, schema)


def hours(day, value, n=24, indicator=600):
    return [(indicator, f"2027-01-{day:02d}T{h:02d}:00:00Z", value + h) for h in range(n)]


def clean_build(spark, root, batches):
    layout = warehouse.Layout(root)
    for rows, at in batches:
        warehouse.ingest_items(spark, items_of(spark, rows), layout, at)
    warehouse.refresh_marts(spark, layout, None)
    return layout


def same(spark, a, b):
    raw = [sorted(map(tuple, tables.read_raw(spark, x.raw).select("indicator_id", "datetime_utc", "value").collect())) for x in (a, b)]
    assert raw[0] == raw[1]
    for name in warehouse.MART_NAMES:
        rows = [sorted(map(tuple, spark.read.parquet(x.mart(name)).collect()), key=repr) for x in (a, b)]
        assert rows[0] == rows[1], name


PRICES = hours(1, 10) + hours(2, 20)
POWER = hours(1, 100, indicator=2038) + hours(2, 200, indicator=2038)
REVISED = hours(2, 50) + hours(3, 30) + hours(3, 300, indicator=2038)


class Lost(RuntimeError):
    pass


@pytest.mark.parametrize("where", ["stage", "pending", "unfinished", "write_before", "write_after", "half_deleted", "refresh"])
def test_a_run_that_dies_is_completed_by_the_next(spark, scratch, monkeypatch, where):
    batches = [(PRICES + POWER, RUN_1), (REVISED, RUN_2)]
    want = clean_build(spark, f"{scratch}/want", batches)
    layout = clean_build(spark, f"{scratch}/got", batches[:1])

    def die(*args, **kwargs):
        raise Lost(where)

    with monkeypatch.context() as m:
        if where == "stage":
            m.setattr(warehouse, "stage_batch", die)
        elif where == "pending":
            m.setattr(warehouse, "add_pending_days", die)
        elif where == "unfinished":
            m.setattr(warehouse, "_unfinished_path", lambda layout: die())
            m.setattr(warehouse, "finish_write", lambda *a: [])
        elif where == "write_before":
            m.setattr(warehouse, "_write_raw_days", die)
        elif where == "write_after":
            write = warehouse._write_raw_days
            m.setattr(warehouse, "_write_raw_days", lambda *a: (write(*a), die()))
        elif where == "half_deleted":

            def half(rows, raw_path):  # the old partition is gone, the new one is not there
                fs, path = tables.hadoop_fs(spark, f"{raw_path}/obs_date=2027-01-02")
                fs.delete(path, True)
                die()

            m.setattr(warehouse, "_write_raw_days", half)
        if where == "refresh":
            warehouse.ingest_items(spark, items_of(spark, REVISED), layout, RUN_2)
            m.setattr(warehouse, "_refresh", die)
            with pytest.raises(Lost):
                warehouse.refresh_marts(spark, layout, [])
        else:
            with pytest.raises(Lost):
                warehouse.ingest_items(spark, items_of(spark, REVISED), layout, RUN_2)

    if where in ("write_before", "write_after", "half_deleted"):
        # Even a run with another batch first completes the write.
        result = warehouse.ingest_items(spark, items_of(spark, []), layout, RUN_2)
        assert dt.date(2027, 1, 2) in result.changed_days
        warehouse.refresh_marts(spark, layout, result.changed_days)
        same(spark, layout, want)
    result = warehouse.ingest_items(spark, items_of(spark, REVISED), layout, RUN_2)
    warehouse.refresh_marts(spark, layout, result.changed_days)
    same(spark, layout, want)
    assert warehouse.pending_days(spark, layout) == [] and warehouse.finish_write(spark, layout) == []


def test_an_interrupted_first_load_is_completed(spark, scratch, monkeypatch):
    want = clean_build(spark, f"{scratch}/want", [(PRICES + POWER, RUN_1)])
    layout = warehouse.Layout(f"{scratch}/got")
    with monkeypatch.context() as m:
        m.setattr(warehouse, "_write_raw_days", lambda *a: (_ for _ in ()).throw(Lost()))
        with pytest.raises(Lost):
            warehouse.ingest_items(spark, items_of(spark, PRICES + POWER), layout, RUN_1)
    warehouse.refresh_marts(spark, layout, warehouse.ingest_items(spark, items_of(spark, []), layout, RUN_2).changed_days)
    same(spark, layout, want)
    stamps = tables.read_raw(spark, layout.raw).select("extracted_at").distinct().collect()
    assert [r.extracted_at for r in stamps] == [RUN_1]


def test_large_days_are_cut_and_others_are_not(spark, scratch, monkeypatch):
    monkeypatch.setattr(warehouse, "SLICE_ROWS", 10)
    rows = hours(1, 1) + hours(1, 1, indicator=2038) + hours(2, 2, n=4) + hours(3, 3)
    layout = clean_build(spark, f"{scratch}/wh", [(rows, RUN_1), (hours(1, 5) + hours(3, 4), RUN_2)])
    got = {(r[0], r[1]): r[2] for r in raw_rows(spark, f"{scratch}/wh")}
    assert len(got) == len(rows) and got[(600, "2027-01-01 05:00:00")] == 10.0 and got[(2038, "2027-01-01 05:00:00")] == 6.0
    with_bucket = warehouse._with_bucket(tables.read_raw(spark, layout.raw), {dt.date(2027, 1, 1): 5, dt.date(2027, 1, 2): 1})
    per_day = {r[0]: r[1] for r in with_bucket.groupBy("obs_date").agg(F.count_distinct("_bucket")).collect()}
    assert per_day[dt.date(2027, 1, 1)] > 1 and per_day[dt.date(2027, 1, 2)] == per_day[dt.date(2027, 1, 3)] == 1


def run_stream(spark, scratch, landing, root, **kwargs):
    query = ingest_stream.start(spark, landing, root, refresh_marts=False, **kwargs)
    query.awaitTermination()


def test_files_per_trigger_changes_the_pace_only(spark, scratch):
    landing = f"{scratch}/l"
    land(landing, 600, "a", FIRST, at=1_800_000_000)
    land(landing, 600, "b", SECOND, at=1_800_000_100)
    land(landing, 2038, "c", answer(("2027-01-01T00:00:00Z", 7), ("2027-01-01T00:00:00Z", 8)), at=1_800_000_200)
    for bound in (None, 1):
        root = f"{scratch}/wh{bound}"
        run_stream(spark, scratch, landing, root, max_files_per_trigger=bound)  # each root has a checkpoint of its own
        assert raw_rows(spark, root) == BOTH
        status = spark.read.parquet(ingest_stream.status_path(root)).collect()
        assert max(r.status for r in status) == 1
        kept = spark.read.parquet(ingest_stream.quarantine_path(root)).collect()
        assert sorted(r.value for r in kept) == ["7", "8"]


def test_stream_state_is_its_own(spark, scratch):
    names = {ingest_stream.checkpoint_of(spark, a, b) for a in ("/x/l", "/x/m") for b in ("/y/a", "/y/b")}
    assert len(names) == 4 and ingest_stream.checkpoint_of(spark, "/x/l/", "/y/a/") in names


def test_refetched_fixture_against_a_model(spark):
    events = fixtures.read_events(spark, SF001)
    rows = ingest.normalise(fixtures.refetched_items(events)).collect()
    best, twice = {}, set()
    for r in sorted(rows, key=lambda r: (r.fetched_at, r.document)):
        key = (r.indicator_id, r.datetime_utc, r.geo_id)
        if best.get(key, (None, None))[1] == r.document:
            twice.add(r.indicator_id)
        best[key] = (r.value, r.document)
    norm = ingest.normalise(fixtures.refetched_items(events))
    got = ingest.accepted(norm, ingest.rejected_indicators(ingest.indicator_checks(norm))).collect()
    assert twice == {2040}
    assert {(r.indicator_id, r.datetime_utc, r.geo_id): r.value for r in got} == {k: v[0] for k, v in best.items() if k[0] not in twice}
