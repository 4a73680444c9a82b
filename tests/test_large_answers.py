"""Large answers read in pieces: the rows of the reader of whole documents, by many tasks."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from gridmart.plans import warehouse
from gridmart.sources import payload
from test_recovery import land, raw_rows

META = {"name": "Price, \"spot\" \\ day", "id": 600, "magnitud": [{"name": "Price", "id": 23}, {"name": "x", "id": 1}], "values_updated_at": "2027"}


def item(k):
    return {"value": k / 4 if k % 7 else None, "datetime": f"2027-01-01T{k % 24:02d}:00:00", "datetime_utc": "", "geo_id": k % 5, "geo_name": "Península \\ \"a\""}


def text(n, indent=None, before=(), after=()):
    body = {**META, **dict(before), "values": [item(k) for k in range(n)], **dict(after)}
    return json.dumps({"indicator": body, "status": [{"ok": True}]}, indent=indent, ensure_ascii=False)


REGULAR = [text(50), text(50, indent=2), text(1), text(30, after={"geos": [{"geo_id": 3}, {"geo_id": 8}]}), text(9) + "\n", '{"indicator":{"values":[{"value":1}]}}']
OTHERS = [
    text(0), text(20)[:-40], text(20)[:900], "[1, 2]", "no json }", "", '{"indicator": {"values": null}}', '{"other": {"values": [{"value": 1}]}}',
    '{"indicator": {"values": [{"value": 1, "geo": {"id": 3}}, {"value": 2}]}}', '{"indicator": {"values": [{"value": "}"}, {"value": "{2"}]}}',
    '{"indicator": {"values": [{"value": 1}, 5, {"value": 2}]}}', '{"indicator": {"values": [{"value": 1} {"value": 2}]}}',
    '{"indicator": {"old": {"values": [{"value": 7}]}, "values": [{"value": 1}]}}', '{"indicator": {"values": [{"value": 1},, {"value": 2}]}}',
    '{"indicator": {"values": [{"value": 1, }, {"value": 2}]}}', '{"a": {"values": [{"value": 9}]}, "indicator": {}}',
]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture()
def landing(scratch):
    for k, body in enumerate(REGULAR + OTHERS):
        land(f"{scratch}/l", (600, 2038)[k % 2], f"f{k}", body, f"2027-01-0{1 + k % 3}")
    return f"{scratch}/l"


def test_pieces_give_the_rows_of_whole_documents(spark, scratch, landing):
    for since in (None, dt.date(2027, 1, 2)):
        want = payload.explode_payload(payload.read_payload_files(spark, landing, since=since))
        got = payload.read_items(spark, landing, since=since, work=f"{scratch}/w{since}", split_bytes=1)
        assert got.columns == want.columns
        assert rows(got) == rows(want)


def test_regular_documents_are_read_in_pieces_and_others_whole(spark, scratch, landing):
    _, files = payload._split_items(stored(spark, scratch, landing))
    names = {f.rsplit("/", 1)[1] for f in files}
    assert names == {f"f{k}.json" for k in range(len(REGULAR), len(REGULAR) + len(OTHERS)) if OTHERS[k - len(REGULAR)]}


def stored(spark, scratch, landing):
    payload._pieces(spark, landing, None, 1).write.parquet(f"{scratch}/pieces")
    return spark.read.parquet(f"{scratch}/pieces")


def test_a_ten_year_answer_is_read_by_many_tasks(spark, scratch):
    start = dt.datetime(2017, 1, 1)
    values = [{"value": k % 500, "datetime_utc": f"{start + dt.timedelta(hours=k):%Y-%m-%dT%H:%M:%SZ}", "geo_id": 3} for k in range(24 * 3650)]
    land(f"{scratch}/l", 600, "ten-years", json.dumps({"indicator": {"name": "p", "values": values}}), "2027-01-01")
    land(f"{scratch}/l", 600, "day", json.dumps({"indicator": {"values": [{"value": 1, "datetime_utc": "2027-01-01T00:00:00Z", "geo_id": 3}]}}), "2027-01-02")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 500_000)
    try:
        pieces = payload._pieces(spark, f"{scratch}/l", None, 1_000_000)
        assert pieces.select(F.spark_partition_id()).distinct().count() >= 8  # 5 MB
        assert pieces.select("document").distinct().count() == 1
        got = payload.read_items(spark, f"{scratch}/l", work=f"{scratch}/w", split_bytes=1_000_000)
        whole = payload.explode_payload(payload.read_payload_files(spark, f"{scratch}/l"))
        assert got.count() == 24 * 3650 + 1 and got.exceptAll(whole).isEmpty() and whole.exceptAll(got).isEmpty()
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_large_and_small_answers_load_together(spark, scratch, monkeypatch):
    big = [{"value": h, "datetime_utc": f"2027-01-01T{h:02d}:00:00Z", "geo_id": 3} for h in range(24)]
    land(f"{scratch}/l", 600, "big", json.dumps({"indicator": {"values": big}}), "2027-01-02")
    land(f"{scratch}/l", 600, "new", json.dumps({"indicator": {"values": [{"value": 99, "datetime_utc": "2027-01-01T05:00:00Z", "geo_id": 3}]}}), "2027-01-03")
    monkeypatch.setattr(payload.read_items, "__defaults__", (*payload.read_items.__defaults__[:-1], 500))
    assert warehouse.run(spark, f"{scratch}/l", f"{scratch}/wh", dt.datetime(2027, 1, 4)).status == 0
    assert [v for _, _, v in raw_rows(spark, f"{scratch}/wh")] == [99.0 if h == 5 else float(h) for h in range(24)]
