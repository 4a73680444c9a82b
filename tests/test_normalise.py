"""Payload items to observations: the rules as tables of input and expectation."""

import datetime as dt
from decimal import Decimal

import pytest

from gridmart.operators import ingest
from gridmart.sources import payload

SCHEMA = "indicator_id int, value string, datetime string, datetime_utc string, geo_id string, fetched_at string, document string"


def items(spark, rows):
    """rows: dicts; ``id`` and ``utc`` stand for indicator_id and datetime_utc."""
    names = ("value", "datetime", "utc", "geo", "at", "doc")
    return spark.createDataFrame([(r.get("id", 600), *(r.get(n) for n in names)) for r in rows], SCHEMA)


def instant(text):
    return dt.datetime.fromisoformat(text)


TIMES = [
    # datetime_utc, datetime, expected (None: bad)
    ("2027-03-04T05:06:07Z", None, "2027-03-04T05:06:07"),
    ("2027-03-04T05:06:07+02:00", None, "2027-03-04T03:06:07"),
    ("2027-03-04T05:06:07-0330", None, "2027-03-04T08:36:07"),
    ("2027-03-04T05:06:07.25", None, "2027-03-04T05:06:07.250000"),
    ("2027-03-04 05:06", None, "2027-03-04T05:06:00"),
    ("2027-03-04", None, "2027-03-04T00:00:00"),
    ("20270304T050607Z", None, "2027-03-04T05:06:07"),
    ("20270304", None, "2027-03-04T00:00:00"),
    ("20270304T0506+0100", None, "2027-03-04T04:06:00"),
    ("", "2027-03-04T09:00:00", "2027-03-04T09:00:00"),
    (None, "2027-03-04T09:00:00", "2027-03-04T09:00:00"),
    ("2027-03-04T01:00:00Z", "2027-03-04T09:00:00", "2027-03-04T01:00:00"),
    ("2027-W09-4", None, "2027-03-04T00:00:00"),
    ("2027W094T050607Z", None, "2027-03-04T05:06:07"),
    ("2027-W09T05:06:07+02:00", None, "2027-03-01T03:06:07"),
    ("2027W09", None, "2027-03-01T00:00:00"),
    ("2026-W53-7 23:00", None, "2027-01-03T23:00:00"),
    ("2026-W01-1", None, "2025-12-29T00:00:00"),
    ("20270304T05:06:07.5Z", None, "2027-03-04T05:06:07.500000"),
    ("2027-03-04T0506Z", None, "2027-03-04T05:06:00"),
    ("2027-W53-1", None, None),
    ("2027-W00-1", None, None),
    ("2027-W09-0", None, None),
    ("2027-W09-8", None, None),
    ("2027-W9-4", None, None),
    ("2027-W094", None, None),
    ("2027W09-4", None, None),
    ("2027-W09-4T25:00", None, None),
    ("tomorrow", "2027-03-04T09:00:00", None),
    ("12:34", None, None),
    ("T10:00", None, None),
    ("2027", None, None),
    ("2027-03", None, None),
    ("2027-3-4", None, None),
    ("2027-02-30", None, None),
    ("2027-03-04T25:00:00", None, None),
    ("2027-03-04T05:06:07 Europe/Madrid", None, None),
    ("2027-03-04T05:06:07[UTC]", None, None),
    (None, None, None),
    ("", "", None),
]

@pytest.mark.parametrize("form", ["%G-W%V-%u", "%GW%V%u"])
def test_week_dates_of_forty_years(spark, form):
    days = [dt.date(2000, 1, 1) + dt.timedelta(days=k) for k in range(0, 14700, 3)] + [dt.date(y, m, d) for y in range(2000, 2041) for m, d in ((12, 31), (1, 1))]
    rows = [{"id": k, "utc": d.strftime(form)} for k, d in enumerate(days)]
    got = {r.indicator_id: r.datetime_utc.date() for r in ingest.normalise(items(spark, rows)).collect()}
    assert got == dict(enumerate(days))


VALUES = [
    # text, expected, bad
    ("17.125", "17.125", False),
    ("-3", "-3", False),
    (" 8 ", "8", False),
    ("1.1234560000", "1.123456", False),
    ("2e3", "2000", False),
    (None, None, False),
    ("seven", None, True),
    ("", None, True),
    ("1e15", None, True),
    ("1.1234567", "1.123457", True),
    ("1e-7", "0", True),
    ("0.0000000000000000000001", "0", True),
    ("NaN", None, True),
]

GEOS = [(None, 0, False), ("", 0, False), ("0", 0, False), ("8", 8, False), ("east", 0, True), ("1.5", 0, True)]


def test_times(spark):
    rows = [{"id": i, "utc": utc, "datetime": local, "value": "1"} for i, (utc, local, _) in enumerate(TIMES)]
    for r in ingest.normalise(items(spark, rows)).collect():
        want = TIMES[r.indicator_id][2]
        assert r.datetime_utc == (instant(want) if want else None), TIMES[r.indicator_id]
        assert r.bad_time == (want is None)


def test_values(spark):
    rows = [{"id": i, "utc": "2027-03-04", "value": v} for i, (v, _, _) in enumerate(VALUES)]
    for r in ingest.normalise(items(spark, rows)).collect():
        _, want, bad = VALUES[r.indicator_id]
        assert r.bad_value == bad, VALUES[r.indicator_id]
        assert (r.value is None) == (want is None) and (want is None or r.value == Decimal(want)), VALUES[r.indicator_id]


def test_geographies(spark):
    rows = [{"id": i, "utc": "2027-03-04", "geo": g} for i, (g, _, _) in enumerate(GEOS)]
    got = {r.indicator_id: (r.geo_id, r.bad_geo) for r in ingest.normalise(items(spark, rows)).collect()}
    assert got == {i: (want, bad) for i, (_, want, bad) in enumerate(GEOS)}


def test_no_items(spark):
    assert ingest.normalise(items(spark, [])).count() == 0


DAY = "2027-03-04T00:00:00Z"
#: Batches by indicator, and the check that must reject them (None: loads).
BATCHES = {
    600: ([{"utc": DAY, "value": "1"}], None),
    2038: ([{"utc": DAY, "value": "n/a"}, {"utc": "2027-03-05", "value": "2"}], "bad_values"),
    2040: ([{"utc": "later", "value": "1"}], "bad_times"),
    2041: ([{"value": "1"}], "bad_times"),
    2042: ([{"utc": DAY, "value": "1", "geo": "north"}], "bad_geos"),
    2044: ([{"utc": DAY, "value": "1", "geo": "3"}, {"utc": "2027-03-04T01:00:00+01:00", "value": "2", "geo": "3"}], "duplicate_keys"),
    2051: ([{"utc": DAY, "value": "1", "geo": "3"}, {"utc": DAY, "value": "2", "geo": "8"}], None),
    77: ([{"utc": DAY, "value": "1"}], "unregistered"),
}


def test_an_indicator_fails_as_a_whole_and_alone(spark):
    rows = [{**r, "id": i} for i, (batch, _) in BATCHES.items() for r in batch]
    norm = ingest.normalise(items(spark, rows))
    checks = ingest.indicator_checks(norm)
    rejected = {r.indicator_id: r for r in ingest.rejected_indicators(checks).collect()}
    assert set(rejected) == {i if why != "unregistered" else None for i, (_, why) in BATCHES.items() if why}
    for i, (batch, why) in BATCHES.items():
        if why and why != "unregistered":
            assert rejected[i][why] == 1 and rejected[i].staged_rows == len(batch)
    kept = ingest.accepted(norm, ingest.rejected_indicators(checks)).collect()
    assert sorted((r.indicator_id, r.geo_id) for r in kept) == [(600, 0), (2051, 3), (2051, 8)]
    status = {r.indicator_id: r for r in ingest.run_status(spark, checks).collect()}
    assert len(status) == 8 and {r.run_status for r in status.values()} == {1}
    for i, r in status.items():
        batch, why = BATCHES.get(i, ([], None))
        assert (r.staged_rows, r.failed, r.loaded_rows) == (len(batch), why is not None, 0 if why else len(batch))


def test_an_unregistered_id_alone_fails_the_run(spark):
    checks = ingest.indicator_checks(ingest.normalise(items(spark, [{"id": 77, "utc": DAY, "value": "1"}])))
    assert {(r.failed, r.run_status) for r in ingest.run_status(spark, checks).collect()} == {(False, 1)}
    none = ingest.indicator_checks(ingest.normalise(items(spark, [])))
    assert {(r.failed, r.run_status) for r in ingest.run_status(spark, none).collect()} == {(False, 0)}


def test_answers_revise_each_other_and_duplicates_are_judged_within_one(spark):
    a, b, c = ({"doc": d, "at": t} for d, t in (("a", "2027-03-05"), ("b", "2027-03-06"), ("c", "2027-03-06")))
    rows = [
        {"utc": DAY, "value": "1", **a}, {"utc": DAY, "value": "2", **b}, {"utc": "2027-03-05", "value": "3", **b},
        {"utc": "2027-03-06", "value": "4", **a}, {"utc": "2027-03-06", "value": None, **b},
        {"utc": "2027-03-07", "value": "5", **c}, {"utc": "2027-03-07", "value": "6", **b},
        {"id": 2038, "utc": DAY, "value": "1", **a}, {"id": 2038, "utc": DAY, "value": "1", **a},
    ]
    norm = ingest.normalise(items(spark, rows))
    rejected = ingest.rejected_indicators(ingest.indicator_checks(norm))
    assert [(r.indicator_id, r.duplicate_keys) for r in rejected.collect()] == [(2038, 1)]
    got = {r.datetime_utc.day: r.value for r in ingest.accepted(norm, rejected).collect()}
    assert got == {4: Decimal(2), 5: Decimal(3), 6: None, 7: Decimal(5)}


def test_checks_read_the_batch_once_and_the_batch_is_not_shuffled_on_ids(spark):
    norm = ingest.normalise(items(spark, [{"utc": DAY, "value": "1"}]))
    checks = ingest.indicator_checks(norm)
    status = ingest.run_status(spark, checks)._jdf.queryExecution().executedPlan().toString()
    assert status.count("Scan ExistingRDD") == 2  # the batch and the registry
    load = ingest.accepted(norm, ingest.rejected_indicators(checks))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in load and "SortMergeJoin" not in load


@pytest.mark.parametrize(
    "start,end,today,want",
    [
        ("2027-05-01", "2027-05-03", None, ((2027, 5, 1), (2027, 5, 4))),
        ("2027-05-01", None, (2027, 6, 9), ((2027, 6, 7), (2027, 6, 9))),
        (None, None, (2027, 3, 1), ((2027, 2, 27), (2027, 3, 1))),
    ],
)
def test_windows(start, end, today, want):
    got = ingest.extraction_window(start, end, today=dt.date(*today) if today else None)
    assert got == tuple(dt.datetime(*w) for w in want)


def test_the_window_is_half_open(spark):
    times = ["2027-04-30T23:59:59", "2027-05-01T00:00:00", "2027-05-03T23:59:59", "2027-05-04T00:00:00"]
    df = spark.createDataFrame([(600, instant(t), 3, None) for t in times], "indicator_id int, datetime_utc timestamp, geo_id int, value decimal(18,6)")
    got = ingest.window_filter(df, *ingest.extraction_window("2027-05-01", "2027-05-03")).collect()
    assert sorted(r.datetime_utc for r in got) == [instant(t) for t in times[1:3]]


DOCUMENTS = [
    # JSON text, items, bad document
    ('{"indicator": {"values": [{"value": 9.75, "datetime_utc": "2027-03-04T00:00:00Z", "geo_id": 8}]}}', 1, 0),
    ('{"indicator": {"values": []}}', 0, 0),
    ('{"indicator": {"values": null}}', 0, 0),
    ('{"indicator": null}', 0, 0),
    ('{"unrelated": true}', 0, 0),
    ('{"indicator": {"values": [{"value": 1, "datetime_utc": "2027-03', 1, 1),
    ("[3, 4]", 1, 1),
    ("plain", 1, 1),
]


def test_documents(spark):
    docs = spark.createDataFrame([(i, text) for i, (text, _, _) in enumerate(DOCUMENTS)], "indicator_id int, payload string")
    found = payload.explode_payload(payload.parse_payload(docs)).collect()
    for i, (_, n, bad) in enumerate(DOCUMENTS):
        own = [r for r in found if r.indicator_id == i]
        assert len(own) == n and sum(r.bad_doc for r in own) == bad, DOCUMENTS[i]
    assert [(r.value, r.geo_id) for r in found if r.indicator_id == 0] == [("9.75", "8")]
