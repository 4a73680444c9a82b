"""Answers in any order and grouping: the newest fetch wins, and a bad answer stands until newer ones cover it."""

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridmart.operators import ingest, upsert
from gridmart.plans import warehouse
from gridmart.schemas import RAW_VERSIONED
from gridmart.sources import payload, tables
from gridmart.streaming import ingest_stream
from test_recovery import answer, land, raw_rows

NOW = dt.datetime(2027, 2, 1, 6)
ITEMS = "indicator_id int, value string, datetime string, datetime_utc string, geo_id string, bad_doc boolean, fetched_at string, document string"


def items(spark, answers):
    """answers: (indicator, document, fetched_at, [(day of January, value)])"""
    rows = [
        (ind, value, None, None if day is None else f"2027-01-{day:02d}T00:00:00Z", "3", False, at, doc)
        for ind, doc, at, values in answers
        for day, value in values
    ]
    return spark.createDataFrame(rows, ITEMS)


def stored(spark, root):
    """Keys, values and versions (audit columns tell when runs happened)."""
    raw = tables.read_raw(spark, warehouse.Layout(root).raw, versions=True)
    return sorted((r.indicator_id, r.datetime_utc.day, r.value, r.version) for r in raw.collect())


def load(spark, root, batches):
    results = [warehouse.ingest_items(spark, items(spark, b), warehouse.Layout(root), NOW) for b in batches]
    return results


ANSWERS = [
    (600, "w", "2027-01-03", [(1, "1"), (2, "2"), (3, "3")]),
    (600, "x", "2027-01-04", [(2, "20"), (3, "3"), (4, None)]),
    (600, "y", "2027-01-05", [(3, "3"), (4, "4")]),
    (600, "z", "2027-01-05 2027-01-01T00:00:00", [(4, "40"), (1, "1")]),
]


def test_any_order_and_grouping_gives_one_table(spark, scratch):
    want = [(1, Decimal(1)), (2, Decimal(20)), (3, Decimal(3)), (4, Decimal(40))]
    tables_ = []
    for k, (order, cuts) in enumerate((((0, 1, 2, 3), (4,)), ((1, 3, 0, 2), (1, 2, 4)))):
        batches = [[ANSWERS[i] for i in order[a:b]] for a, b in zip((0, *cuts), cuts, strict=False)]
        load(spark, f"{scratch}/{k}", batches)
        tables_.append(stored(spark, f"{scratch}/{k}"))
    assert tables_[0] == tables_[1] and [(d, v) for _, d, v, _ in tables_[0]] == want


def test_an_older_answer_is_kept_out_and_a_newer_one_moves_the_version_on(spark, scratch):
    a, b, c = ((600, d, f"2027-01-0{n}", [(1, v)]) for d, n, v in (("a", 3, "1"), ("b", 4, "2"), ("c", 5, "1")))
    first, again, late = load(spark, f"{scratch}/wh", [[a], [c], [b]])
    assert first.changed_days == [dt.date(2027, 1, 1)] and again.changed_days == late.changed_days == []
    assert (again.counts[0]["unchanged"], late.counts[0]["unchanged"], late.counts[0]["updated"]) == (1, 1, 0)
    ((_, _, value, version),) = stored(spark, f"{scratch}/wh")
    row = tables.read_raw(spark, warehouse.Layout(f"{scratch}/wh").raw, versions=True).select(ingest.version_day(F.col("version"))).first()
    assert value == 1 and row[0] == dt.date(2027, 1, 5) and version is not None


def test_versions_sort_by_fetch_then_file_time(spark):
    rows = [
        ("", "a"), (" 2026-01-01T00:00:00", "a"), (" 2027-01-01T00:00:00", "a"), ("2026-12-31", "a"), ("2026-12-31 2020-01-01T00:00:00.000001", "a"),
        ("2027-01-01 2019-01-01T00:00:00", "a"), ("2027-01-02", "z"),
    ]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, at string, doc string")
    got = df.select("k", ingest.version_of(F.col("at"), F.col("doc")).alias("v")).orderBy("v").collect()
    assert [r.k for r in got] == list(range(len(rows))) and len({r.v for r in got}) == len(rows)
    unnamed = spark.createDataFrame([(None, None)], "at string, doc string").select(ingest.version_of(F.col("at"), F.col("doc")))
    assert unnamed.first()[0] is None


VERSIONS = st.lists(st.tuples(st.integers(0, 3), st.integers(1, 6), st.one_of(st.none(), st.integers(0, 2))), min_size=1, max_size=12)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=VERSIONS, cut=st.integers(1, 6))
def test_merges_keep_the_newest_version(spark, rows, cut):
    """rows: (key, version, value); both merge forms, batch by batch, against a model of the table."""
    schema = "indicator_id int, datetime_utc timestamp, geo_id int, value decimal(18,6), version decimal(38,0)"
    best = {}
    for key, version, value in rows:
        best.setdefault((key, version), value)
    table = [(600, dt.datetime(2027, 1, 1), k, None if v is None else Decimal(v), Decimal(n)) for (k, n), v in best.items()]
    for form in (0, 1):
        target = spark.createDataFrame([], RAW_VERSIONED)
        for start in range(0, len(table), cut):
            batch = spark.createDataFrame(table[start : start + cut], schema)
            newest = batch.groupBy("indicator_id", "datetime_utc", "geo_id").agg(F.max_by("value", "version").alias("value"), F.max("version").alias("version"))
            if form:
                plan = upsert.merge_plan(target, newest, NOW)
            else:
                day = F.to_date("datetime_utc")
                plan = upsert.merge_plan_clustered(target.withColumn("d", day), newest.withColumn("d", day), NOW, ["d"], 2)
            target = spark.createDataFrame(upsert.merged_table(plan).collect(), RAW_VERSIONED)
        got = {r.geo_id: (r.version, r.value) for r in target.collect()}
        want = {}
        for (k, n), v in best.items():
            want[k] = max(want.get(k, (-1, None)), (n, v), key=lambda x: x[0])
        assert got == {k: (Decimal(n), None if v is None else Decimal(v)) for k, (n, v) in want.items()}


def test_unversioned_batches_merge_in_the_order_of_runs(spark, scratch):
    load(spark, f"{scratch}/wh", [[ANSWERS[1]], [(600, None, None, [(2, "5"), (9, "9")])]])
    assert {d: v for _, d, v, _ in stored(spark, f"{scratch}/wh")} == {2: 5, 3: 3, 4: None, 9: 9}


# --- bad answers -----------------------------------------------------------------------

BAD, OTHER = [(1, "n/a"), (2, "2")], [(1, "7"), (1, "8"), (3, "3")]
CASES = {
    # by indicator: answers (document, fetch day, values), open failures, loaded values by day
    600: ([("a", 3, BAD), ("b", 4, [(1, "1"), (2, "2")])], [], {1: 1, 2: 2}),  # a bad old answer, then a good one
    2038: ([("a", 3, BAD), ("b", 4, [(1, "1")])], ["a"], {1: 1}),  # which covers only a part of it
    2040: ([("a", 3, BAD), ("b", 4, [(1, "1")]), ("c", 5, [(2, "5"), (3, "6")])], [], {1: 1, 2: 5, 3: 6}),  # two cover it together
    2041: ([("a", 4, BAD), ("b", 3, [(1, "1"), (2, "2")])], ["a"], {1: 1, 2: 2}),  # an older one does not
    2042: ([("a", 3, [(1, "1"), (2, "2")]), ("b", 4, OTHER)], ["b"], {1: 1, 2: 2}),  # a bad new answer leaves the old one
    2044: ([("a", 3, BAD), ("b", 4, OTHER), ("c", 5, [(1, "1"), (4, "4")])], [], {1: 1, 4: 4}),  # an answer stands for all days of its span
    2051: ([("a", 20, [(None, "1")]), ("b", 21, [(18, "1"), (19, "2")])], [], {18: 1, 19: 2}),  # no time at all: the days before its fetch
    10004: ([("a", 20, [(None, "1")]), ("b", 3, BAD), ("c", 21, [(19, "2")])], ["a", "b"], {19: 2}),
}


@pytest.mark.parametrize("grouping", ["together", "newest first"])
def test_bad_answers_stand_until_they_are_covered(spark, scratch, grouping):
    given = [(i, doc, f"2027-01-{day:02d}", values) for i, (answers, _, _) in CASES.items() for doc, day, values in answers]
    batches = [given] if grouping == "together" else [[a for a in given if a[1] in docs] for docs in ("bc", "a")]
    results = load(spark, f"{scratch}/wh", batches)
    left = warehouse.open_failures(spark, warehouse.Layout(f"{scratch}/wh")).collect()
    assert sorted((r.indicator_id, r.document) for r in left) == sorted((i, doc) for i, (_, docs, _) in CASES.items() for doc in docs)
    table = stored(spark, f"{scratch}/wh")
    assert {i: {d: v for k, d, v, _ in table if k == i} for i in CASES} == {i: loaded for i, (_, _, loaded) in CASES.items()}
    if grouping == "together":
        assert (results[0].status, sorted(results[0].failed)) == (1, sorted(i for i, (_, docs, _) in CASES.items() if docs))


def test_unknown_indicators_and_unreadable_documents(spark, scratch):
    land(f"{scratch}/l", 77, "a", answer(("2027-01-01T00:00:00Z", 1)), "2027-01-03")
    land(f"{scratch}/l", 600, "bad", '{"indicator": {"values": [', "2027-01-03")
    land(f"{scratch}/l", 600, "good", answer(("2027-01-01T00:00:00Z", 1), ("2027-01-02T00:00:00Z", 2)), "2027-01-04")
    result = warehouse.run(spark, f"{scratch}/l", f"{scratch}/wh", NOW)
    assert (result.status, result.failed) == (1, [None])
    assert [v for _, _, v in raw_rows(spark, f"{scratch}/wh")] == [1.0, 2.0]
    left = warehouse.open_failures(spark, warehouse.Layout(f"{scratch}/wh")).collect()
    assert [r.indicator_id for r in left] == [77]


def test_the_answer_log_does_not_grow_with_runs(spark, scratch):
    layout = warehouse.Layout(f"{scratch}/wh")
    for _ in range(2):
        load(spark, layout.root, [ANSWERS])
    assert spark.read.parquet(warehouse._answers_path(layout)).count() == len(ANSWERS)


@pytest.mark.parametrize("bound", [None, 1])
def test_a_later_fetch_wins_in_a_stream_even_with_an_earlier_file_time(spark, scratch, bound):
    landing, root = f"{scratch}/l", f"{scratch}/wh"
    land(landing, 600, "new", answer(("2027-01-01T00:00:00Z", 2)), "2027-01-04", at=1_800_000_000)
    land(landing, 600, "old", answer(("2027-01-01T00:00:00Z", 1)), "2027-01-03", at=1_800_000_100)
    land(landing, 600, "bad", answer(("2027-01-01T00:00:00Z", "n/a")), "2027-01-02", at=1_800_000_200)
    query = ingest_stream.start(spark, landing, root, refresh_marts=False, max_files_per_trigger=bound)
    query.awaitTermination()
    assert [v for _, _, v in raw_rows(spark, root)] == [2.0]
    assert warehouse.open_failures(spark, warehouse.Layout(root)).count() == 0
    assert [r.value for r in spark.read.parquet(ingest_stream.quarantine_path(root)).collect()] == ["n/a"]


def test_failed_answers_are_found_without_comparing_answers_pairwise(spark, scratch):
    land(f"{scratch}/l", 600, "a", answer(("2027-01-01T00:00:00Z", 1)), "2027-01-03")
    checks = ingest.answer_checks(ingest.normalise(payload.explode_payload(payload.read_payload_files(spark, f"{scratch}/l"))))
    plan = ingest.with_superseded(checks)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
