"""Marts by month: what a daily run rewrites, what a reader of the published tables sees."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from gridmart.__main__ import main
from gridmart.operators import market, quality, reports
from gridmart.plans import catalog, warehouse
from gridmart.sources import tables
from test_recovery import Lost, items_of

RUN_1, RUN_2 = dt.datetime(2027, 1, 5, 6), dt.datetime(2027, 1, 6, 6)


def day(date, price, power=100.0):
    """A price and wind of every second hour of a day."""
    out = []
    for h in range(0, 24, 2):
        at = f"{date}T{h:02d}:00:00Z"
        out += [(600, at, None if price is None else price + h), (2038, at, power + h)]
    return out


def files(layout):
    """Data files of the marts with their times."""
    found = {}
    for name in warehouse.MART_NAMES:
        for folder, _, names in os.walk(layout.mart(name)):
            found.update({os.path.join(folder, n): os.stat(os.path.join(folder, n)).st_mtime_ns for n in names if n.endswith(".parquet")})
    return found


def by_month(layout):
    """mart -> month folders and their files"""
    out = {}
    for path, at in files(layout).items():
        mart, _, rest = path.partition("/marts/")[2].partition("/")
        out.setdefault((mart, os.path.dirname(rest)), set()).add((os.path.basename(path), at))
    return out


def content(spark, layout):
    return {n: sorted(map(tuple, warehouse.read_mart(spark, layout, n).collect()), key=repr) for n in warehouse.MART_NAMES}


def clean(spark, root, layout):
    """The marts that a full build makes of the same raw table."""
    full = warehouse.mart_models(tables.read_raw(spark, layout.raw))
    return {n: sorted(map(tuple, df.collect()), key=repr) for n, df in full.items()}


JANUARY = [d for n in (1, 15, 31) for d in day(f"2027-01-{n:02d}", n)]
FIRST = JANUARY + [d for n in (1, 28) for d in day(f"2027-02-{n:02d}", 40 + n)] + day("2027-03-10", 7)


@pytest.fixture()
def built(spark, scratch):
    layout = warehouse.Layout(f"{scratch}/wh")
    warehouse.ingest_items(spark, items_of(spark, FIRST), layout, RUN_1)
    warehouse.refresh_marts(spark, layout)
    return layout


def revise(spark, layout, rows, at="2027-01-06"):
    result = warehouse.ingest_items(spark, items_of(spark, rows, "r", at), layout, RUN_2)
    warehouse.refresh_marts(spark, layout, result.changed_days)
    return result


def test_a_run_rewrites_the_months_of_its_days_only(spark, built):
    before = by_month(built)
    revise(spark, built, day("2027-02-28", 5) + day("2027-02-27", 6))
    after = by_month(built)
    changed = {key for key in before | after if before.get(key) != after.get(key)}
    # The last hours of 28 February UTC are of March on the local clock of the fact.
    months = {f"year=2027/month={m}" for m in (2, 3)}
    assert {k for k in changed if k[0] != "fct_hourly_market"} == {(n, "year=2027/month=2") for n in warehouse.MART_NAMES[1:]}
    assert {m for n, m in changed if n == "fct_hourly_market"} <= months and len(changed) >= 4
    assert content(spark, built) == clean(spark, "", built)


def test_month_ends_on_two_calendars_and_months_that_come_and_go(spark, built):
    revise(spark, built, day("2026-12-31", 3) + day("2027-01-31", 9) + day("2027-05-31", 1))
    assert content(spark, built) == clean(spark, "", built)
    assert (2027, 5) in warehouse.stored_months(spark, built.mart("mart_daily_summary"))
    revise(spark, built, day("2027-03-10", None), "2027-01-07")  # no price any more: the month has no rows
    assert content(spark, built) == clean(spark, "", built)
    assert (2027, 3) not in warehouse.stored_months(spark, built.mart("mart_technology_mix"))


@pytest.mark.parametrize("step", [0, 1, 2])
def test_a_refresh_that_dies_between_months_is_completed(spark, built, monkeypatch, step):
    """Dies in the fact (0), the daily mart (1) or the impact mart (2), with the month's folder gone."""
    calls, put = [], warehouse.put_months

    def dies(df, path, months):
        if len(calls) == step:
            fs, folder = tables.hadoop_fs(spark, f"{path}/year=2027/month=2")
            fs.delete(folder, True)
            raise Lost(path)
        calls.append(path)
        put(df, path, months)

    with monkeypatch.context() as m:
        m.setattr(warehouse, "put_months", dies)
        with pytest.raises(Lost):
            revise(spark, built, day("2027-02-28", 5))
    warehouse.refresh_marts(spark, built, [])
    assert content(spark, built) == clean(spark, "", built)
    assert warehouse.pending_days(spark, built) == [] and warehouse._unfinished_months(spark, built) == []


def scanned_files(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    nodes, out = [df._jdf.queryExecution().executedPlan()], []
    while nodes:
        node = nodes.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            nodes.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            nodes.append(node.plan())
        elif name == "FileSourceScanExec":
            out.append(node.metrics().get("numFiles").get().value())
        children = node.children()
        nodes += [children.apply(k) for k in range(children.size())]
    return out, plan


def test_the_report_window_reads_its_months_only(spark, built):
    daily = warehouse.read_mart(spark, built, "mart_daily_summary")
    count, plan = scanned_files(reports.kpis_window(daily, as_of=dt.date(2027, 2, 20)))
    assert count == [3] and "PartitionFilters" in plan  # January, February, March on; December and before are not read
    count, _ = scanned_files(reports.kpis_window(daily, as_of=dt.date(2027, 3, 20)))
    assert count == [2]
    latest = daily.agg(F.max("date_utc")).scalar()
    got = reports.kpis_window(daily, as_of=latest).first()
    days = [r for r in daily.collect() if r.date_utc >= dt.date(2027, 3, 10) - dt.timedelta(days=30)]
    assert got.precio_max == max(r.max_price_eur_mwh for r in days) and len(days) == 2
    count, plan = scanned_files(reports.price_last_days(daily, as_of=F.lit(dt.date(2027, 3, 10))))
    assert count == [2]


def test_readers_see_the_old_marts_or_the_new_ones(spark, built, monkeypatch):
    db, name = "gm_publish", "gm_publish.mart_daily_summary"
    catalog.publish(spark, built, db)
    old = sorted(map(tuple, spark.table(name).collect()))
    assert len(old) == 6
    running = spark.table(name)  # resolved before the refresh, read after it
    seen, put = [], warehouse.put_months

    def look(df, path, months):
        put(df, path, months)
        seen.append(sorted(map(tuple, spark.table(name).collect())))

    monkeypatch.setattr(warehouse, "put_months", look)
    revise(spark, built, day("2027-02-28", 5) + day("2027-02-27", 6))
    copies, write = [], catalog.copy_mart

    def look_too(*args):
        write(*args)
        copies.append(sorted(map(tuple, spark.table(name).collect())))

    monkeypatch.setattr(catalog, "copy_mart", look_too)
    catalog.publish(spark, built, db)
    assert len(seen) == 4 and len(copies) == 4 and all(x == old for x in seen + copies)
    new = sorted(map(tuple, spark.table(name).collect()))
    assert len(new) == 7 and sorted(map(tuple, running.collect())) == old
    want = sorted(map(tuple, warehouse.read_mart(spark, built, "mart_daily_summary").select(spark.table(name).columns).collect()))
    assert new == want
    catalog.publish(spark, built, db)
    folders = [f for f in os.listdir(f"{built.root}/published") if f.startswith("run-")]
    assert len(folders) == 2
    assert catalog.published_folder(spark, built).rsplit("/", 1)[1] in folders


def as_rows(df):
    return sorted(map(tuple, df.collect()))


def test_writes_measure_the_checks(spark, built, monkeypatch):
    """Observed while writing: equal to reading the tables, and the marts are not read again."""

    def counted():
        marts = {n: warehouse.read_mart(spark, built, n) for n in warehouse.MART_NAMES}
        return as_rows(quality.data_checks(tables.read_raw(spark, built.raw), marts))

    def no_scan(*args):
        raise AssertionError(args)

    assert len(counted()) == 17 and not any(r[3] for r in counted())
    with monkeypatch.context() as m:
        m.setattr(warehouse, "read_mart", no_scan)
        clean_rows = as_rows(warehouse.checks_report(spark, built)[0])
    assert clean_rows == counted()
    revise(spark, built, day("2027-02-27", 6, -14.0))  # totals of -14 to 8: some hours have no share
    with monkeypatch.context() as m:
        m.setattr(warehouse, "read_mart", no_scan)
        broken = as_rows(warehouse.checks_report(spark, built)[0])
    assert broken == counted() and {r[1]: r[3] for r in broken if r[0] == "fct_hourly_market" and r[2] == "not_null"}["renewable_pct"] == 8
    revise(spark, built, day("2027-02-27", 6) + day("2027-01-15", 3, -100.0), "2027-01-07")  # not known from the write alone: read once
    assert as_rows(warehouse.checks_report(spark, built)[0]) == counted()
    with monkeypatch.context() as m:
        m.setattr(warehouse, "read_mart", no_scan)
        assert as_rows(warehouse.checks_report(spark, built)[0])[0][3] >= 0


def test_observed_checks_find_duplicates_and_nulls(spark):
    rows = [(2027, 1, dt.date(2027, 1, d), v) for d, v in ((1, 1), (1, 2), (1, None), (2, 1), (3, 1), (3, None))] + [(2027, 2, None, 1), (2027, 2, None, 2)]
    df = spark.createDataFrame(rows, "year int, month int, date_utc date, renewable_pct int")
    placed, watch = quality.observed(df.repartition(*warehouse.MONTH), "mart_renewables_price_impact", warehouse.MONTH)
    assert placed._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert placed.count() == 8 and placed.columns == df.columns
    got = as_rows(quality.check_rows(spark, {"mart_renewables_price_impact": watch.get}))
    assert got == as_rows(quality.model_checks(df, "mart_renewables_price_impact", ["date_utc", "renewable_pct"], "date_utc"))
    assert {(r[1], r[2]): r[3] for r in got} == {("date_utc", "not_null"): 2, ("date_utc", "unique"): 2, ("renewable_pct", "not_null"): 2}


def test_hourly_tables_join_without_an_exchange(spark, built):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = catalog.store_hourly(spark, built, "gm_hourly", buckets=4)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan and plan.count("Bucketed: true") == 2
        want = market.hourly_market_from_raw(tables.read_raw(spark, built.raw).select("indicator_id", "datetime_utc", "geo_id", "value"))
        assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, want.select(joined.columns).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_extracts_from_the_command_line(spark, built, scratch, capsys):
    assert main(["--master", "local[4]", "export", "--root", built.root, "--out", f"{scratch}/out"]) == 0
    written = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert set(written) == set(warehouse.MART_NAMES)
    for name, path in written.items():
        got = spark.read.parquet(path)
        assert sorted(map(tuple, got.select(sorted(got.columns)).collect()), key=repr) == sorted(
            map(tuple, warehouse.read_mart(spark, built, name).select(sorted(got.columns)).collect()), key=repr
        )
