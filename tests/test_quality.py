"""Data-quality checks: freshness edges, unique / not_null counting."""

import datetime as dt

import pytest

from gridmart.operators import quality

NOW = dt.datetime(2025, 1, 10, 12, 0)
H = dt.timedelta(hours=1)
S = dt.timedelta(seconds=1)


@pytest.mark.parametrize(
    "age,status",
    [(36 * H, "pass"), (36 * H + S, "warn"), (72 * H, "warn"), (72 * H + S, "error")],
)
def test_freshness_thresholds_are_strict(spark, age, status):
    raw = spark.createDataFrame([(NOW - age - 5 * H,), (NOW - age,)], "extracted_at timestamp")
    (r,) = quality.freshness(raw, as_of=NOW).collect()
    assert r.status == status and r.max_loaded_at == NOW - age


def test_freshness_of_empty_table_is_error(spark):
    raw = spark.createDataFrame([], "extracted_at timestamp")
    assert quality.freshness(raw, as_of=NOW).first().status == "error"


def test_unique_counts_duplicated_values_not_rows(spark):
    df = spark.createDataFrame([(1, None), (1, 1), (1, 1), (2, None), (3, 1), (3, 1), (None, 1), (None, 1)], "k int, v int")
    out = {(r.column_name, r.test_name): r.failures for r in quality.model_checks(df, "m", ["k", "v"], "k").collect()}
    assert out == {("k", "unique"): 2, ("k", "not_null"): 2, ("v", "not_null"): 2}


def test_not_null_counts_in_one_pass(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, 4)], "a int, b int")
    out = {r.column_name: r.failures for r in quality.model_checks(df, "m", ["a", "b"]).collect()}
    assert out == {"a": 1, "b": 2}
    plan = quality.model_checks(df, "m", ["a", "b"], "a")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ") == 1


def test_empty_tables_have_no_failures(spark):
    empty = spark.createDataFrame([], "k int")
    assert [r.failures for r in quality.model_checks(empty, "m", ["k"], "k").collect()] == [0, 0]


def test_table_exists(spark, scratch):
    assert not quality.table_exists(spark, f"{scratch}/nothing-here")
    spark.range(1).write.parquet(f"{scratch}/t")
    assert quality.table_exists(spark, f"{scratch}/t")
