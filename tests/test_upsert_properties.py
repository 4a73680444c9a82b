"""Property-based: merge_plan equals a plain-Python model of the MERGE semantics."""

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from gridmart.operators import upsert

RUN0, RUN1 = dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 2)
KEYS = [(i, dt.datetime(2024, 1, 1, h), g) for i in (600, 2038) for h in range(3) for g in (1, 3)]
VALUES = st.one_of(st.none(), st.sampled_from([Decimal("0"), Decimal("1.5"), Decimal("-2.25")]))
BATCH = st.dictionaries(st.sampled_from(KEYS), VALUES, max_size=len(KEYS))


def model(target: dict, source: dict):
    out = {}
    for k, v in target.items():
        out[k] = (v, RUN0, RUN0)
    for k, v in source.items():
        if k not in target:
            out[k] = (v, RUN1, RUN1)
        elif target[k] != v:  # IS DISTINCT FROM (None == None is "not distinct")
            out[k] = (v, RUN0, RUN1)
    return out


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=BATCH, source=BATCH)
def test_merge_matches_model(spark, target, source):
    tgt = spark.createDataFrame(
        [(*k, v, RUN0, RUN0) for k, v in target.items()],
        "indicator_id int, datetime_utc timestamp, geo_id int, value decimal(18,6), "
        "extracted_at timestamp, updated_at timestamp",
    )
    src = spark.createDataFrame(
        [(*k, v) for k, v in source.items()],
        "indicator_id int, datetime_utc timestamp, geo_id int, value decimal(18,6)",
    )
    plan = upsert.merge_plan(tgt, src, RUN1)
    got = {(r.indicator_id, r.datetime_utc, r.geo_id): (r.value, r.extracted_at, r.updated_at)
           for r in upsert.merged_table(plan).collect()}
    assert got == model(target, source)
    # the join-free clustered form gives the same rows
    from pyspark.sql import functions as F

    day, bucket = F.to_date("datetime_utc").alias("d"), F.lit(0).alias("b")
    clustered = upsert.merge_plan_clustered(tgt.select("*", day, bucket), src.select("*", day, bucket), RUN1, ["d", "b"], 2)
    got2 = {(r.indicator_id, r.datetime_utc, r.geo_id): (r.value, r.extracted_at, r.updated_at)
            for r in clustered.collect()}
    assert got2 == got
    # merging the same batch again changes nothing
    again = upsert.merge_plan(upsert.merged_table(plan), src, RUN1 + dt.timedelta(days=1))
    assert {r.op for r in again.collect()} <= {"keep"}
