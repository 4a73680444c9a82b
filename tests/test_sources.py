"""Sources: technology seed CSV, catalogue search, raw-table provisioning."""

from gridmart.operators import staging
from gridmart.schemas import TECHNOLOGY_SEED_CSV
from gridmart.sources import payload, tables


def test_technology_seed_csv_round_trip(spark, scratch):
    path = f"{scratch}/technologies.csv"
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(TECHNOLOGY_SEED_CSV)
    from_csv = staging.technologies(spark, path)
    builtin = staging.technologies(spark)
    assert [(f.name, f.dataType) for f in from_csv.schema] == [(f.name, f.dataType) for f in builtin.schema]
    assert sorted(from_csv.collect()) == sorted(builtin.collect())
    renewable = {r.indicator_id for r in builtin.where("is_renewable").collect()}
    assert renewable == {2038, 2042, 2044}
    assert builtin.where("indicator_id = 2038").first().technology_name == "Eólica"


def test_catalogue_search_is_case_insensitive_and_sorted(spark):
    docs = spark.createDataFrame(
        [('{"indicators": [{"id": 3, "name": "Generación eólica"}, {"id": 1, "name": "Precio"}, {"id": 2}]}',),
         ('{"indicators": [{"id": 0, "name": "GENERACIÓN solar"}]}',)],
        "payload string",
    )
    entries = payload.explode_catalogue(payload.parse_catalogue(docs))
    assert [r.id for r in payload.search_catalogue(entries, "generación").collect()] == [0, 3]
    assert [r.id for r in payload.search_catalogue(entries, None).collect()] == [0, 1, 2, 3]
    assert [r.id for r in payload.search_catalogue(entries, "").collect()] == [0, 1, 2, 3]


def test_provision_is_idempotent(spark, scratch):
    path = f"{scratch}/raw"
    assert not tables.raw_exists(spark, path)
    tables.provision_raw(spark, path)
    tables.provision_raw(spark, path)
    df = tables.read_raw(spark, path)
    assert df.count() == 0
    assert df.columns == ["indicator_id", "datetime_utc", "geo_id", "value", "extracted_at", "updated_at",
                          "obs_date"]


def test_utc_literal_ignores_the_driver_time_zone(spark):
    import datetime as dt
    import os
    import time

    from gridmart.functions.calendar import utc_literal

    naive = dt.datetime(2025, 1, 2, 6, 15)
    prev = os.environ.get("TZ")
    os.environ["TZ"] = "America/New_York"
    time.tzset()
    try:
        got = spark.range(1).select(utc_literal(naive).cast("timestamp_ntz").alias("t")).first().t
    finally:
        if prev is None:
            os.environ.pop("TZ")
        else:
            os.environ["TZ"] = prev
        time.tzset()
    assert got == naive  # the UTC wall clock, not shifted by the driver's offset
