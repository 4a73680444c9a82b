"""Model semantics on hand-made rows: calendars, NULL vs 0, guards, rounding, buckets."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gridmart.operators import marts, reports, staging
from gridmart.plans.models import build_models

D = Decimal
T = dt.datetime
OBS_SCHEMA = "indicator_id int, datetime_utc timestamp, geo_id int, value decimal(18,6)"
PRICE, WIND, COAL, CC, HYDRO, SOLAR, COGEN = 600, 2038, 2040, 2041, 2042, 2044, 2051


def obs(spark, rows):
    return spark.createDataFrame([(i, t, g, None if v is None else D(str(v))) for i, t, g, v in rows], OBS_SCHEMA)


def hour_rows(ts, price=50, gen=None, geo=3):
    """One priced hour at ``ts`` plus generation readings {indicator: value}."""
    rows = [] if price is None else [(PRICE, ts, geo, price)]
    for ind, v in (gen or {COAL: 100}).items():
        rows.append((ind, ts, geo, v))
    return rows


def fct_by_hour(spark, rows):
    return {r.hour_utc: r for r in build_models(obs(spark, rows)).fct_hourly_market.collect()}


def test_price_is_mean_and_generation_is_sum(spark):
    t = T(2024, 1, 3, 10, 0)
    rows = [
        (PRICE, t, 3, 10), (PRICE, t.replace(minute=10), 3, 20), (PRICE, t.replace(minute=20), 3, None),
        (PRICE, t, 1, 999),  # other geography
        (WIND, t, 3, 5), (WIND, t.replace(minute=10), 3, 7), (COAL, t, 3, 1),
        (10004, t, 3, 1000),  # total indicator is not used
    ]
    m = build_models(obs(spark, rows))
    (p,) = m.hourly_price.collect()
    assert p.price_eur_mwh == D(15)
    (g,) = m.hourly_generation.collect()
    assert (g.wind_mwh, g.coal_mwh, g.total_mwh, g.hydro_mwh) == (D(12), D(1), D(13), None)
    long = {r.indicator_id: r.value_mwh for r in m.generation_long.collect()}
    assert long == {WIND: D(12), COAL: D(1)}


def test_spring_clock_change(spark):
    a, b = T(2024, 3, 31, 0, 0), T(2024, 3, 31, 1, 0)
    f = fct_by_hour(spark, hour_rows(a.replace(minute=30)) + hour_rows(b))
    assert f[a].hour_madrid == T(2024, 3, 31, 1, 0) and f[a].hour_of_day == 1
    assert f[b].hour_madrid == T(2024, 3, 31, 3, 0) and f[b].hour_of_day == 3


def test_autumn_clock_change_keeps_two_rows(spark):
    a, b = T(2024, 10, 27, 0, 0), T(2024, 10, 27, 1, 0)
    f = fct_by_hour(spark, hour_rows(a) + hour_rows(b))
    assert len(f) == 2
    assert f[a].hour_madrid == f[b].hour_madrid == T(2024, 10, 27, 2, 0)


def test_utc_and_local_day_edge(spark):
    t = T(2024, 6, 30, 22, 30)
    (r,) = fct_by_hour(spark, hour_rows(t)).values()
    assert r.hour_utc == T(2024, 6, 30, 22, 0)
    assert r.date_utc == dt.date(2024, 6, 30)
    assert (r.month, r.hour_of_day, r.year) == (7, 0, 2024)


def test_sunday_is_zero(spark):
    rows = hour_rows(T(2024, 1, 7, 12, 0))
    m = build_models(obs(spark, rows))
    assert m.fct_hourly_market.collect()[0].day_of_week == 0
    assert m.daily_summary.collect()[0].day_of_week == 0


def test_missing_technology_is_null_but_zero_in_renewables(spark):
    t = T(2024, 2, 1, 5, 0)
    (r,) = fct_by_hour(spark, hour_rows(t, gen={SOLAR: 30, COAL: 70})).values()
    assert r.wind_mwh is None and r.hydro_mwh is None
    assert r.renewable_mwh == D(30) and r.renewable_pct == D("30.0")


def test_share_guards_hourly_vs_daily(spark):
    zero_day, neg_day = T(2024, 2, 2, 5, 0), T(2024, 2, 3, 5, 0)
    rows = hour_rows(zero_day, gen={WIND: 5, COAL: -5}) + hour_rows(neg_day, gen={WIND: 5, COAL: -10})
    m = build_models(obs(spark, rows))
    f = {r.hour_utc: r for r in m.fct_hourly_market.collect()}
    assert f[zero_day].renewable_pct is None and f[neg_day].renewable_pct is None
    d = {r.date_utc: r for r in m.daily_summary.collect()}
    assert d[zero_day.date()].renewable_pct is None
    assert d[neg_day.date()].renewable_pct == D("-100.0")


def test_unmatched_hours_do_not_reach_the_fact(spark):
    gen_only = T(2024, 2, 4, 1, 0)
    price_only = T(2024, 2, 4, 2, 0)
    both = T(2024, 2, 4, 3, 0)
    rows = hour_rows(gen_only, price=None) + [(PRICE, price_only, 3, 40)] + hour_rows(both)
    m = build_models(obs(spark, rows))
    assert set(fct_by_hour(spark, rows)) == {both}
    market = {r.hour_utc: r for r in m.hourly_market.collect()}
    assert market[price_only].total_mwh is None and market[price_only].renewable_mwh == D(0)
    assert gen_only not in market


def test_rounding_ties_half_away_from_zero(spark):
    day = T(2024, 2, 5, 0, 0)
    rows = hour_rows(day, price=D("-0.54")) + hour_rows(day.replace(hour=1), price=D("-0.55"))
    (d,) = build_models(obs(spark, rows)).daily_summary.collect()
    assert d.avg_price_eur_mwh == D("-0.55")
    assert d.price_range_eur_mwh == D("0.01")
    assert d.negative_price_hours == 2


def daily_rows(spark, rows):
    """Hand-made daily mart rows: (date, avg_price, pct, negative_hours, wind, total)."""
    schema = ("date_utc date, avg_price_eur_mwh decimal(20,2), renewable_pct decimal(20,1), "
              "negative_price_hours bigint, wind_mwh decimal(30,0), total_mwh decimal(30,0)")
    df = spark.createDataFrame(
        [(d, None if p is None else D(str(p)), None if s is None else D(str(s)), n, D(w), D(t))
         for d, p, s, n, w, t in rows], schema)
    zero = F.lit(None).cast("decimal(30,0)")
    return df.select(
        "*", F.year("date_utc").alias("year"), F.month("date_utc").alias("month"),
        F.lit(0).alias("day_of_week"), F.col("avg_price_eur_mwh").alias("min_price_eur_mwh"),
        F.col("avg_price_eur_mwh").alias("max_price_eur_mwh"), zero.alias("solar_pv_mwh"),
        F.col("wind_mwh").alias("hydro_mwh"), zero.alias("coal_mwh"), zero.alias("combined_cycle_mwh"),
        zero.alias("cogen_residues_mwh"), F.col("wind_mwh").alias("renewable_mwh"),
    )


@pytest.mark.parametrize(
    "price,bucket",
    [("-0.01", "< 0 €"), ("0", "0-25 €"), ("25", "25-50 €"), ("50", "50-75 €"), ("75", "75-100 €"), ("100", "> 100 €")],
)
def test_price_bucket_edges(spark, price, bucket):
    daily = daily_rows(spark, [(dt.date(2024, 1, 1), price, 10, 0, 1, 1)])
    assert marts.price_impact(daily).collect()[0].price_bucket == bucket


@pytest.mark.parametrize(
    "pct,bucket,high",
    [("19.9", "0-20%", False), ("20", "20-40%", False), ("40", "40-60%", False), ("60", "60-80%", False),
     ("70", "60-80%", False), ("70.1", "60-80%", True), ("80", "> 80%", True)],
)
def test_share_bucket_edges(spark, pct, bucket, high):
    daily = daily_rows(spark, [(dt.date(2024, 1, 1), 10, pct, 1, 1, 1)])
    r = marts.price_impact(daily).collect()[0]
    assert (r.renewable_bucket, r.high_renewable_day, r.had_negative_prices) == (bucket, high, True)


def test_impact_drops_days_without_price_or_share(spark):
    daily = daily_rows(spark, [(dt.date(2024, 1, 1), None, 10, 0, 1, 1), (dt.date(2024, 1, 2), 5, None, 0, 1, 1),
                               (dt.date(2024, 1, 3), 5, 10, 0, 1, 1)])
    assert [r.date_utc for r in marts.price_impact(daily).collect()] == [dt.date(2024, 1, 3)]


def test_monthly_mix_reads_rounded_daily_values(spark):
    daily = daily_rows(spark, [(dt.date(2024, 1, 1), "1.01", "10.1", 2, 1, 3), (dt.date(2024, 1, 2), "2.02", "20.2", 0, 2, 3)])
    (m,) = marts.technology_mix(daily).collect()
    assert m.month_utc == dt.date(2024, 1, 1)
    assert (m.wind_mwh, m.total_mwh, m.wind_pct) == (D(3), D(6), D("50.0"))
    assert m.avg_price_eur_mwh == D("1.52")  # mean 1.515 -> half away from zero
    assert m.avg_renewable_pct == D("15.2")  # mean 15.15
    assert (m.total_negative_price_hours, m.negative_price_days) == (2, 1)


def test_latest_month_mix_keeps_null_shares(spark):
    rows = (hour_rows(T(2024, 1, 10, 0, 0), gen={WIND: 1, COAL: 1, CC: 1, HYDRO: 1, SOLAR: 1, COGEN: 1})
            + hour_rows(T(2024, 2, 10, 0, 0), gen={WIND: 1, CC: 1, HYDRO: 1, SOLAR: 1, COGEN: 1}))
    mix = build_models(obs(spark, rows)).technology_mix
    out = {r.tecnologia: r.porcentaje for r in reports.mix_last_month(mix).collect()}
    assert len(out) == 6 and out["Carbón"] is None and out["Eólica"] == D("20.0")


def test_report_window_bounds(spark):
    as_of = dt.date(2024, 3, 31)
    days = [as_of - dt.timedelta(days=31), as_of - dt.timedelta(days=30), as_of]
    daily = daily_rows(spark, [(d, 10, 10, 1, 1, 1) for d in days])
    got = [r.date_utc for r in reports.price_last_days(daily, as_of=as_of).collect()]
    assert got == days[1:]
    (k,) = reports.kpis_window(daily, as_of=as_of).collect()
    assert k.horas_precio_negativo == 2 and k.precio_medio == D("10.00")


def test_staging_filters_other_geographies(spark):
    t = T(2024, 1, 3, 10, 0)
    assert staging.hourly_price(obs(spark, [(PRICE, t, 1, 5)])).count() == 0


def test_fused_market_equals_join_form(spark):
    from gridmart.operators import market
    from gridmart.sources import fixtures

    from data_paths import SF01

    raw = fixtures.load_observations(spark, SF01)
    joined = market.hourly_market(staging.hourly_price(raw), staging.hourly_generation(raw))
    fused = market.hourly_market_from_raw(raw)
    assert joined.schema == fused.schema
    assert joined.exceptAll(fused).count() == 0 and fused.exceptAll(joined).count() == 0
    assert fused.count() == 973
