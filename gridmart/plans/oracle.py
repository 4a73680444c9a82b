"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written directly from the models' SQL semantics, in DuckDB's dialect, over the
same pre-registered parquet views. DuckDB's ``avg`` and decimal division return
DOUBLE, so exact values are recovered by casting to a wide decimal before
rounding (``round(cast(avg(x) as decimal(28,10)), n)``); shares are decided on
integers (``share``); final numeric outputs are
DOUBLE, instants naive UTC TIMESTAMP, like the Spark side.
"""

from __future__ import annotations

# Observation fixture (same mapping as gridmart.sources.fixtures).
OBS = """
obs_id AS (
  SELECT event_id,
         ([600, 2038, 2040, 2041, 2042, 2044, 2051, 10004])[event_id % 8 + 1] AS indicator_id,
         CAST(ts AS TIMESTAMP) + to_days(CAST(30 * (event_id // 8 % 12) AS INTEGER)) AS datetime_utc,
         CASE WHEN event_id % 5 = 0 THEN 1 ELSE 3 END AS geo_id,
         CAST(CASE WHEN event_id % 37 = 0 THEN NULL
                   WHEN event_id % 8 = 0 THEN CAST(value AS DECIMAL(18,6)) - 20
                   ELSE CAST(value AS DECIMAL(18,6)) END AS DECIMAL(18,6)) AS value
  FROM events
),
obs AS (SELECT indicator_id, datetime_utc, geo_id, value FROM obs_id)
"""

def share(part: str, total: str) -> str:
    """Percentage to one digit, half away from zero, on whole millionths (no quotient is rounded twice)."""
    p, t = (f"CAST(abs({x}) * 1000000 AS HUGEINT)" for x in (part, total))
    return (f"CAST(CASE WHEN ({total}) <> 0 THEN (CASE WHEN (({part}) < 0) <> (({total}) < 0) THEN -1 ELSE 1 END)"
            f" * ((2000 * {p} + {t}) // (2 * {t})) END AS DECIMAL(20,0)) / 10.0")


MODELS = f"""
hourly_price AS (
  SELECT date_trunc('hour', datetime_utc) AS hour_utc,
         CAST(avg(value) AS DECIMAL(22,10)) AS price_eur_mwh
  FROM obs
  WHERE indicator_id = 600 AND geo_id = 3 AND value IS NOT NULL
  GROUP BY date_trunc('hour', datetime_utc)
),
generation_long AS (
  SELECT date_trunc('hour', datetime_utc) AS hour_utc, indicator_id, sum(value) AS value_mwh
  FROM obs
  WHERE indicator_id IN (2038, 2040, 2041, 2042, 2044, 2051) AND geo_id = 3
  GROUP BY 1, 2
),
hourly_generation AS (
  SELECT hour_utc,
         sum(value_mwh) FILTER (WHERE indicator_id = 2038) AS wind_mwh,
         sum(value_mwh) FILTER (WHERE indicator_id = 2040) AS coal_mwh,
         sum(value_mwh) FILTER (WHERE indicator_id = 2041) AS combined_cycle_mwh,
         sum(value_mwh) FILTER (WHERE indicator_id = 2042) AS hydro_mwh,
         sum(value_mwh) FILTER (WHERE indicator_id = 2044) AS solar_pv_mwh,
         sum(value_mwh) FILTER (WHERE indicator_id = 2051) AS cogen_residues_mwh,
         sum(value_mwh) AS total_mwh
  FROM generation_long
  GROUP BY hour_utc
),
hourly_market AS (
  SELECT p.hour_utc, p.price_eur_mwh,
         g.wind_mwh, g.solar_pv_mwh, g.hydro_mwh, g.coal_mwh, g.combined_cycle_mwh,
         g.cogen_residues_mwh, g.total_mwh,
         coalesce(g.wind_mwh, 0) + coalesce(g.solar_pv_mwh, 0) + coalesce(g.hydro_mwh, 0) AS renewable_mwh,
         CASE WHEN g.total_mwh > 0 THEN
           {share('coalesce(g.wind_mwh, 0) + coalesce(g.solar_pv_mwh, 0) + coalesce(g.hydro_mwh, 0)', 'g.total_mwh')}
         END AS renewable_pct
  FROM hourly_price p LEFT JOIN hourly_generation g ON p.hour_utc = g.hour_utc
),
fct AS (
  SELECT hour_utc,
         (hour_utc AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Madrid' AS hour_madrid,
         CAST(hour_utc AS DATE) AS date_utc,
         CAST(extract(hour FROM (hour_utc AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Madrid') AS INTEGER) AS hour_of_day,
         CAST(extract(dow FROM (hour_utc AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Madrid') AS INTEGER) AS day_of_week,
         CAST(extract(month FROM (hour_utc AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Madrid') AS INTEGER) AS month,
         CAST(extract(year FROM (hour_utc AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Madrid') AS INTEGER) AS year,
         price_eur_mwh, wind_mwh, solar_pv_mwh, hydro_mwh, coal_mwh, combined_cycle_mwh,
         cogen_residues_mwh, total_mwh, renewable_mwh, renewable_pct
  FROM hourly_market
  WHERE price_eur_mwh IS NOT NULL AND total_mwh IS NOT NULL
),
daily AS (
  SELECT date_utc,
         CAST(extract(year FROM date_utc) AS INTEGER) AS year,
         CAST(extract(month FROM date_utc) AS INTEGER) AS month,
         CAST(extract(dow FROM date_utc) AS INTEGER) AS day_of_week,
         round(CAST(avg(price_eur_mwh) AS DECIMAL(28,10)), 2) AS avg_price_eur_mwh,
         round(min(price_eur_mwh), 2) AS min_price_eur_mwh,
         round(max(price_eur_mwh), 2) AS max_price_eur_mwh,
         round(sum(wind_mwh), 0) AS wind_mwh,
         round(sum(solar_pv_mwh), 0) AS solar_pv_mwh,
         round(sum(hydro_mwh), 0) AS hydro_mwh,
         round(sum(coal_mwh), 0) AS coal_mwh,
         round(sum(combined_cycle_mwh), 0) AS combined_cycle_mwh,
         round(sum(cogen_residues_mwh), 0) AS cogen_residues_mwh,
         round(sum(total_mwh), 0) AS total_mwh,
         round(sum(renewable_mwh), 0) AS renewable_mwh,
         {share('sum(renewable_mwh)', 'sum(total_mwh)')} AS renewable_pct,
         count(*) FILTER (WHERE price_eur_mwh < 0) AS negative_price_hours,
         round(max(price_eur_mwh) - min(price_eur_mwh), 2) AS price_range_eur_mwh
  FROM fct
  GROUP BY date_utc
),
impact AS (
  SELECT date_utc, year, month, avg_price_eur_mwh, renewable_pct,
         wind_mwh, solar_pv_mwh, hydro_mwh, renewable_mwh, total_mwh,
         CASE WHEN avg_price_eur_mwh < 0 THEN '< 0 €'
              WHEN avg_price_eur_mwh < 25 THEN '0-25 €'
              WHEN avg_price_eur_mwh < 50 THEN '25-50 €'
              WHEN avg_price_eur_mwh < 75 THEN '50-75 €'
              WHEN avg_price_eur_mwh < 100 THEN '75-100 €'
              ELSE '> 100 €' END AS price_bucket,
         CASE WHEN renewable_pct < 20 THEN '0-20%'
              WHEN renewable_pct < 40 THEN '20-40%'
              WHEN renewable_pct < 60 THEN '40-60%'
              WHEN renewable_pct < 80 THEN '60-80%'
              ELSE '> 80%' END AS renewable_bucket,
         negative_price_hours > 0 AS had_negative_prices,
         renewable_pct > 70 AS high_renewable_day
  FROM daily
  WHERE avg_price_eur_mwh IS NOT NULL AND renewable_pct IS NOT NULL
),
mix AS (
  SELECT CAST(date_trunc('month', date_utc) AS DATE) AS month_utc, year, month,
         round(sum(wind_mwh), 0) AS wind_mwh,
         round(sum(solar_pv_mwh), 0) AS solar_pv_mwh,
         round(sum(hydro_mwh), 0) AS hydro_mwh,
         round(sum(coal_mwh), 0) AS coal_mwh,
         round(sum(combined_cycle_mwh), 0) AS combined_cycle_mwh,
         round(sum(cogen_residues_mwh), 0) AS cogen_residues_mwh,
         round(sum(total_mwh), 0) AS total_mwh,
         round(sum(renewable_mwh), 0) AS renewable_mwh,
         round(CAST(avg(avg_price_eur_mwh) AS DECIMAL(28,10)), 2) AS avg_price_eur_mwh,
         round(CAST(avg(renewable_pct) AS DECIMAL(28,10)), 1) AS avg_renewable_pct,
         {share('sum(wind_mwh)', 'sum(total_mwh)')} AS wind_pct,
         {share('sum(solar_pv_mwh)', 'sum(total_mwh)')} AS solar_pv_pct,
         {share('sum(hydro_mwh)', 'sum(total_mwh)')} AS hydro_pct,
         {share('sum(coal_mwh)', 'sum(total_mwh)')} AS coal_pct,
         {share('sum(combined_cycle_mwh)', 'sum(total_mwh)')} AS combined_cycle_pct,
         {share('sum(cogen_residues_mwh)', 'sum(total_mwh)')} AS cogen_residues_pct,
         CAST(sum(negative_price_hours) AS BIGINT) AS total_negative_price_hours,
         count(*) FILTER (WHERE negative_price_hours > 0) AS negative_price_days
  FROM daily
  GROUP BY 1, 2, 3
),
as_of AS (SELECT max(date_utc) AS d FROM daily)
"""


def _with(body: str) -> str:
    return f"WITH {OBS.strip()},\n{MODELS.strip()}\n{body.strip()}\n"


def d(expr: str, alias: str | None = None) -> str:
    """Decimal/numeric expression -> DOUBLE output column."""
    return f"CAST({expr} AS DOUBLE) AS {alias or expr}"


def r6(expr: str, alias: str) -> str:
    """Unrounded mean -> rounded to 6 decimals, as DOUBLE."""
    return f"CAST(round(CAST({expr} AS DECIMAL(28,10)), 6) AS DOUBLE) AS {alias}"


GEN = ["wind_mwh", "solar_pv_mwh", "hydro_mwh", "coal_mwh", "combined_cycle_mwh", "cogen_residues_mwh", "total_mwh"]
MWH8 = GEN + ["renewable_mwh"]
PCT6 = ["wind_pct", "solar_pv_pct", "hydro_pct", "coal_pct", "combined_cycle_pct", "cogen_residues_pct"]


def _cols(*items: str) -> str:
    return ",\n       ".join(items)


DAILY = (
    "SELECT "
    + _cols("date_utc", "year", "month", "day_of_week", d("avg_price_eur_mwh"), d("min_price_eur_mwh"),
            d("max_price_eur_mwh"), *[d(c) for c in MWH8], d("renewable_pct"), "negative_price_hours",
            d("price_range_eur_mwh"))
    + " FROM daily"
)

SQL: dict[str, str] = {
    "hourly_price": _with(f"SELECT hour_utc, {r6('price_eur_mwh', 'price_eur_mwh')} FROM hourly_price"),
    "generation_long": _with(f"SELECT hour_utc, indicator_id, {d('value_mwh')} FROM generation_long"),
    "hourly_generation": _with(
        "SELECT " + _cols("hour_utc", *[d(c) for c in GEN]) + " FROM hourly_generation"
    ),
    "hourly_market": _with(
        "SELECT "
        + _cols("hour_utc", r6("price_eur_mwh", "price_eur_mwh"), *[d(c) for c in GEN],
                d("renewable_mwh"), d("renewable_pct"))
        + " FROM hourly_market"
    ),
    "fct_hourly_market": _with(
        "SELECT "
        + _cols("hour_utc", "hour_madrid", "date_utc", "hour_of_day", "day_of_week", "month", "year",
                r6("price_eur_mwh", "price_eur_mwh"), *[d(c) for c in GEN], d("renewable_mwh"),
                d("renewable_pct"))
        + " FROM fct"
    ),
    "daily_summary": _with(DAILY),
    "price_impact": _with(
        "SELECT "
        + _cols("date_utc", "year", "month", d("avg_price_eur_mwh"), d("renewable_pct"), d("wind_mwh"),
                d("solar_pv_mwh"), d("hydro_mwh"), d("renewable_mwh"), d("total_mwh"), "price_bucket",
                "renewable_bucket", "had_negative_prices", "high_renewable_day")
        + " FROM impact"
    ),
    "technology_mix": _with(
        "SELECT "
        + _cols("month_utc", "year", "month", *[d(c) for c in MWH8], d("avg_price_eur_mwh"),
                d("avg_renewable_pct"), *[d(c) for c in PCT6], "total_negative_price_hours",
                "negative_price_days")
        + " FROM mix ORDER BY month_utc"
    ),
    "kpis_window": _with(
        """SELECT CAST(round(CAST(avg(avg_price_eur_mwh) AS DECIMAL(28,10)), 2) AS DOUBLE) AS precio_medio,
                  CAST(round(max(max_price_eur_mwh), 2) AS DOUBLE) AS precio_max,
                  CAST(round(min(min_price_eur_mwh), 2) AS DOUBLE) AS precio_min,
                  CAST(round(CAST(avg(renewable_pct) AS DECIMAL(28,10)), 1) AS DOUBLE) AS pct_renovable_medio,
                  CAST(sum(negative_price_hours) AS BIGINT) AS horas_precio_negativo
           FROM daily WHERE date_utc >= (SELECT d FROM as_of) - INTERVAL 30 DAY"""
    ),
    "price_last_days": _with(
        "SELECT date_utc, " + _cols(d("avg_price_eur_mwh"), d("renewable_pct"))
        + " FROM daily WHERE date_utc >= (SELECT d FROM as_of) - INTERVAL 30 DAY ORDER BY date_utc"
    ),
    "mix_last_month": _with(
        """, latest AS (SELECT * FROM mix WHERE month_utc = (SELECT max(month_utc) FROM mix))
           SELECT 'Eólica' AS tecnologia, CAST(wind_pct AS DOUBLE) AS porcentaje FROM latest
           UNION ALL SELECT 'Solar FV', CAST(solar_pv_pct AS DOUBLE) FROM latest
           UNION ALL SELECT 'Hidráulica', CAST(hydro_pct AS DOUBLE) FROM latest
           UNION ALL SELECT 'Carbón', CAST(coal_pct AS DOUBLE) FROM latest
           UNION ALL SELECT 'Ciclo combinado', CAST(combined_cycle_pct AS DOUBLE) FROM latest
           UNION ALL SELECT 'Cogeneración', CAST(cogen_residues_pct AS DOUBLE) FROM latest"""
    ),
    "price_daily": _with(
        "SELECT " + _cols("date_utc", d("avg_price_eur_mwh"), d("min_price_eur_mwh"), d("max_price_eur_mwh"),
                          "negative_price_hours", d("renewable_pct"))
        + " FROM daily ORDER BY date_utc"
    ),
    "price_heatmap": _with(
        f"SELECT hour_of_day, day_of_week, {r6('avg(price_eur_mwh)', 'avg_price')} FROM fct "
        "GROUP BY hour_of_day, day_of_week ORDER BY day_of_week, hour_of_day"
    ),
    "price_monthly": _with(
        "SELECT CAST(date_trunc('month', date_utc) AS DATE) AS month_utc, "
        + _cols(r6("avg(avg_price_eur_mwh)", "avg_price"), r6("avg(renewable_pct)", "avg_renewable_pct"))
        + " FROM daily GROUP BY 1 ORDER BY 1"
    ),
    "impact_points": _with(
        "SELECT " + _cols("date_utc", d("avg_price_eur_mwh"), d("renewable_pct"), d("wind_mwh"),
                          d("solar_pv_mwh"), d("hydro_mwh"), "renewable_bucket", "price_bucket",
                          "had_negative_prices", "high_renewable_day")
        + " FROM impact ORDER BY date_utc"
    ),
    "price_by_bucket": _with(
        """SELECT renewable_bucket,
                  CAST(round(CAST(avg(avg_price_eur_mwh) AS DECIMAL(28,10)), 2) AS DOUBLE) AS avg_price,
                  count(*) AS dias
           FROM impact GROUP BY renewable_bucket ORDER BY renewable_bucket"""
    ),
    "negative_price_days": _with(
        "SELECT " + _cols("date_utc", d("avg_price_eur_mwh"), d("renewable_pct"), "had_negative_prices")
        + " FROM impact WHERE had_negative_prices = true ORDER BY date_utc"
    ),
    "mix_monthly_pct": _with(
        "SELECT " + _cols("month_utc", *[d(c) for c in PCT6], d("avg_renewable_pct"), d("avg_price_eur_mwh"),
                          "negative_price_days")
        + " FROM mix ORDER BY month_utc"
    ),
    "mix_monthly_mwh": _with(
        "SELECT " + _cols("month_utc", *[d(c) for c in GEN[:-1]]) + " FROM mix ORDER BY month_utc"
    ),
}


# --- ingest ----------------------------------------------------------------------

REGISTRY = """
registry(indicator_id, slug) AS (VALUES
  (600, 'spot_market_price'), (2038, 'generation_wind'), (2040, 'generation_coal'),
  (2041, 'generation_combined_cycle'), (2042, 'generation_hydro'), (2044, 'generation_solar_pv'),
  (2051, 'generation_cogen_residues'), (10004, 'generation_total'))
"""

INGEST = """
items AS (
  SELECT event_id, indicator_id,
         CASE WHEN indicator_id = 10004 AND event_id % 101 = 0 AND event_id % 3 = 0 THEN 'n/a'
              WHEN indicator_id = 10004 AND event_id % 101 = 0 THEN CAST(value AS VARCHAR) || '1'
              ELSE CAST(value AS VARCHAR) END AS value,
         CASE WHEN event_id % 6 = 0 THEN strftime(datetime_utc, '%Y-%m-%dT%H:%M:%S.%f') END AS datetime,
         CASE WHEN indicator_id = 2051 AND event_id % 103 = 0
                THEN (['not-a-date', '12:34', '2024', 'T10:00', '2024-01-01T10:00:00 Europe/Madrid', '2024-1-1'])[event_id % 6 + 1]
              WHEN event_id % 6 = 0 THEN ''
              WHEN event_id % 6 = 2 THEN strftime(datetime_utc, '%Y%m%dT%H%M%S.%fZ')
              WHEN event_id % 6 = 1 THEN strftime(datetime_utc, '%Y-%m-%dT%H:%M:%S.%f+00:00')
              ELSE strftime(datetime_utc, '%Y-%m-%dT%H:%M:%S.%fZ') END AS datetime_utc,
         CASE WHEN event_id % 9 <> 0 THEN geo_id END AS geo_id,
         datetime_utc AS src_ts, indicator_id = 2051 AND event_id % 103 = 0 AS no_time
  FROM obs_id
  UNION ALL
  SELECT event_id, indicator_id, CAST(value + 1 AS VARCHAR), NULL,
         strftime(datetime_utc, '%Y-%m-%dT%H:%M:%S.%fZ'),
         CASE WHEN event_id % 9 <> 0 THEN geo_id END, datetime_utc, false
  FROM obs_id WHERE indicator_id = 2040 AND event_id % 89 = 0
),
norm AS (
  SELECT indicator_id,
         CASE WHEN no_time THEN NULL ELSE src_ts END AS datetime_utc,
         coalesce(geo_id, 0) AS geo_id,
         try_cast(value AS DECIMAL(18,6)) AS value,
         no_time AS bad_time,
         value IS NOT NULL AND (try_cast(value AS DECIMAL(18,6)) IS NULL OR regexp_matches(value, '[.][0-9]{7}$')) AS bad_value,
         false AS bad_geo,
         false AS bad_doc
  FROM items
),
dups AS (
  SELECT indicator_id, datetime_utc, geo_id, count(*) AS copies
  FROM norm WHERE datetime_utc IS NOT NULL
  GROUP BY 1, 2, 3 HAVING count(*) > 1
),
checks AS (
  SELECT c.indicator_id, c.staged_rows, c.bad_times, c.bad_values, c.bad_geos, c.bad_docs,
         coalesce(d.duplicate_keys, 0) AS duplicate_keys,
         c.indicator_id IS NULL
           OR c.indicator_id NOT IN (600, 2038, 2040, 2041, 2042, 2044, 2051, 10004)
           OR c.bad_docs > 0 OR c.bad_times > 0 OR c.bad_values > 0 OR c.bad_geos > 0
           OR coalesce(d.duplicate_keys, 0) > 0 AS failed
  FROM (SELECT indicator_id, count(*) AS staged_rows,
               count(*) FILTER (WHERE bad_time) AS bad_times,
               count(*) FILTER (WHERE bad_value) AS bad_values,
               count(*) FILTER (WHERE bad_geo) AS bad_geos,
               count(*) FILTER (WHERE bad_doc) AS bad_docs
        FROM norm GROUP BY 1) c
  LEFT JOIN (SELECT indicator_id, count(*) AS duplicate_keys FROM dups GROUP BY 1) d USING (indicator_id)
),
""" + REGISTRY.strip()

UPSERT = """
tgt AS (
  SELECT indicator_id, datetime_utc, geo_id, value,
         TIMESTAMP '2025-01-02 06:15:00' AS extracted_at, TIMESTAMP '2025-01-02 06:15:00' AS updated_at
  FROM obs_id WHERE event_id % 3 <> 0
),
src AS (
  SELECT indicator_id, datetime_utc, geo_id,
         CAST(CASE WHEN event_id % 11 = 0 THEN NULL
                   WHEN value IS NULL THEN 1.5
                   WHEN event_id % 7 = 0 THEN value + 1
                   ELSE value END AS DECIMAL(18,6)) AS value
  FROM obs_id WHERE event_id % 3 <> 1
),
merge_plan AS (
  SELECT coalesce(t.indicator_id, s.indicator_id) AS indicator_id,
         coalesce(t.datetime_utc, s.datetime_utc) AS datetime_utc,
         coalesce(t.geo_id, s.geo_id) AS geo_id,
         CASE WHEN s.indicator_id IS NOT NULL THEN s.value ELSE t.value END AS value,
         coalesce(t.extracted_at, TIMESTAMP '2025-01-03 06:15:00') AS extracted_at,
         CASE WHEN t.indicator_id IS NULL
                OR (s.indicator_id IS NOT NULL AND t.value IS DISTINCT FROM s.value)
              THEN TIMESTAMP '2025-01-03 06:15:00' ELSE t.updated_at END AS updated_at,
         CASE WHEN t.indicator_id IS NULL THEN 'insert'
              WHEN s.indicator_id IS NOT NULL AND t.value IS DISTINCT FROM s.value THEN 'update'
              ELSE 'keep' END AS op,
         s.indicator_id IS NOT NULL AS staged
  FROM tgt t FULL OUTER JOIN src s
    ON t.indicator_id = s.indicator_id AND t.datetime_utc = s.datetime_utc AND t.geo_id = s.geo_id
)
"""


def _with_all(body: str) -> str:
    return (f"WITH {OBS.strip()},\n{MODELS.strip()},\n{INGEST.strip()},\n{UPSERT.strip()}\n"
            f"{body.strip()}\n")


def _not_null(model: str, rel: str, col: str) -> str:
    return (f"SELECT '{model}' AS model, '{col}' AS column_name, 'not_null' AS test_name, "
            f"count(*) FILTER (WHERE {col} IS NULL) AS failures FROM {rel}")


def _unique(model: str, rel: str, col: str) -> str:
    return (f"SELECT '{model}', '{col}', 'unique', (SELECT count(*) FROM (SELECT {col} FROM {rel} "
            f"WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1))")


def _planted(name: str, rel: str, group: str, twice: int, null: int, *columns: str) -> str:
    nulls = ", ".join(f"NULL AS {c}" for c in columns)
    return (f"{name} AS (SELECT * FROM {rel} UNION ALL SELECT * FROM {rel} WHERE {group} = {twice} "
            f"UNION ALL SELECT * REPLACE ({nulls}) FROM {rel} WHERE {group} = {null})")


_CHECKS = [
    _not_null("indicator_values", "raw_fx", "indicator_id"),
    _not_null("indicator_values", "raw_fx", "datetime_utc"),
    _not_null("indicator_values", "raw_fx", "geo_id"),
    _not_null("indicator_values", "raw_fx", "extracted_at"),
    _unique("fct_hourly_market", "fct_p", "hour_utc"),
    _not_null("fct_hourly_market", "fct_p", "hour_utc"),
    _not_null("fct_hourly_market", "fct_p", "price_eur_mwh"),
    _not_null("fct_hourly_market", "fct_p", "renewable_pct"),
    _unique("mart_daily_summary", "daily_p", "date_utc"),
    _not_null("mart_daily_summary", "daily_p", "date_utc"),
    _not_null("mart_daily_summary", "daily_p", "avg_price_eur_mwh"),
    _not_null("mart_daily_summary", "daily_p", "renewable_pct"),
    _unique("mart_renewables_price_impact", "impact_p", "date_utc"),
    _not_null("mart_renewables_price_impact", "impact_p", "date_utc"),
    _not_null("mart_renewables_price_impact", "impact_p", "renewable_pct"),
    _unique("mart_technology_mix", "mix_p", "month_utc"),
    _not_null("mart_technology_mix", "mix_p", "month_utc"),
]

SQL.update({
    "payload_explode": _with_all(
        "SELECT indicator_id, value, datetime, datetime_utc, CAST(geo_id AS VARCHAR) AS geo_id, false AS bad_doc "
        "FROM items"
    ),
    "normalise": _with_all(
        "SELECT indicator_id, datetime_utc, geo_id, CAST(value AS DOUBLE) AS value, bad_time, bad_value, "
        "bad_geo, bad_doc FROM norm"
    ),
    "ingest_rejects": _with_all(
        "SELECT indicator_id, staged_rows, bad_times, bad_values, bad_geos, bad_docs, duplicate_keys "
        "FROM checks WHERE failed"
    ),
    "duplicate_keys": _with_all("SELECT indicator_id, datetime_utc, geo_id, copies FROM dups"),
    "accepted": _with_all(
        "SELECT indicator_id, datetime_utc, geo_id, CAST(value AS DOUBLE) AS value FROM norm "
        "WHERE indicator_id NOT IN (SELECT indicator_id FROM checks WHERE failed)"
    ),
    "run_status": _with_all(
        """SELECT r.indicator_id, r.slug,
                  coalesce(c.staged_rows, 0) AS staged_rows,
                  CASE WHEN c.failed THEN 0 ELSE coalesce(c.staged_rows, 0) END AS loaded_rows,
                  coalesce(c.failed, false) AS failed,
                  (SELECT CAST(coalesce(max(CAST(failed AS INTEGER)), 0) AS INTEGER) FROM checks) AS run_status
           FROM registry r LEFT JOIN checks c USING (indicator_id)"""
    ),
    "window_filter": _with_all(
        "SELECT indicator_id, datetime_utc, geo_id, CAST(value AS DOUBLE) AS value FROM obs "
        "WHERE datetime_utc >= TIMESTAMP '2024-03-01 00:00:00' AND datetime_utc < TIMESTAMP '2024-07-01 00:00:00'"
    ),
    "registry_coverage": _with_all(
        """SELECT r.indicator_id, r.slug, coalesce(s.observations, 0) AS observations,
                  coalesce(s.valued, 0) AS valued, s.first_utc, s.last_utc
           FROM registry r LEFT JOIN (
             SELECT indicator_id, count(*) AS observations, count(value) AS valued,
                    min(datetime_utc) AS first_utc, max(datetime_utc) AS last_utc
             FROM obs GROUP BY indicator_id) s USING (indicator_id)"""
    ),
    "catalogue_search": """
        SELECT id, name FROM (
          SELECT event_id AS id,
                 CASE WHEN event_id % 13 <> 0
                      THEN concat_ws(' ', event_type, CAST(user_id AS VARCHAR), props) END AS name
          FROM events)
        WHERE contains(lower(coalesce(name, '')), 'click')
        ORDER BY id
    """,
    "upsert": _with_all(
        "SELECT indicator_id, datetime_utc, geo_id, CAST(value AS DOUBLE) AS value, extracted_at, updated_at "
        "FROM merge_plan"
    ),
    "upsert_counts": _with_all(
        """SELECT indicator_id, count(*) AS staged_rows,
                  count(*) FILTER (WHERE op = 'insert') AS inserted,
                  count(*) FILTER (WHERE op = 'update') AS updated,
                  count(*) FILTER (WHERE op = 'keep') AS unchanged
           FROM merge_plan WHERE staged GROUP BY indicator_id"""
    ),
    "freshness": _with_all(
        """, agg AS (SELECT max(extracted_at) AS m FROM merge_plan),
           aged AS (SELECT m, t, epoch_us(t) - epoch_us(m) AS age FROM agg,
             (VALUES (TIMESTAMP '2025-01-03 07:00:00'), (TIMESTAMP '2025-01-05 06:15:00'), (TIMESTAMP '2025-01-10 06:15:00')) v(t))
           SELECT m AS max_loaded_at, t AS snapshotted_at, CAST(age / 1000000.0 AS DOUBLE) AS age_seconds,
                  CASE WHEN m IS NULL OR age > 72 * 3600000000 THEN 'error'
                       WHEN age > 36 * 3600000000 THEN 'warn' ELSE 'pass' END AS status
           FROM aged"""
    ),
    "refetch_overlap": _with_all(
        """, twice AS (SELECT DISTINCT indicator_id FROM obs_id WHERE indicator_id = 2040 AND event_id % 3 = 0 AND event_id % 29 = 0)
           SELECT indicator_id, datetime_utc, geo_id,
                  CAST(CASE WHEN event_id % 3 <> 0 THEN value
                            WHEN event_id % 11 = 0 THEN NULL ELSE coalesce(value, 0) + 1 END AS DOUBLE) AS value
           FROM obs_id WHERE indicator_id NOT IN (SELECT indicator_id FROM twice)
           UNION ALL
           SELECT indicator_id, datetime_utc + INTERVAL 400 DAY, geo_id, CAST(value AS DOUBLE) FROM obs_id
           WHERE event_id % 3 = 1 AND event_id % 5 = 2 AND indicator_id NOT IN (SELECT indicator_id FROM twice)"""
    ),
    "data_checks": _with_all(
        ", raw_0 AS (SELECT *, TIMESTAMP '2025-01-02 06:15:00' AS extracted_at FROM obs),\n"
        + ",\n".join([
            _planted("raw_fx", "raw_0", "geo_id", 0, 1, "indicator_id", "datetime_utc", "geo_id", "extracted_at"),
            _planted("fct_p", "fct", "hour_of_day", 3, 5, "hour_utc", "price_eur_mwh", "renewable_pct"),
            _planted("daily_p", "daily", "day_of_week", 2, 4, "date_utc", "avg_price_eur_mwh", "renewable_pct"),
            _planted("impact_p", "impact", "month", 3, 5, "date_utc", "renewable_pct"),
            _planted("mix_p", "mix", "month", 2, 4, "month_utc"),
        ])
        + "\n" + "\nUNION ALL ".join(_CHECKS)
    ),
})
# --- several answers per indicator ---------------------------------------------------

ANSWERS = """
given AS (
  SELECT indicator_id, datetime_utc, geo_id, value, indicator_id = 2051 AND event_id % 31 = 7 AS bad, 'a' AS doc, DATE '2025-01-02' AS day FROM obs_id
  UNION ALL SELECT indicator_id, datetime_utc, geo_id, value, false, 'a', DATE '2025-01-02' FROM obs_id WHERE indicator_id = 2040 AND event_id % 29 = 2
  UNION ALL SELECT indicator_id, datetime_utc, geo_id, CASE WHEN event_id % 11 <> 0 THEN coalesce(value, 0) + 1 END, false, 'b', DATE '2025-01-03'
  FROM obs_id WHERE event_id % 3 = 0
  UNION ALL SELECT indicator_id, datetime_utc, geo_id, value, false, 'b', DATE '2025-01-03'
  FROM obs_id WHERE indicator_id = 2041 AND event_id % 3 = 0 AND event_id % 29 = 3
  UNION ALL SELECT indicator_id, datetime_utc, geo_id, coalesce(value, 0) + 2, false, 'c', DATE '2025-01-04'
  FROM obs_id WHERE indicator_id = 2040 OR (indicator_id = 2051 AND datetime_utc < TIMESTAMP '2024-07-01 00:00:00')),
repeated AS (SELECT DISTINCT indicator_id, doc FROM (
  SELECT indicator_id, doc FROM given GROUP BY indicator_id, doc, datetime_utc, geo_id HAVING count(*) > 1)),
answers AS (
  SELECT g.indicator_id, g.doc, any_value(g.day) AS day, CAST(min(datetime_utc) AS DATE) AS first_day, CAST(max(datetime_utc) AS DATE) AS last_day,
         bool_or(bad) OR any_value(r.doc) IS NOT NULL AS failed
  FROM given g LEFT JOIN repeated r ON g.indicator_id = r.indicator_id AND g.doc = r.doc GROUP BY g.indicator_id, g.doc),
uncovered AS (
  SELECT DISTINCT f.indicator_id, f.doc
  FROM (SELECT *, unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS d FROM answers WHERE failed) f
  WHERE NOT EXISTS (SELECT 1 FROM answers n WHERE NOT n.failed AND n.indicator_id = f.indicator_id AND n.day > f.day
                    AND f.d >= n.first_day AND f.d <= n.last_day))
"""

VERSIONED = "\nUNION ALL ".join(
    f"SELECT indicator_id, datetime_utc, geo_id, CASE WHEN event_id % 13 <> {every} THEN value + {more} END AS value, DATE '{day}' AS fetch_day "
    f"FROM obs_id WHERE event_id % {every} = 0"
    for day, every, more in (("2025-01-02", 1, 0), ("2025-01-03", 2, 1), ("2025-01-04", 3, 1), ("2025-01-05", 5, 0))
)

LOADED = """
loaded AS (
  SELECT indicator_id, datetime_utc, geo_id, value, day AS fetch_day, max(doc = 'c') OVER k AS first_run
  FROM given WHERE (indicator_id, doc) IN (SELECT (indicator_id, doc) FROM answers WHERE NOT failed)
  WINDOW k AS (PARTITION BY indicator_id, datetime_utc, geo_id)
  QUALIFY row_number() OVER (PARTITION BY indicator_id, datetime_utc, geo_id ORDER BY day DESC) = 1)
"""


def _with_loaded(body: str) -> str:
    """The models over what the answers load."""
    source = OBS.strip().rsplit("obs AS (", 1)[0]
    obs = "obs AS (SELECT indicator_id, datetime_utc, geo_id, value FROM loaded)"
    return f"WITH {source}{ANSWERS.strip()},\n{LOADED.strip()},\n{obs},\n{MODELS.strip()}\n{body.strip()}\n"


_STORED_CHECKS = [
    *(_not_null("indicator_values", "raw_0", c) for c in ("indicator_id", "datetime_utc", "geo_id", "extracted_at")),
    _unique("fct_hourly_market", "fct", "hour_utc"),
    *(_not_null("fct_hourly_market", "fct", c) for c in ("hour_utc", "price_eur_mwh", "renewable_pct")),
    _unique("mart_daily_summary", "daily", "date_utc"),
    *(_not_null("mart_daily_summary", "daily", c) for c in ("date_utc", "avg_price_eur_mwh", "renewable_pct")),
    _unique("mart_renewables_price_impact", "impact", "date_utc"),
    *(_not_null("mart_renewables_price_impact", "impact", c) for c in ("date_utc", "renewable_pct")),
    _unique("mart_technology_mix", "mix", "month_utc"),
    _not_null("mart_technology_mix", "mix", "month_utc"),
]

SQL.update({
    "stored_window": _with_loaded(
        """SELECT indicator_id, datetime_utc, geo_id, CAST(value AS DOUBLE) AS value, fetch_day,
                  CASE WHEN first_run THEN TIMESTAMP '2025-01-02 06:15:00' ELSE TIMESTAMP '2025-01-03 06:15:00' END AS extracted_at
           FROM loaded WHERE datetime_utc >= TIMESTAMP '2024-03-01 00:00:00' AND datetime_utc < TIMESTAMP '2024-07-01 00:00:00'"""
    ),
    "stored_daily": _with_loaded(DAILY),
    "stored_checks": _with_loaded(
        ", raw_0 AS (SELECT *, TIMESTAMP '2025-01-02 06:15:00' AS extracted_at FROM obs)\n" + "\nUNION ALL ".join(_STORED_CHECKS)
    ),
    "answer_status": f"""WITH {OBS.strip()},\n{ANSWERS.strip()},\n{REGISTRY.strip()},
        counted AS (
          SELECT a.indicator_id, count(*) AS answers, count(*) FILTER (WHERE failed) AS failed_answers,
                 count(*) FILTER (WHERE failed AND u.doc IS NULL) AS superseded_answers
          FROM answers a LEFT JOIN uncovered u ON a.indicator_id = u.indicator_id AND a.doc = u.doc GROUP BY a.indicator_id)
        SELECT r.indicator_id, slug, coalesce(answers, 0) AS answers, coalesce(failed_answers, 0) AS failed_answers,
               coalesce(superseded_answers, 0) AS superseded_answers, coalesce(failed_answers > superseded_answers, false) AS failed,
               (SELECT CAST(coalesce(max(CAST(failed_answers > superseded_answers AS INTEGER)), 0) AS INTEGER) FROM counted) AS run_status
        FROM registry r LEFT JOIN counted c USING (indicator_id)""",
    "accepted_answers": f"""WITH {OBS.strip()},\n{ANSWERS.strip()}
        SELECT indicator_id, datetime_utc, geo_id, CAST(value AS DOUBLE) AS value, day AS fetch_day
        FROM given WHERE (indicator_id, doc) IN (SELECT (indicator_id, doc) FROM answers WHERE NOT failed)
        QUALIFY row_number() OVER (PARTITION BY indicator_id, datetime_utc, geo_id ORDER BY day DESC) = 1""",
    "upsert_versioned": f"""WITH {OBS.strip()}, versioned AS ({VERSIONED})
        SELECT indicator_id, datetime_utc, geo_id, CAST(value AS DOUBLE) AS value, fetch_day FROM versioned
        QUALIFY row_number() OVER (PARTITION BY indicator_id, datetime_utc, geo_id ORDER BY fetch_day DESC) = 1""",
})

SQL["upsert_clustered"], SQL["upsert_clustered_counts"] = SQL["upsert"], SQL["upsert_counts"]
SQL["hourly_market_join"] = SQL["hourly_market"]
