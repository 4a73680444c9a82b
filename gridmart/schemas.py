"""Schemas and fixed domain values.

Everything in the "fixed values" block must equal the source system's values
for results to be right (indicator ids, slugs, seed rows, bucket labels,
thresholds). They are stated once here and used everywhere else by name.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must match the source system exactly)
# ---------------------------------------------------------------------------

# Indicator registry: id -> slug.
INDICATORS: dict[int, str] = {
    600: "spot_market_price",
    2038: "generation_wind",
    2040: "generation_coal",
    2041: "generation_combined_cycle",
    2042: "generation_hydro",
    2044: "generation_solar_pv",
    2051: "generation_cogen_residues",
    10004: "generation_total",
}

PRICE_INDICATOR = 600
SPAIN_GEO = 3
DEFAULT_GEO = 0

# Generation indicator id -> output column of the hourly pivot, in the pivot's order.
GENERATION_COLUMNS: dict[int, str] = {
    2038: "wind_mwh",
    2040: "coal_mwh",
    2041: "combined_cycle_mwh",
    2042: "hydro_mwh",
    2044: "solar_pv_mwh",
    2051: "cogen_residues_mwh",
}
# Renewable = wind + solar PV + hydro.
RENEWABLE_COLUMNS = ("wind_mwh", "solar_pv_mwh", "hydro_mwh")

# Technology seed rows: indicator_id, technology_name, technology_group, is_renewable.
TECHNOLOGY_SEED_CSV = """indicator_id,technology_name,technology_group,is_renewable
2038,Eólica,Renovable,true
2040,Carbón,No renovable,false
2041,Ciclo combinado,No renovable,false
2042,Hidráulica,Renovable,true
2044,Solar fotovoltaica,Renovable,true
2051,Cogeneración y residuos,No renovable,false
"""

LOCAL_TZ = "Europe/Madrid"

# Daily price buckets: (exclusive upper bound, label); last label has no bound.
PRICE_BUCKETS = ((0, "< 0 €"), (25, "0-25 €"), (50, "25-50 €"), (75, "50-75 €"), (100, "75-100 €"))
PRICE_BUCKET_TOP = "> 100 €"
# Daily renewable-share buckets, same convention.
RENEWABLE_BUCKETS = ((20, "0-20%"), (40, "20-40%"), (60, "40-60%"), (80, "60-80%"))
RENEWABLE_BUCKET_TOP = "> 80%"
HIGH_RENEWABLE_PCT = 70

# Latest-month mix labels, in report order: (label, share column).
MIX_LABELS = (
    ("Eólica", "wind_pct"),
    ("Solar FV", "solar_pv_pct"),
    ("Hidráulica", "hydro_pct"),
    ("Carbón", "coal_pct"),
    ("Ciclo combinado", "combined_cycle_pct"),
    ("Cogeneración", "cogen_residues_pct"),
)

# Source freshness on extracted_at, in hours (strictly greater than = breach).
FRESHNESS_WARN_HOURS = 36
FRESHNESS_ERROR_HOURS = 72

# Automatic extraction window: [today - 2 days, today) at UTC midnight.
AUTO_WINDOW_DAYS = 2
REPORT_WINDOW_DAYS = 30

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

VALUE_TYPE = T.DecimalType(18, 6)
VERSION_TYPE = T.DecimalType(38, 0)

# One item of an indicator payload. ``value`` and ``geo_id`` are read as text on
# purpose so a malformed number is detectable (a numeric field would silently
# become NULL).
PAYLOAD_ITEM = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("datetime", T.StringType()),
        T.StructField("datetime_utc", T.StringType()),
        T.StructField("geo_id", T.StringType()),
    ]
)
PAYLOAD = T.StructType(
    [T.StructField("indicator", T.StructType([T.StructField("values", T.ArrayType(PAYLOAD_ITEM))]))]
)

CATALOGUE = T.StructType(
    [
        T.StructField(
            "indicators",
            T.ArrayType(
                T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
            ),
        )
    ]
)

# Normalised observation (staged batch).
OBSERVATION = T.StructType(
    [
        T.StructField("indicator_id", T.IntegerType(), False),
        T.StructField("datetime_utc", T.TimestampType(), False),
        T.StructField("geo_id", T.IntegerType(), False),
        T.StructField("value", VALUE_TYPE, True),
    ]
)

# Raw table = observation + audit columns; partitioned by obs_date (UTC day).
RAW_TABLE = T.StructType(
    OBSERVATION.fields
    + [
        T.StructField("extracted_at", T.TimestampType(), False),
        T.StructField("updated_at", T.TimestampType(), False),
    ]
)
# As stored: with the version of the answer that a row's value comes from (``ingest.version_of``), NULL where unknown.
RAW_VERSIONED = T.StructType(RAW_TABLE.fields + [T.StructField("version", VERSION_TYPE, True)])
RAW_KEYS = ("indicator_id", "datetime_utc", "geo_id")
RAW_PARTITION = "obs_date"

TECHNOLOGY = T.StructType(
    [
        T.StructField("indicator_id", T.IntegerType(), False),
        T.StructField("technology_name", T.StringType(), False),
        T.StructField("technology_group", T.StringType(), False),
        T.StructField("is_renewable", T.BooleanType(), False),
    ]
)
