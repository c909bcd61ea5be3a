"""Target schemas and drift specs of the raw inputs.

The rename maps key a lower-cased file column to its canonical name; the
target column order is the map order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (ArrayType, DataType, DateType, DoubleType, IntegerType, StringType, StructField, StructType,
                               TimestampNTZType)


def _fields(*cols: tuple[str, DataType]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in cols])


@dataclass(frozen=True)
class DriftSpec:
    """Target schema plus lower-cased source name -> target name."""
    schema: StructType
    rename: dict[str, str]


# File column names of the monthly trip files, lower-cased, with canonical names.
TRIP_RENAME = {
    "vendorid": "vendor_id", "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime", "passenger_count": "passenger_count",
    "trip_distance": "trip_distance", "ratecodeid": "ratecode_id", "store_and_fwd_flag": "store_and_fwd_flag",
    "pulocationid": "pu_location_id", "dolocationid": "do_location_id", "payment_type": "payment_type",
    "fare_amount": "fare_amount", "extra": "extra", "mta_tax": "mta_tax", "tip_amount": "tip_amount",
    "tolls_amount": "tolls_amount", "improvement_surcharge": "improvement_surcharge",
    "total_amount": "total_amount", "congestion_surcharge": "congestion_surcharge",
    "airport_fee": "airport_fee", "cbd_congestion_fee": "cbd_congestion_fee",
}

# Canonical trip columns and types. Wall-clock local times are kept as written: no zone (S-21).
TRIP_SCHEMA = _fields(
    ("vendor_id", IntegerType()), ("pickup_datetime", TimestampNTZType()),
    ("dropoff_datetime", TimestampNTZType()), ("passenger_count", IntegerType()),
    ("trip_distance", DoubleType()), ("ratecode_id", IntegerType()),
    ("store_and_fwd_flag", StringType()), ("pu_location_id", IntegerType()),
    ("do_location_id", IntegerType()), ("payment_type", IntegerType()),
    ("fare_amount", DoubleType()), ("extra", DoubleType()),
    ("mta_tax", DoubleType()), ("tip_amount", DoubleType()),
    ("tolls_amount", DoubleType()), ("improvement_surcharge", DoubleType()),
    ("total_amount", DoubleType()), ("congestion_surcharge", DoubleType()),
    ("airport_fee", DoubleType()), ("cbd_congestion_fee", DoubleType()),
)
TRIP_COLUMNS = TRIP_SCHEMA.fieldNames()
TRIP_DRIFT = DriftSpec(TRIP_SCHEMA, TRIP_RENAME)

# Columns of the zone master and of the code dictionary.
ZONE_SCHEMA = _fields(("location_id", IntegerType()), ("borough", StringType()),
                      ("zone", StringType()), ("service_zone", StringType()))
ZONE_DRIFT = DriftSpec(ZONE_SCHEMA, {"locationid": "location_id", "borough": "borough", "zone": "zone",
                                     "service_zone": "service_zone"})

CODE_SCHEMA = _fields(("code_type", StringType()), ("code", IntegerType()), ("description", StringType()))

# Variable names of the weather documents, and their column names here.
WEATHER_VARS = ["temperature_2m_max", "temperature_2m_min", "precipitation_sum", "snowfall_sum",
                "wind_speed_10m_max"]
WEATHER_TARGETS = ["temperature_max_c", "temperature_min_c", "precipitation_mm", "snowfall_cm",
                   "wind_speed_max_kmh"]
WEATHER_SCHEMA = _fields(("weather_date", DateType()), *[(t, DoubleType()) for t in WEATHER_TARGETS])
# Shape of a weather document: what is read of it; whatever else it has is left alone.
WEATHER_DOCUMENT = _fields(("daily", _fields(("time", ArrayType(StringType())),
                                             *[(v, ArrayType(DoubleType())) for v in WEATHER_VARS])))
