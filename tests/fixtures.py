"""Hand-made canonical trips with the edge rows of FIXTURES.md section 3."""

from __future__ import annotations

import datetime as dt

from strata.presets import REFERENCE_CODES
from strata.sources.schemas import TRIP_SCHEMA

T0 = dt.datetime(2025, 1, 10, 8, 0, 0)

BASE = dict(vendor_id=1, pickup_datetime=T0, dropoff_datetime=T0 + dt.timedelta(minutes=20), passenger_count=1,
            trip_distance=3.0, ratecode_id=1, store_and_fwd_flag="N", pu_location_id=1, do_location_id=2,
            payment_type=1, fare_amount=20.0, extra=0.0, mta_tax=0.5, tip_amount=5.0, tolls_amount=0.0,
            improvement_surcharge=1.0, total_amount=26.5, congestion_surcharge=2.5, airport_fee=None,
            cbd_congestion_fee=0.75)

RAW_SCHEMA = TRIP_SCHEMA.simpleString()[len("struct<"):-1].replace(":", " ") + ", source_year_month string"


def trip(**kw):
    row = dict(BASE)
    row.update(kw)
    row.setdefault("source_year_month", "2025-01")
    return row


def frame(spark, rows):
    cols = [f.name for f in TRIP_SCHEMA.fields] + ["source_year_month"]
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in rows],
                                 ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TRIP_SCHEMA.fields)
                                 + ", source_year_month string")


def zones(spark):
    rows = [(1, "Manhattan", "Alphabet City", "Yellow Zone"), (2, "Queens", "JFK Airport", "Airports"),
            (3, " Brooklyn ", "Bath Beach", "Boro Zone"), (264, "Unknown", "NV", "N/A"), (265, "N/A", None, None)]
    return spark.createDataFrame(rows, "location_id int, borough string, zone string, service_zone string")


def codes(spark):
    return spark.createDataFrame(REFERENCE_CODES, "code_type string, code int, description string")
