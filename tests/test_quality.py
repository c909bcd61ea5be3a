import datetime as dt
import json

from pyspark.sql import functions as F

from strata.operators.quality import quarantine_rows
from strata.operators.rules import trip_rules

from fixtures import T0, frame, trip


def _edge_rows():
    return [
        trip(),                                                          # valid
        trip(dropoff_datetime=T0),                                       # 1 dropoff = pickup
        trip(pickup_datetime=dt.datetime(2024, 12, 31, 23, 0),
             dropoff_datetime=dt.datetime(2025, 1, 1, 0, 10)),           # 2 other month
        trip(trip_distance=None),                                        # 3 NULL verdict
        trip(fare_amount=-5.0),                                          # 4
        trip(pu_location_id=0), trip(do_location_id=266), trip(pu_location_id=None),  # 5
        trip(trip_distance=0.0, fare_amount=0.0, total_amount=0.0,
             dropoff_datetime=T0 + dt.timedelta(seconds=1)),             # 6 valid
    ]


def test_hard_rules_split(spark):
    df = frame(spark, _edge_rows())
    for ym in ("2025-01", None):      # literal month (pushdown form) and column form
        valid, invalid = trip_rules(slice_value=ym).split(df)
        assert valid.count() == 2 and invalid.count() == 7
        assert valid.count() + invalid.count() == df.count()


def test_violations_and_reasons(spark):
    df = frame(spark, _edge_rows())
    rules = trip_rules()
    v = {r.rule: r.rows_failed for r in rules.violations(df).collect()}
    assert v["dropoff_after_pickup"] == 1 and v["pickup_in_slice"] == 1 and v["distance_non_negative"] == 1
    assert v["pu_zone_in_domain"] == 2 and v["required_pu_location_id"] == 1
    _, invalid = rules.split(df)
    reasons = [r[0] for r in invalid.select(F.array_join(rules.reasons(invalid), ",")).collect()]
    assert all(reasons)


def test_quarantine_json_drops_null_fields(spark):
    _, invalid = trip_rules().split(frame(spark, [trip(trip_distance=None)]))
    q = quarantine_rows(invalid, "yellow_trips_2025-01", "r1").first()
    rec = json.loads(q.raw_record)
    assert "trip_distance" not in rec and "airport_fee" not in rec and rec["fare_amount"] == 20.0
    assert q.entity == "yellow_trips_2025-01" and q.run_id == "r1"


def test_quarantine_keeps_original_bad_text(spark):
    df = spark.createDataFrame([("a,b", 1, "bad line")], "x string, y int, _corrupt_record string")
    q = quarantine_rows(df, "e", "r").first()
    assert q.raw_record == "bad line"


def test_nan_passes_by_default_and_is_caught_when_asked(spark):
    df = frame(spark, [trip(trip_distance=float("nan"))])
    assert trip_rules().split(df)[0].count() == 1
    assert trip_rules(not_nan=True).split(df)[0].count() == 0
