import json

import pyarrow as pa
import pyarrow.parquet as pq

from strata.operators.rules import code_rules, trip_rules, zone_rules
from strata.plans.pipeline import weather_rows
from strata.sources import readers as R
from strata.sources import schemas as S


def test_csv_corrupt_lines_are_rejected_with_original_text(spark, tmp):
    p = f"{tmp}/zones.csv"
    with open(p, "w") as f:
        f.write('LocationID,Borough,Zone,service_zone\n1,"Manhattan","Alphabet City","Yellow Zone"\n'
                '2,Queens\n3,Bronx,X,Boro Zone,extra\nabc,Bronx,Y,Boro Zone\n266,Bronx,Z,Boro Zone\n')
    df = R.read_text(spark, p, S.ZONE_SCHEMA, "csv")
    valid, invalid = zone_rules().split(df)
    assert [r.location_id for r in valid.collect()] == [1]
    bad = {r.location_id: r._corrupt_record for r in invalid.collect()}
    assert bad[2] == "2,Queens" and bad[3] == "3,Bronx,X,Boro Zone,extra" and bad[None].startswith("abc")
    assert bad[266] is None                      # parsed fine, rejected by the domain rule
    assert valid.first().source_file.endswith("zones.csv")


def test_jsonl_bad_line_and_unknown_type(spark, tmp):
    p = f"{tmp}/codes.json"
    with open(p, "w") as f:
        f.write('{"code_type": "vendor", "code": 1, "description": "A"}\n{not json\n'
                '{"code_type": "other", "code": 2, "description": "B"}\n')
    valid, invalid = code_rules().split(R.read_text(spark, p, S.CODE_SCHEMA, "json"))
    assert valid.count() == 1 and invalid.count() == 2


def _trip_file(path, names, pax_type, with_cbd):
    n = 3
    cols = {
        names[0]: pa.array([1, 2, 1], pa.int64()),
        "tpep_pickup_datetime": pa.array([1736496000000000] * n, pa.timestamp("us")),
        "tpep_dropoff_datetime": pa.array([1736497200000000] * n, pa.timestamp("us")),
        "passenger_count": pa.array([1, 2, None], pax_type),
        "trip_distance": pa.array([1.0, 2.0, 3.0]), "RatecodeID": pa.array([1.0, 2.0, 1.0]),
        "store_and_fwd_flag": pa.array(["N"] * n), "PULocationID": pa.array([1, 2, 3], pa.int32()),
        "DOLocationID": pa.array([2, 3, 1], pa.int32()), "payment_type": pa.array([1, 2, 1], pa.int64()),
        **{c: pa.array([10.0] * n) for c in ["fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
                                            "improvement_surcharge", "total_amount", "congestion_surcharge"]},
        names[1]: pa.array([1.75, 0.0, None]),
    }
    if with_cbd:
        cols["cbd_congestion_fee"] = pa.array([0.75, 0.0, 0.75])
    pq.write_table(pa.table(cols), path)


def test_drift_normalisation_per_file(spark, tmp):
    _trip_file(f"{tmp}/a.parquet", ["VendorID", "airport_fee"], pa.float64(), False)
    _trip_file(f"{tmp}/b.parquet", ["vendorid", "Airport_fee"], pa.int64(), True)
    df = R.read_drifting(spark, {"2025-01": f"{tmp}/a.parquet", "2025-02": f"{tmp}/b.parquet"}, S.TRIP_DRIFT)
    assert df.columns[:20] == S.TRIP_COLUMNS
    rows = df.collect()
    a = [r for r in rows if r.source_year_month == "2025-01"]
    b = [r for r in rows if r.source_year_month == "2025-02"]
    assert all(r.cbd_congestion_fee is None for r in a) and [r.cbd_congestion_fee for r in b] == [0.75, 0.0, 0.75]
    assert [r.passenger_count for r in a] == [1, 2, None] and a[0].airport_fee == 1.75
    assert R.missing_columns(spark.read.parquet(f"{tmp}/a.parquet"), S.TRIP_DRIFT) == ["cbd_congestion_fee"]
    valid, invalid = trip_rules(slice_value="2025-01").split(df.filter("source_year_month = '2025-01'"))
    assert valid.count() == 3


def test_failed_cast_is_quarantined_not_fatal(spark, tmp):
    t = pa.table({"locationid": pa.array(["1", "x2"]), "borough": pa.array(["A", "B"]),
                  "zone": pa.array(["z", "z"]), "service_zone": pa.array(["s", "s"])})
    pq.write_table(t, f"{tmp}/z.parquet")
    df = R.read_entity(spark, f"{tmp}/z.parquet", "parquet", S.ZONE_SCHEMA, S.ZONE_DRIFT)
    valid, invalid = zone_rules().split(df)
    assert [r.location_id for r in valid.collect()] == [1]
    assert invalid.first()._cast_failed == "location_id"


def test_parallel_arrays_to_rows(spark, tmp):
    doc = {"latitude": 40.7, "daily": {"time": ["2025-01-01", "2025-01-02"],
                                       "temperature_2m_max": [3.1, 4.2], "temperature_2m_min": [-1.0, 0.5],
                                       "precipitation_sum": [0.0, 6.2], "snowfall_sum": [0.0, 0.1],
                                       "wind_speed_10m_max": [20.0, 31.5]}}
    with open(f"{tmp}/w.json", "w") as f:
        json.dump(doc, f, indent=2)
    rows = weather_rows(spark, f"{tmp}/w.json").orderBy("weather_date").collect()
    assert [str(r.weather_date) for r in rows] == ["2025-01-01", "2025-01-02"]
    assert rows[1].precipitation_mm == 6.2 and rows[1].snowfall_cm == 0.1
