import json

import pyarrow as pa
import pyarrow.parquet as pq

from strata.params import JobParams
from strata.plans import pipeline as PL
from strata.presets import REFERENCE_CODES

US_PER_MIN = 60_000_000


def _month_file(path, year, month, n, vendor_name="VendorID", airport_name="airport_fee", cbd=True):
    import datetime as dt
    base = int(dt.datetime(year, month, 3, 8).timestamp()) * 1_000_000
    pick = [base + i * 37 * US_PER_MIN for i in range(n)]
    drop = [p + (12 + i % 40) * US_PER_MIN for i, p in enumerate(pick)]
    drop[0] = pick[0]                                   # dropoff = pickup -> quarantined
    cols = {
        vendor_name: pa.array([1 + i % 2 for i in range(n)], pa.int64()),
        "tpep_pickup_datetime": pa.array(pick, pa.timestamp("us")),
        "tpep_dropoff_datetime": pa.array(drop, pa.timestamp("us")),
        "passenger_count": pa.array([float(i % 3) for i in range(n)]),
        "trip_distance": pa.array([0.5 + (i % 9) for i in range(n)]),
        "RatecodeID": pa.array([1 + i % 3 for i in range(n)], pa.int64()),
        "store_and_fwd_flag": pa.array(["N"] * n),
        "PULocationID": pa.array([1 + i % 4 for i in range(n)], pa.int64()),
        "DOLocationID": pa.array([1 + (i * 7) % 4 for i in range(n)], pa.int64()),
        "payment_type": pa.array([1 + i % 2 for i in range(n)], pa.int64()),
        "fare_amount": pa.array([8.0 + i % 30 for i in range(n)]),
        "extra": pa.array([0.0] * n), "mta_tax": pa.array([0.5] * n),
        "tip_amount": pa.array([float(i % 5) for i in range(n)]), "tolls_amount": pa.array([0.0] * n),
        "improvement_surcharge": pa.array([1.0] * n),
        "total_amount": pa.array([12.0 + i % 30 for i in range(n)]),
        "congestion_surcharge": pa.array([2.5] * n),
        airport_name: pa.array([1.75 if i % 10 == 0 else 0.0 for i in range(n)]),
    }
    if cbd:
        cols["cbd_congestion_fee"] = pa.array([0.75] * n)
    pq.write_table(pa.table(cols), path)


def _inputs(tmp):
    _month_file(f"{tmp}/y_2024-12.parquet", 2024, 12, 40, cbd=False)
    _month_file(f"{tmp}/y_2025-01.parquet", 2025, 1, 50, vendor_name="vendorid", airport_name="Airport_fee")
    with open(f"{tmp}/zones.csv", "w") as f:
        f.write('"LocationID","Borough","Zone","service_zone"\n1,"Manhattan","A","Yellow Zone"\n'
                '2,"Queens","JFK Airport","Airports"\n3,"Brooklyn","B","Boro Zone"\n4,"Unknown","NV","N/A"\nbad\n')
    with open(f"{tmp}/codes.json", "w") as f:
        for t, c, d in REFERENCE_CODES:
            f.write(json.dumps({"code_type": t, "code": c, "description": d}) + "\n")
    import datetime as dt
    days = [dt.date(2024, 12, 1) + dt.timedelta(days=i) for i in range(62)]
    doc = {"daily": {"time": [str(d) for d in days], "temperature_2m_max": [5.0] * 62,
                     "temperature_2m_min": [-1.0] * 62,
                     "precipitation_sum": [float(i % 7) for i in range(62)],
                     "snowfall_sum": [0.2 if i % 11 == 0 else 0.0 for i in range(62)],
                     "wind_speed_10m_max": [20.0] * 62}}
    with open(f"{tmp}/weather.json", "w") as f:
        json.dump(doc, f)
    trips = {"2024-12": f"{tmp}/y_2024-12.parquet", "2025-01": f"{tmp}/y_2025-01.parquet"}
    return trips, f"{tmp}/zones.csv", f"{tmp}/codes.json", f"{tmp}/weather.json"


def test_end_to_end_and_idempotent_rerun(spark, tmp):
    trips, zones, codes, weather = _inputs(tmp)
    params = JobParams(root=f"{tmp}/lake", months="2024-12,2025-01", run_id="r1")
    out = PL.run(spark, params, trips, zones, codes, weather)
    assert out["trips"]["2024-12"] == {"rows_read": 40, "rows_valid": 39, "rows_quarantined": 1,
                                       "null_passenger_count": 0}
    assert out["zones"]["rows_quarantined"] == 1 and out["codes"]["rows_valid"] == 18
    assert out["dims"]["dim_date_rows"] == 62
    assert out["fact"]["silver_rows"] == 88 and out["fact"]["duplicates_removed"] == 0
    assert all(v > 0 for v in out["marts"].values())
    fact = spark.read.parquet(f"{tmp}/lake/silver/fact_trips")
    assert fact.filter("passenger_count IS NULL").count() > 0
    # re-run: same tables, no duplicates
    out2 = PL.run(spark, JobParams(root=f"{tmp}/lake", months="2024-12,2025-01", run_id="r2"),
                  trips, zones, codes, weather)
    assert out2["fact"]["silver_rows"] == 88
    assert spark.read.parquet(f"{tmp}/lake/bronze/yellow_trips").count() == 88
    assert spark.read.parquet(f"{tmp}/lake/bronze/quarantine").count() == 3
    log = spark.read.parquet(f"{tmp}/lake/audit/data_quality_log")
    assert log.filter("run_id = 'r2'").count() == log.filter("run_id = 'r1'").count()


def test_command_line(spark, tmp):
    from strata.__main__ import main
    trips, zones, codes, weather = _inputs(tmp)
    out = main(["--root", f"{tmp}/lake2", "--months", "2024-12,2025-01", "--run-id", "cli",
                "--trips", f"{tmp}/y_{{month}}.parquet", "--zones", zones, "--codes", codes, "--weather", weather])
    assert out["fact"]["silver_rows"] == 88 and "bronze.quarantine" in out["created"]


def test_empty_fact_guard(spark, tmp):
    import pytest
    with pytest.raises(RuntimeError, match="empty"):
        PL.build_marts(spark, JobParams(root=f"{tmp}/none", months="2025-01"))


def test_clean_redelivery_clears_old_quarantine(spark, tmp):
    trips, *_ = _inputs(tmp)
    params = JobParams(root=f"{tmp}/lake3", months="2025-01", run_id="a")
    assert PL.ingest_trips(spark, params, {"2025-01": trips["2025-01"]})["2025-01"]["rows_quarantined"] == 1
    import pyarrow.parquet as pq
    t = pq.read_table(trips["2025-01"])
    clean = t.slice(1)                                   # drop the bad first row
    pq.write_table(clean, f"{tmp}/clean_2025-01.parquet")
    m = PL.ingest_trips(spark, params, {"2025-01": f"{tmp}/clean_2025-01.parquet"})["2025-01"]
    assert m["rows_quarantined"] == 0 and m["rows_valid"] == 49
    from strata.sinks import tables as T
    q = T.read(spark, f"{tmp}/lake3", "bronze", "quarantine")      # contract schema: the table may be empty
    assert q.filter("entity = 'yellow_trips_2025-01'").count() == 0


def test_rows_valid_counted_before_key_dedupe(spark, tmp):
    with open(f"{tmp}/codes.json", "w") as f:
        f.write('{"code_type": "vendor", "code": 1, "description": "A"}\n'
                '{"code_type": "vendor", "code": 1, "description": "A2"}\n')
    params = JobParams(root=f"{tmp}/lake4", months="2025-01")
    m = PL.ingest_codes(spark, params, f"{tmp}/codes.json")
    assert m["rows_valid"] == 2                                      # S-17
    assert spark.read.parquet(f"{tmp}/lake4/bronze/ref_codes").count() == 1


def test_run_takes_top_k_and_export_from_its_parameters(spark, tmp, monkeypatch):
    import pytest
    trips, zones, codes, weather = _inputs(tmp)
    sent = {}
    monkeypatch.setattr(PL.W, "publish_jdbc", lambda frames, url, options=None: sent.update(frames) or {"n": len(frames)})
    params = JobParams(root=f"{tmp}/lake5", months="2024-12,2025-01", top_k=2, export_enabled=True)
    with pytest.raises(ValueError, match="export_url"):
        PL.run(spark, params, trips, zones, codes, weather)
    out = PL.run(spark, params, trips, zones, codes, weather, export_url="jdbc:none")
    routes = spark.read.parquet(f"{tmp}/lake5/gold/top_routes")
    assert routes.groupBy("pu_borough").count().agg({"count": "max"}).first()[0] <= 2
    assert out["export"] and len(sent) == 7
