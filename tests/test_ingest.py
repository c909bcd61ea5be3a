"""Grouped scans of drifting deliveries, counts that don't depend on the outputs, and documents that can't be read."""

import datetime as dt
import json

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from strata.functions.exprs import in_months
from strata.operators import facts
from strata.operators.quality import RuleSet
from strata.operators.rules import trip_rules
from strata.params import JobParams
from strata.plans import pipeline as PL
from strata.sinks import tables as T
from strata.sources import readers as R
from strata.sources import schemas as S

MONTHS = [f"{y}-{m:02d}" for y in range(2019, 2026) for m in range(1, 13)][:81]


def month_file(path, ym, n=3, wrong_month=0, **columns):
    """n trips of a month; the last ``wrong_month`` are of the month after."""
    first = dt.datetime(int(ym[:4]), int(ym[5:]), 1, 8)
    after = (first.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
    pick = [first + dt.timedelta(hours=k) for k in range(n - wrong_month)] + [after] * wrong_month
    cols = {"VendorID": pa.array([1] * n, pa.int64()), "tpep_pickup_datetime": pa.array(pick, pa.timestamp("us")),
            "tpep_dropoff_datetime": pa.array([t + dt.timedelta(minutes=9) for t in pick], pa.timestamp("us")),
            "passenger_count": pa.array([1.0] * n), "trip_distance": pa.array([2.0] * n),
            "PULocationID": pa.array([1] * n, pa.int64()), "DOLocationID": pa.array([2] * n, pa.int64()),
            "fare_amount": pa.array([9.0] * n), "total_amount": pa.array([12.0] * n)}
    pq.write_table(pa.table(cols | columns), path)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def deliveries(tmp_path_factory):
    top = tmp_path_factory.mktemp("with a space")
    paths = {ym: str(top / f"y_{ym}.parquet") for ym in MONTHS}
    for k, (ym, path) in enumerate(paths.items()):
        month_file(path, ym, n=2 + k % 3, wrong_month=k % 2)
    return paths


def test_like_files_are_one_scan(spark, deliveries):
    groups = R.read_deliveries(spark, deliveries, "source_year_month", months=True)
    assert len(groups) == 1 and set(groups[0].slices) == set(MONTHS)
    assert plan_of(groups[0].rows).count("FileScan parquet") == 1
    per_file = {ym: spark.read.parquet(p).count() for ym, p in list(deliveries.items())[:5]}
    counts = PL.rows_by_slice(groups)
    assert len(counts) == 81 and {ym: counts[ym] for ym in per_file} == per_file
    rows = groups[0].rows.select("source_year_month", F.regexp_extract("source_file", "y_(.{7})", 1).alias("f"),
                                 F.date_format(R.SLICE_FROM, "yyyy-MM").alias("m"), (F.col(R.SLICE_FROM) < F.col(R.SLICE_TO)).alias("ok"))
    assert rows.filter("source_year_month != f or f != m or not ok").count() == 0


def test_counting_is_one_job_for_all_files(spark, deliveries):
    groups = R.read_deliveries(spark, deliveries, "source_year_month")
    spark.sparkContext.setJobGroup("counting", "")
    try:
        PL.rows_by_slice(groups)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("counting")
    finally:
        spark.sparkContext.setJobGroup("", "")
    assert len(jobs) <= 4  # the lookup's broadcast, the counts and their adaptive stages


def test_every_row_is_held_against_its_own_file(spark, tmp, deliveries):
    params = JobParams(root=f"{tmp}/lake", months=",".join(MONTHS), run_id="r")
    T.ensure_all(spark, params.root)
    out = PL.ingest_trips(spark, params, deliveries)
    for k, ym in enumerate(MONTHS):
        n, wrong = 2 + k % 3, k % 2
        assert out[ym] == {"rows_read": n, "rows_valid": n - wrong, "rows_quarantined": wrong, "null_passenger_count": 0}, ym
    log = T.read(spark, params.root, "audit", "data_quality_log")
    assert log.filter("metric = 'absent_column_cbd_congestion_fee'").count() == 81


def test_unlike_files_folders_and_lists(spark, tmp):
    month_file(f"{tmp}/a.parquet", "2025-01")
    month_file(f"{tmp}/b.parquet", "2025-02", VendorID=pa.array([1, 2, 3], pa.int32()))  # other type
    month_file(f"{tmp}/c.parquet", "2025-03", airport_fee=pa.array([1.0] * 3))  # other columns
    month_file(f"{tmp}/d.parquet", "2025-04")
    spark.read.parquet(f"{tmp}/a.parquet").repartition(2).write.parquet(f"{tmp}/folder")
    paths = {"2025-01": f"{tmp}/a.parquet", "2025-02": f"{tmp}/b.parquet", "2025-03": f"{tmp}/c.parquet",
             "2025-04": f"{tmp}/d.parquet", "2025-05": f"{tmp}/folder"}
    groups = R.read_deliveries(spark, paths, "source_year_month")
    assert sorted(g.slices for g in groups) == [("2025-01", "2025-04"), ("2025-02",), ("2025-03",), ("2025-05",)]
    df = R.read_drifting(spark, paths, S.TRIP_DRIFT)
    assert {r[0]: r[1] for r in df.groupBy("source_year_month").count().collect()} == {ym: 3 for ym in paths}
    assert df.filter("airport_fee is not null").select("source_year_month").distinct().collect()[0][0] == "2025-03"
    listed = R.read_drifting(spark, list(paths.values()), S.TRIP_DRIFT)
    assert listed.count() == 15 and "source_year_month" not in listed.columns
    assert R.read_drifting(spark, paths, S.TRIP_DRIFT, slice_col="delivery").columns[-1] == "delivery"


def test_group_filter_reaches_the_scan(spark, deliveries):
    g = R.read_deliveries(spark, deliveries, "source_year_month", months=True)[0]
    rows = R.normalize(g.rows, S.TRIP_DRIFT, ["source_year_month", R.SLICE_FROM, R.SLICE_TO])
    valid, _ = trip_rules(slice_value=(F.col(R.SLICE_FROM), F.col(R.SLICE_TO))).split(rows)
    spark.conf.set("spark.sql.maxMetadataStringLength", "20000")
    try:
        p = plan_of(valid.filter(in_months("pickup_datetime", min(g.slices), max(g.slices))))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = p[p.index("PushedFilters"):].split("]")[0]
    assert "GreaterThanOrEqual(tpep_pickup_datetime" in pushed and "LessThan(tpep_pickup_datetime" in pushed


def test_both_outputs_come_from_one_scan(spark, tmp, deliveries):
    """Valid and rejected rows are written by one job that reads every file once, and each table has its own columns."""
    g = R.read_deliveries(spark, deliveries, "source_year_month", months=True)[0]
    rows = R.normalize(g.rows, S.TRIP_DRIFT, ["source_year_month", R.SLICE_FROM, R.SLICE_TO])
    tagged = trip_rules(slice_value=(F.col(R.SLICE_FROM), F.col(R.SLICE_TO))).tag(rows).drop(R.SLICE_FROM, R.SLICE_TO)
    assert plan_of(tagged).count("FileScan parquet") == 1
    params = JobParams(root=f"{tmp}/lake", months=",".join(MONTHS), run_id="r")
    PL.write_trip_slices(spark, params, tagged, MONTHS, {})
    t = T.read(spark, params.root, "bronze", "yellow_trips")
    assert t.count() == sum(2 + k % 3 - k % 2 for k in range(81)) and t.filter("run_id != 'r' or data_source is null").count() == 0
    q = T.read(spark, params.root, "bronze", "quarantine")
    assert q.count() == 40 and {tuple(r.reasons) for r in q.collect()} == {("pickup_in_slice",)}
    one = json.loads(q.filter("entity = 'yellow_trips_2019-02'").first().raw_record)
    assert one["source_year_month"] == "2019-02" and one["pickup_datetime"].startswith("2019-03-01") and "_reasons" not in one


def test_a_slice_that_empties_goes_from_both_tables(spark, tmp):
    month_file(f"{tmp}/a.parquet", "2025-01", n=4, wrong_month=2)
    month_file(f"{tmp}/b.parquet", "2025-02", n=4, wrong_month=2)
    params = JobParams(root=f"{tmp}/lake", months="2025-01,2025-02", run_id="r")
    PL.ingest_trips(spark, params, {"2025-01": f"{tmp}/a.parquet", "2025-02": f"{tmp}/b.parquet"})
    month_file(f"{tmp}/a.parquet", "2025-01", n=3, wrong_month=3)
    month_file(f"{tmp}/b.parquet", "2025-02", n=3)
    out = PL.ingest_trips(spark, params, {"2025-01": f"{tmp}/a.parquet", "2025-02": f"{tmp}/b.parquet"})
    assert [(m["rows_read"], m["rows_valid"], m["rows_quarantined"]) for m in out.values()] == [(3, 0, 3), (3, 3, 0)]
    count = lambda name, col: {r[0]: r[1] for r in T.read(spark, params.root, "bronze", name).groupBy(col).count().collect()}
    assert count("yellow_trips", "source_year_month") == {"2025-02": 3}
    assert count("quarantine", "entity") == {"yellow_trips_2025-01": 3}


def _zones(tmp):
    with open(f"{tmp}/zones.csv", "w") as f:
        f.write('LocationID,Borough,Zone,service_zone\n1,A,a,x\n2,B,b,x\n3,C,c,x\nbad\n900,D,d,x\n')
    return f"{tmp}/zones.csv"


def test_a_lost_row_shows_in_rows_read(spark, tmp, monkeypatch):
    """Rows read are seen on the scan: when an output loses a row, the counts no longer add up."""
    params = JobParams(root=f"{tmp}/lake", months="2025-01", run_id="r")
    whole = PL.ingest_zones(spark, params, _zones(tmp))
    assert whole == {"rows_read": 5, "rows_valid": 3, "rows_quarantined": 2}
    real = RuleSet.split

    def loses(self, df):
        valid, invalid = real(self, df)
        return valid.filter("location_id != 2"), invalid.filter("location_id = 900")

    monkeypatch.setattr(RuleSet, "split", loses)
    lost = PL.ingest_zones(spark, JobParams(root=f"{tmp}/lake2", months="2025-01", run_id="r"), _zones(tmp))
    assert lost == {"rows_read": 5, "rows_valid": 2, "rows_quarantined": 1}


def test_rows_read_of_empty_and_all_bad_inputs(spark, tmp):
    for k, (text, want) in enumerate((("", (0, 0, 0)), ("x,1\n,\n", (2, 0, 2)))):
        with open(f"{tmp}/z{k}.csv", "w") as f:
            f.write("LocationID,Borough,Zone,service_zone\n" + text)
        m = PL.ingest_zones(spark, JobParams(root=f"{tmp}/l{k}", months="2025-01"), f"{tmp}/z{k}.csv")
        assert (m["rows_read"], m["rows_valid"], m["rows_quarantined"]) == want


def test_bad_weather_documents_are_quarantined(spark, tmp):
    import os
    os.makedirs(f"{tmp}/w")
    day = {"time": ["2025-01-01", None], **{v: [1.5, 2.5] for v in S.WEATHER_VARS}}
    for name, text in {"good": json.dumps({"daily": day, "extra": [1]}, indent=1), "cut": '{"daily": {"time": ["2025-01-02"',
                       "none": '{"daily": {"time": [], "precipitation_sum": []}}', "other": '{"elevation": 3}',
                       "odd": '{"daily": {"time": "2025-01-03"}}'}.items():
        with open(f"{tmp}/w/{name}.json", "w") as f:
            f.write(text)
    params = JobParams(root=f"{tmp}/lake", months="2025-01", run_id="r")
    m = PL.ingest_weather(spark, params, f"{tmp}/w")
    assert m == {"rows_read": 4, "rows_valid": 1, "rows_quarantined": 3}
    q = T.read(spark, params.root, "bronze", "quarantine").collect()
    raw = {r.source_file.rpartition("/")[2]: r.raw_record for r in q}
    assert set(raw) == {"good.json", "cut.json", "odd.json"}
    assert raw["cut.json"].startswith('{"daily"') and "2025-01-03" in raw["odd.json"]
    assert "corrupt_record" in next(r.reasons for r in q if r.source_file.endswith("cut.json"))


def test_documents_are_read_without_an_inference_pass(spark, tmp):
    with open(f"{tmp}/d.json", "w") as f:
        json.dump({"daily": {"time": ["2025-01-01"], "precipitation_sum": [1]}}, f)
    spark.sparkContext.setJobGroup("document", "")
    try:
        R.read_document_json(spark, f"{tmp}/d.json", S.WEATHER_DOCUMENT)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("document")
        R.read_document_json(spark, f"{tmp}/d.json")
        assert spark.sparkContext.statusTracker().getJobIdsForGroup("document")
    finally:
        spark.sparkContext.setJobGroup("", "")


@pytest.mark.parametrize("keys", [["k"], ["k", "m"]])
def test_rare_dedupe_keeps_the_same_rows(spark, tmp, keys):
    rows = [(k % 40 if k % 9 == 0 else k, None if k % 7 == 0 else k % 5, k * 31 % 17, None if k % 4 else "x") for k in range(300)]
    spark.createDataFrame(rows + rows[:5] + [(None, 1, 2, "y"), (None, 1, 1, "z")], "k int, m int, a int, b string").write.parquet(f"{tmp}/t")
    df = spark.read.parquet(f"{tmp}/t")
    canon = lambda d: sorted(map(repr, d.collect()))
    assert canon(facts.dedupe_rare(df, keys)) == canon(facts.dedupe(df, keys))
    unique = facts.dedupe(df, keys)
    unique.write.parquet(f"{tmp}/u")
    stored = spark.read.parquet(f"{tmp}/u")
    assert canon(facts.dedupe_rare(stored, keys)) == canon(stored)
    assert "Exchange hashpartitioning" not in plan_of(facts.dedupe_rare(stored, keys))  # nothing repeated: nothing shuffled


def test_dedupe_rare_with_many_repeated_keys(spark, tmp, monkeypatch):
    """Beyond RARE_KEYS the rows are dealt by key, to tasks whose number follows the rows; the survivors stay."""
    monkeypatch.setattr(facts, "RARE_KEYS", 10)
    monkeypatch.setattr(facts, "TASK_ROWS", 40)
    rows = [(k % 400 if k % 7 else None, k % 3, str(k % 5)) for k in range(1600)]
    spark.createDataFrame(rows, "id int, a int, b string").write.parquet(f"{tmp}/t")
    df = spark.read.parquet(f"{tmp}/t")
    got = facts.dedupe_rare(df, ["id"])
    canon = lambda d: sorted(map(repr, d.collect()))
    assert canon(got) == canon(facts.dedupe(df, ["id"])) and got.count() == len({r[0] for r in rows})
    assert got.rdd.getNumPartitions() == max(spark.sparkContext.defaultParallelism, 40)
