"""Driver queries that go through storage: drifting deliveries, landed JSON
documents, partition-pruned slice scans, slice replacement, upsert, clustered
layout and the metrics log. Each writes under a fresh folder in the cluster's
shared location (``spark.checkpoint.dir``) and returns the read-back table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, TimestampNTZType

from strata.functions.exprs import total
from strata.operators.rules import trip_rules
from strata.params import JobParams, parse_slices
from strata.plans import driver as D
from strata.plans import mapping as M
from strata.plans import pipeline as PL
from strata.presets import DRIVER_PRESET
from strata.session import scratch_path
from strata.sinks import writers as W
from strata.sources import readers as R
from strata.sources import schemas as S
from strata.sources.schemas import DriftSpec, _fields
from strata.storage import entries

# Slices requested by the slice-scan and slice-replace queries (a three-month run).
RUN_SLICES = "1998-12,1999-01,1999-02"
CUTOFF = "1998-01-01"

ORDER_DRIFT = DriftSpec(
    _fields(("order_key", LongType()), ("cust_key", LongType()), ("status", StringType()),
            ("total_price", DoubleType()), ("order_date", TimestampNTZType()), ("priority", StringType())),
    {"o_orderkey": "order_key", "o_custkey": "cust_key", "o_orderstatus": "status",
     "o_totalprice": "total_price", "o_orderdate": "order_date", "o_orderpriority": "priority"})


def drift_normalize(spark: SparkSession, d: str) -> DataFrame:
    """A3: two deliveries of orders with drifted schemas, normalised per file and united.

    Delivery A (before the cut-off) has upper-cased column names; delivery B
    stores the customer key as double and lacks the priority column.
    """
    od = M.table(spark, d, "orders")
    base = scratch_path(spark, "drift")
    before = F.coalesce(F.col("o_orderdate") < F.lit(CUTOFF), F.lit(False))    # no date: the late delivery
    early = od.filter(before)
    early.select(*[F.col(c).alias(c.upper()) for c in od.columns]).write.parquet(f"{base}/A")
    late = od.filter(~before)
    late.select("o_orderkey", F.col("o_custkey").cast("double").alias("o_custkey"), "o_orderstatus",
                "o_totalprice", "o_orderdate").write.parquet(f"{base}/B")
    out = R.read_drifting(spark, {"A": f"{base}/A", "B": f"{base}/B"}, ORDER_DRIFT, slice_col="delivery")
    return out.select(*ORDER_DRIFT.schema.fieldNames(), "delivery")


def delivery_groups(spark: SparkSession, d: str) -> DataFrame:
    """A3 + A8: orders landed as one file a month, those of odd years with a drifted schema, read in one scan a
    schema; rows and total per delivery, and how many scans there were."""
    od = M.table(spark, d, "orders")
    base = scratch_path(spark, "deliveries")
    month = F.coalesce(F.date_format("o_orderdate", "yyyy-MM"), F.lit("none"))
    odd = F.coalesce(F.year("o_orderdate") % 2 == 1, F.lit(False))
    early = od.filter(~odd).withColumn("m", month)
    late = od.filter(odd).withColumn("m", month).drop("o_orderpriority").withColumn("o_custkey", F.col("o_custkey").cast("double"))
    paths = {}
    for name, rows in (("even", early), ("odd", late)):
        rows.repartition("m").write.partitionBy("m").parquet(f"{base}/{name}")
        for folder in entries(spark, f"{base}/{name}"):
            files = [f"{base}/{name}/{folder}/{f}" for f in entries(spark, f"{base}/{name}/{folder}")]
            paths[folder.removeprefix("m=")] = files[0] if len(files) == 1 else f"{base}/{name}/{folder}"
    groups = R.read_deliveries(spark, paths, "delivery") if paths else []
    if not groups:
        return spark.createDataFrame([], "delivery string, orders long, total_price double, scans int")
    rows = None
    for g in groups:
        part = R.normalize(g.rows, ORDER_DRIFT, ["delivery"])
        rows = part if rows is None else rows.unionByName(part)
    return rows.groupBy("delivery").agg(
        F.count(F.lit(1)).alias("orders"), F.round(total("total_price", 2), 2).alias("total_price")).withColumn(
        "scans", F.lit(len(groups)))


def parallel_arrays_to_rows(spark: SparkSession, d: str) -> DataFrame:
    """A4 + A5: daily measures landed as one JSON document per month of parallel
    arrays (the shape of a weather API answer), read back and exploded to rows.

    Arrays are built per month, so each holds at most 31 entries at any scale.
    """
    w = M.daily_weather(spark, d)
    days = F.sort_array(F.collect_list(F.struct(
        F.date_format("weather_date", "yyyy-MM-dd").alias("time"),
        *[F.col(t).alias(v) for v, t in zip(S.WEATHER_VARS, S.WEATHER_TARGETS)])))
    docs = (w.groupBy(F.date_format("weather_date", "yyyy-MM").alias("month")).agg(days.alias("_d"))
            .select("month", F.struct(F.col("_d.time").alias("time"),
                                      *[F.col(f"_d.{v}").alias(v) for v in S.WEATHER_VARS]).alias("daily")))
    base = scratch_path(spark, "weather_docs")
    docs.write.partitionBy("month").json(base)
    return PL.weather_rows(spark, base).select("weather_date", *S.WEATHER_TARGETS)


def _orders_by_slice(od: DataFrame) -> DataFrame:
    return od.withColumn("source_year_month", F.date_format("o_orderdate", "yyyy-MM"))


def slice_scan(spark: SparkSession, d: str) -> DataFrame:
    """Orders stored partitioned by month, read back for the requested slices only
    (partition pruning: only those directories are listed and read)."""
    path = scratch_path(spark, "orders_by_month")
    _orders_by_slice(M.table(spark, d, "orders")).write.partitionBy("source_year_month").parquet(path)
    t = spark.read.option("basePath", path).parquet(path)
    return t.filter(F.col("source_year_month").cast("string").isin(*parse_slices(RUN_SLICES)))


def _month_list(spark: SparkSession, d: str) -> list[str]:
    """Every month from the first order month to one past the last (line 7 is shifted a month)."""
    row = M.table(spark, d, "orders").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b")).first()
    if row.a is None:
        return []
    y, m = row.a.year, row.a.month
    last = (row.b.year, row.b.month + 1) if row.b.month < 12 else (row.b.year + 1, 1)
    out = []
    while (y, m) <= last:
        out.append(f"{y:04d}-{m:02d}")
        y, m = (y, m + 1) if m < 12 else (y + 1, 1)
    return out


def replace_slices(spark: SparkSession, d: str) -> DataFrame:
    """K1: initial load of every slice, then a re-run of three slices: two with
    fewer rows (vendor 9 withdrawn), one with no rows at all. The two re-run
    slices must equal the new input, the empty one must be gone, the rest untouched."""
    path = scratch_path(spark, "bronze_trips")
    valid = D.bronze(spark, d)
    W.replace_slices(valid, path, "source_year_month", _month_list(spark, d))
    rerun = parse_slices(RUN_SLICES)
    again = valid.filter(F.col("source_year_month").isin(*rerun[:2]) & (F.col("vendor_id") != 9))
    W.replace_slices(again, path, "source_year_month", rerun)
    t = spark.read.parquet(path)
    return t.select(*M.RAW_TRIP_COLUMNS)


def upsert(spark: SparkSession, d: str) -> DataFrame:
    """K3 + D12: customers loaded without MACHINERY, then an update batch (BUILDING
    rows changed, MACHINERY rows new, every row delivered twice) merged by key."""
    cu = M.table(spark, d, "customer")
    path = scratch_path(spark, "customers")
    W.upsert(cu.filter(~F.col("c_mktsegment").eqNullSafe("MACHINERY")), path, ["c_custkey"])
    changes = (cu.filter(F.col("c_mktsegment").isin("MACHINERY", "BUILDING"))
               .withColumn("c_acctbal", F.col("c_acctbal") + F.lit(100)))
    W.upsert(changes.unionByName(changes), path, ["c_custkey"])
    return spark.read.parquet(path).select(*cu.columns)


def bucketed_upsert(spark: SparkSession, d: str) -> DataFrame:
    """K3: customers in 16 buckets; a batch of one customer in a thousand and a new one is merged, and the table
    tells how many buckets kept their files (the others hold a key of the batch)."""
    cu = M.table(spark, d, "customer")
    path = scratch_path(spark, "bucketed")
    W.upsert(cu, path, ["c_custkey"], buckets=16)
    before = set(entries(spark, path))
    last = cu.agg(F.max("c_custkey").alias("k"))
    batch = cu.filter(F.col("c_custkey") % 1000 == 0).withColumn("c_acctbal", F.lit(0.0))
    new = cu.join(last, cu.c_custkey == last.k).drop("k").withColumn("c_custkey", F.col("c_custkey") + 1)
    W.upsert(batch.unionByName(new), path, ["c_custkey"])
    kept = sorted(before & set(entries(spark, path)))
    lies = W.bucket_of(["c_custkey"], 16)
    hit = W.read_table(spark, path).filter("c_acctbal = 0 and c_custkey % 1000 = 0").select(lies.alias("b")).distinct()
    rows = W.read_table(spark, path).withColumn("file", F.col("_metadata.file_name")).withColumn("b", lies)
    told = rows.join(hit.withColumn("hit", F.lit(True)), "b", "left")
    stays = F.col("file").isin(kept) if kept else F.lit(False)
    return told.withColumn("stale", F.coalesce("hit", F.lit(False)) & stays).select(*cu.columns, "stale")


def skipped_files(spark: SparkSession, d: str) -> DataFrame:
    """F2 + G15: the fact clustered by pickup zone; per zone its trips, counted in only those files whose key range
    holds the zone."""
    path = scratch_path(spark, "fact_ranges")
    W.clustered(D.fact(spark, d), "pu_location_id", tiebreak="trip_id").write.parquet(path)
    rows = spark.read.parquet(path).select("pu_location_id", F.col("_metadata.file_name").alias("file"))
    ranges = rows.groupBy("file").agg(F.min("pu_location_id").alias("a"), F.max("pu_location_id").alias("z"))
    holds = ranges.select("file", F.explode(F.sequence("a", "z")).alias("pu_location_id"))  # zones are 265 at most
    return rows.join(holds, ["file", "pu_location_id"]).groupBy("pu_location_id").agg(F.count(F.lit(1)).alias("trips"))


def clustered_layout(spark: SparkSession, d: str) -> DataFrame:
    """the fact written range-partitioned and sorted on the pickup zone, read back."""
    path = scratch_path(spark, "fact_clustered")
    W.clustered(D.fact(spark, d), "pu_location_id", tiebreak="trip_id").write.parquet(path)
    return spark.read.parquet(path)


def load_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Bronze ingest and silver fact build over every slice, with the
    counts taken from the stored tables, appended to the quality log and read back."""
    slices = _month_list(spark, d)
    params = JobParams(root=scratch_path(spark, "lake"), months=",".join(slices), run_id="driver")
    raw = M.raw_trips(spark, d)
    read = {r[0]: r[1] for r in raw.groupBy("source_year_month").count().collect()}    # one row a month
    PL.write_trip_slices(spark, params, trip_rules(DRIVER_PRESET).tag(raw), slices, read, data_source="driver_tables")
    W.upsert(D.zones(spark, d), PL._t(params, "silver", "dim_zone"), ["location_id"])
    W.upsert(D.codes(spark, d), PL._t(params, "silver", "dim_reference"), ["code_type", "code"])
    PL.build_fact_stage(spark, params, DRIVER_PRESET)
    log = spark.read.parquet(PL._t(params, "audit", "data_quality_log"))
    return log.select("layer", "entity", "metric", "value")


def registry():
    return {
        "drift_normalize": drift_normalize,
        "delivery_groups": delivery_groups,
        "parallel_arrays_to_rows": parallel_arrays_to_rows,
        "slice_scan": slice_scan,
        "replace_slices": replace_slices,
        "upsert": upsert,
        "bucketed_upsert": bucketed_upsert,
        "skipped_files": skipped_files,
        "clustered_layout": clustered_layout,
        "load_metrics": load_metrics,
    }

