"""Driver queries of the small-entity stages: zones, codes and weather landed as CSV, Parquet, JSON Lines and JSON
documents with bad lines derived from the data, ingested and read back (A1, A2, A6, A7, B5, B7, G9-G14, K2-K4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.params import JobParams
from strata.plans import mapping as M
from strata.plans import pipeline as PL
from strata.presets import DRIVER_PRESET
from strata.session import scratch_path
from strata.sinks import writers as W
from strata.sources import schemas as S

MONTHS = "1998-11,1998-12,1999-01"


def _land_zones_csv(spark: SparkSession, d: str) -> str:
    """Zone master as CSV; every region adds a line whose id is no number."""
    good = M.zone_source(spark, d).withColumn("location_id", F.col("location_id").cast("string"))
    bad = M.table(spark, d, "region").select(
        F.concat(F.lit("x"), F.col("r_regionkey")).alias("location_id"), F.col("r_name").alias("borough"),
        F.lit("bad line").alias("zone"), F.lit("none").alias("service_zone"))
    path = scratch_path(spark, "zones_csv")
    (good.unionByName(bad).write.option("header", "true").option("ignoreLeadingWhiteSpace", "false")
     .option("ignoreTrailingWhiteSpace", "false").csv(path))
    return path


def _land_zones_parquet(spark: SparkSession, d: str) -> str:
    """Zone master as Parquet with the master's own column names; every seventh id is outside the domain."""
    k = F.col("location_id")
    path = scratch_path(spark, "zones_parquet")
    (M.zone_source(spark, d).withColumn("location_id", F.when(k % 7 == 0, k + 9000).otherwise(k))
     .withColumnRenamed("location_id", "LocationID").write.parquet(path))
    return path


def _land_codes(spark: SparkSession, d: str) -> str:
    """Code dictionary as JSON Lines, every entry twice; every region adds a line that is no JSON."""
    lines = M.code_source(spark, d).select(F.to_json(F.struct("code_type", "code", "description")).alias("value"))
    bad = M.table(spark, d, "region").select(F.concat(F.lit('{"code_type": "vendor", '), F.col("r_name")).alias("value"))
    path = scratch_path(spark, "codes_jsonl")
    lines.unionByName(lines).unionByName(bad).write.text(path)
    return path


def _land_weather(spark: SparkSession, d: str) -> str:
    """Daily measures as one JSON document a year-month; the last entry of each document has no date."""
    w = M.daily_weather(spark, d).withColumn("month", F.date_format("weather_date", "yyyy-MM"))
    values = [F.col(t).alias(v) for v, t in zip(S.WEATHER_VARS, S.WEATHER_TARGETS)]
    days = F.sort_array(F.collect_list(F.struct(F.date_format("weather_date", "yyyy-MM-dd").alias("time"), *values)))
    undated = F.struct(F.lit(None).cast("string").alias("time"),
                       *[F.lit(float(k)).alias(v) for k, v in enumerate(S.WEATHER_VARS)])
    docs = (w.groupBy("month").agg(F.concat(days, F.array(undated)).alias("_d")).select("month", F.struct(
        F.col("_d.time").alias("time"), *[F.col(f"_d.{v}").alias(v) for v in S.WEATHER_VARS]).alias("daily")))
    path = scratch_path(spark, "weather_landed")
    docs.write.partitionBy("month").option("ignoreNullFields", "false").json(path)
    return path


def _params(spark: SparkSession, fmt: str = "csv") -> JobParams:
    return JobParams(root=scratch_path(spark, "entities"), months=MONTHS, run_id="driver", source_format=fmt)


def _stored(spark: SparkSession, params: JobParams, table: str, entity: str, columns: list[str], suffix: str) -> DataFrame:
    """Valid rows with audit columns and whether the file's name is kept, and quarantined rows, in one frame."""
    lineage = F.coalesce(F.col("source_file").endswith(suffix), F.lit(False)).alias("from_file")
    valid = spark.read.parquet(PL._t(params, "bronze", table)).select(
        *columns, F.lit(None).cast("string").alias("raw_record"), F.lit(None).cast("string").alias("reasons"),
        "data_source", "run_id", lineage)
    bad = spark.read.parquet(PL._t(params, "bronze", "quarantine")).filter(F.col("entity") == entity).select(
        *[F.lit(None).cast(valid.schema[c].dataType).alias(c) for c in columns], "raw_record",
        F.array_join(F.array_sort("reasons"), ",").alias("reasons"), F.lit(None).cast("string").alias("data_source"),
        "run_id", lineage)
    return valid.unionByName(bad)


def zones_from_csv(spark: SparkSession, d: str) -> DataFrame:
    params = _params(spark)
    path = _land_zones_csv(spark, d)
    for _ in range(2):  # the second run must change nothing
        PL.ingest_zones(spark, params, path, DRIVER_PRESET)
    return _stored(spark, params, "taxi_zones", "taxi_zones", S.ZONE_SCHEMA.fieldNames(), ".csv")


def zones_from_parquet(spark: SparkSession, d: str) -> DataFrame:
    params = _params(spark, "parquet")
    PL.ingest_zones(spark, params, _land_zones_parquet(spark, d), DRIVER_PRESET)
    return _stored(spark, params, "taxi_zones", "taxi_zones", S.ZONE_SCHEMA.fieldNames(), ".parquet")


def codes_from_jsonl(spark: SparkSession, d: str) -> DataFrame:
    params = _params(spark)
    PL.ingest_codes(spark, params, _land_codes(spark, d))
    return _stored(spark, params, "ref_codes", "ref_codes", S.CODE_SCHEMA.fieldNames(), ".txt")


def weather_from_documents(spark: SparkSession, d: str) -> DataFrame:
    params = _params(spark)
    PL.ingest_weather(spark, params, _land_weather(spark, d))
    return _stored(spark, params, "weather_daily", "weather_daily", S.WEATHER_SCHEMA.fieldNames(), ".json")


def entity_metrics(spark: SparkSession, d: str) -> DataFrame:
    """All three stages and the dimensions built from them: the quality log."""
    params = _params(spark)
    PL.ingest_zones(spark, params, _land_zones_csv(spark, d), DRIVER_PRESET)
    PL.ingest_codes(spark, params, _land_codes(spark, d))
    PL.ingest_weather(spark, params, _land_weather(spark, d))
    PL.build_dims(spark, params, DRIVER_PRESET)
    log = spark.read.parquet(PL._t(params, "audit", "data_quality_log"))
    return log.select("layer", "entity", "metric", "value")


def overwrite(spark: SparkSession, d: str) -> DataFrame:
    """K4: customers written, then replaced by a frame of another shape."""
    cu = M.table(spark, d, "customer")
    path = scratch_path(spark, "overwritten")
    W.overwrite(cu, path)
    W.overwrite(cu.groupBy("c_nationkey").agg(F.count("*").alias("customers")), path)
    return spark.read.parquet(path)


def registry():
    return {f.__name__: f for f in (zones_from_csv, zones_from_parquet, codes_from_jsonl, weather_from_documents,
                                    entity_metrics, overwrite)}
