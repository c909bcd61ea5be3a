"""The trip pipeline over the driver's tables, stage by stage, as lazy DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.operators import dims, facts
from strata.operators.rules import code_rules, trip_rules, zone_rules
from strata.plans import mapping as M
from strata.presets import DRIVER_PRESET
from strata.session import shared_dir
from strata.sinks import writers as W
from strata.storage import file_versions

PRESET = DRIVER_PRESET


def bronze_split(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) raw trips under the hard rules (B1, B2)."""
    return trip_rules(PRESET).split(M.raw_trips(spark, d))


def bronze(spark: SparkSession, d: str) -> DataFrame:
    return bronze_split(spark, d)[0]


def zones(spark: SparkSession, d: str) -> DataFrame:
    valid, _ = zone_rules(PRESET).split(M.zone_source(spark, d))
    return dims.zone_dim(valid, PRESET)


def codes_frame(spark: SparkSession, d: str) -> DataFrame:
    valid, _ = code_rules().split(M.code_source(spark, d))
    return dims.reference_dim(valid)


def code_stage(spark: SparkSession, d: str) -> str:
    """Stage: the code dictionary as a table in the shared folder, keyed by the files that it is derived from.

    The key is a digest of the names, sizes and times of the files of orders and lineitem, so a changed input is a new
    table and every session and query of the same input shares one. The lookups read that table; Spark sees its real,
    tiny size and broadcasts it. The table appears whole (``overwrite`` swaps it in), so a stage that was cut off is
    run again.
    """
    version = file_versions(spark, [f"{d.rstrip('/')}/{t}.parquet" for t in ("orders", "lineitem")])
    path = f"{shared_dir(spark)}/strata-stages/dim_reference-{version}"
    if not W.table_exists(spark, path):
        W.overwrite(codes_frame(spark, d), path)
    return path


def codes(spark: SparkSession, d: str) -> DataFrame:
    """The code dictionary like the pipeline's ``dim_reference`` table, from its stage."""
    return W.read_table(spark, code_stage(spark, d))


def enriched(spark: SparkSession, d: str) -> DataFrame:
    """Derived + looked-up + flagged trips, before de-duplication."""
    return facts.enrich(facts.derive(bronze(spark, d)), zones(spark, d), codes(spark, d), PRESET)


def fact(spark: SparkSession, d: str) -> DataFrame:
    return facts.build_fact(bronze(spark, d), zones(spark, d), codes(spark, d), PRESET, with_updated_ts=False)


def calendar(spark: SparkSession, d: str) -> DataFrame:
    return dims.calendar_attributes(dims.calendar_from_bounds(M.calendar_bounds(spark, d)))


def dim_date(spark: SparkSession, d: str) -> DataFrame:
    return dims.calendar_enriched(calendar(spark, d), M.daily_weather(spark, d), PRESET.weather)


def daily_conditions(spark: SparkSession, d: str) -> DataFrame:
    w = M.daily_weather(spark, d)
    return w.select("weather_date", "precipitation_mm", "snowfall_cm",
                    dims.weather_condition(PRESET.weather).alias("weather_condition"))
