"""Table contracts and create-if-missing.

A table is a Parquet path ``<root>/<layer>/<name>``. ``ensure`` creates an empty,
typed (and partitioned) table when none exists, so readers see the contract
before the first load; column comments travel in the schema metadata.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType, TimestampType

from strata.session import table_path
from strata.sinks.writers import read_table, table_exists
from strata.sources.schemas import CODE_SCHEMA, TRIP_SCHEMA, WEATHER_SCHEMA, ZONE_SCHEMA


def _f(name, dtype, comment=None) -> StructField:
    return StructField(name, dtype, True, {"comment": comment} if comment else {})


AUDIT = [_f("source_file", StringType(), "file the row came from"), _f("ingestion_ts", TimestampType()),
         _f("data_source", StringType()), _f("run_id", StringType())]

# (layer, name) -> (schema, partition column, comment)
CONTRACTS: dict[tuple[str, str], tuple[StructType, str | None, str]] = {
    ("bronze", "yellow_trips"): (StructType(list(TRIP_SCHEMA.fields) + AUDIT
                                            + [_f("source_year_month", StringType(), "slice YYYY-MM")]),
                                 "source_year_month", "valid trips, one row per trip"),
    ("bronze", "taxi_zones"): (StructType(list(ZONE_SCHEMA.fields) + AUDIT), None, "zone master"),
    ("bronze", "ref_codes"): (StructType(list(CODE_SCHEMA.fields) + AUDIT), None, "code dictionary"),
    ("bronze", "weather_daily"): (StructType(list(WEATHER_SCHEMA.fields) + AUDIT), None, "daily weather"),
    ("bronze", "quarantine"): (StructType([
        _f("raw_record", StringType(), "original text or JSON of the rejected row"),
        _f("reasons", ArrayType(StringType()), "names of the broken rules"),
        _f("source_file", StringType()), _f("run_id", StringType()), _f("quarantine_ts", TimestampType()),
        _f("entity", StringType(), "rejecting entity / slice")]), "entity", "rows rejected by hard rules"),
    ("audit", "data_quality_log"): (StructType([
        _f("run_id", StringType()), _f("layer", StringType()), _f("entity", StringType()),
        _f("metric", StringType()), _f("value", LongType()), _f("log_ts", TimestampType())]), None,
        "quality metrics per run"),
}


def ensure(spark: SparkSession, path: str, schema: StructType, partition_by: str | None = None) -> bool:
    """Create an empty typed table at ``path`` if there is none; True if it was created."""
    if table_exists(spark, path):
        return False
    w = spark.createDataFrame([], schema).write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)
    return True


def ensure_all(spark: SparkSession, root: str) -> list[str]:
    """Create every missing bronze/audit table of the contract; returns the created ones."""
    made = []
    for (layer, name), (schema, part, _comment) in CONTRACTS.items():
        if ensure(spark, table_path(root, layer, name), schema, part):
            made.append(f"{layer}.{name}")
    return made


def read(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame:
    """Full scan of a table (A10); filters on the partition column prune directories.

    Tables with a contract are read with it, so an empty partitioned table (which has
    no data file to infer from) still has its schema.
    """
    contract = CONTRACTS.get((layer, name))
    return read_table(spark, table_path(root, layer, name), contract[0] if contract else None)

