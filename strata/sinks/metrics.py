"""Quality metrics in long format."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_SCHEMA = "run_id STRING, layer STRING, entity STRING, metric STRING, value BIGINT"


def to_rows(spark: SparkSession, run_id: str, layer: str, entity: str, metrics: Mapping[str, int]) -> DataFrame:
    """A metrics dict (a handful of counters) as log rows with a timestamp."""
    rows = [(run_id, layer, entity, k, int(v or 0)) for k, v in metrics.items()]
    return spark.createDataFrame(rows, LOG_SCHEMA).withColumn("log_ts", F.current_timestamp())


def append_log(spark: SparkSession, path: str, run_id: str, layer: str, entity: str,
               metrics: Mapping[str, int]) -> None:
    """Append to the quality log; one small write, never a rewrite."""
    append_many(spark, path, run_id, layer, {entity: metrics})


def append_many(spark: SparkSession, path: str, run_id: str, layer: str,
                by_entity: Mapping[str, Mapping[str, int]]) -> None:
    """Append the metrics of several entities (e.g. every slice of a run) in one write."""
    rows = [(run_id, layer, e, k, int(v or 0)) for e, m in by_entity.items() for k, v in m.items()]
    spark.createDataFrame(rows, LOG_SCHEMA).withColumn("log_ts", F.current_timestamp()) \
        .write.mode("append").parquet(path)
