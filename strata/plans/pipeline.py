"""Stage functions of the layered pipeline: raw -> bronze -> silver -> gold.

Tables are Parquet paths ``<root>/<layer>/<name>``. Stages pass state only
through tables and the run id; each returns its metrics dict and appends it to
the quality log. Per-slice counts are one aggregation by slice over the stored
tables; the rows read are counted on the input, so a lost row shows.
"""

from __future__ import annotations

import dataclasses
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata import presets as P
from strata.operators import dims, facts, marts
from strata.operators.quality import quarantine_rows, tagged_rows, with_audit
from strata.operators.rules import code_rules, trip_rules, weather_rules, zone_rules
from strata.params import JobParams, slice_bounds
from strata.presets import Preset
from strata.session import table_path
from strata.sinks import metrics as M
from strata.sinks import tables as T
from strata.sinks import writers as W
from strata.sources import readers as R
from strata.sources import schemas as S

SLICE = "source_year_month"


def _t(params: JobParams, layer: str, name: str) -> str:
    return table_path(params.root, layer, name)


def _log(spark: SparkSession, params: JobParams, layer: str, entity: str, metrics: Mapping[str, int]) -> None:
    M.append_log(spark, _t(params, "audit", "data_quality_log"), params.run_id, layer, entity, metrics)


def ingest_trips(spark: SparkSession, params: JobParams, paths: Mapping[str, str],
                 preset: Preset = P.TRIP_PRESET, data_source: str = "trip_parquet") -> dict[str, dict[str, int]]:
    """Monthly files -> bronze trips + quarantine, one write each for all requested slices.

    Files with one schema are one scan, and every row is checked against its own file's month. The rules are evaluated
    once a row and both outputs come from one write, so every byte is read once and nothing is cached. The rows read are
    counted on the files (their footers, in one job for all), not from the outputs. Absent columns are logged per
    file.
    """
    slices = params.slices
    groups = R.read_deliveries(spark, {ym: paths[ym] for ym in slices}, SLICE, months=True)
    absent = {f"yellow_trips_{ym}": {f"absent_column_{c}": 1 for c in g.missing(S.TRIP_DRIFT)} for g in groups for ym in g.slices}
    if any(absent.values()):
        M.append_many(spark, _t(params, "audit", "data_quality_log"), params.run_id, "bronze", absent)
    tagged = None
    for g in groups:
        rules = trip_rules(preset, (F.col(R.SLICE_FROM), F.col(R.SLICE_TO)))
        rows = R.normalize(g.rows, S.TRIP_DRIFT, [SLICE, R.SLICE_FROM, R.SLICE_TO])
        rows = rules.tag(rows).drop(R.SLICE_FROM, R.SLICE_TO)
        tagged = rows if tagged is None else tagged.unionByName(rows)
    return write_trip_slices(spark, params, tagged, slices, rows_by_slice(groups), data_source)


def rows_by_slice(groups: list[R.Deliveries]) -> dict[str, int]:
    """Rows of the delivered files per slice: one job, which needs no column of the files."""
    rows = None
    for g in groups:
        rows = g.rows.select(SLICE) if rows is None else rows.unionByName(g.rows.select(SLICE))
    return {r[0]: r[1] for r in rows.groupBy(SLICE).count().collect()}


def write_trip_slices(spark: SparkSession, params: JobParams, tagged: DataFrame,
                      slices: list[str], read: Mapping[str, int], data_source: str = "trip_parquet",
                      entity_prefix: str = "yellow_trips_") -> dict[str, dict[str, int]]:
    """Quarantine and bronze slice replacement from one write of a ``RuleSet.tag`` frame, with per-slice metrics.

    ``read`` has the input rows per slice. The other counts are one aggregation by slice over the stored tables, so
    their cost does not depend on the number of slices.
    """
    data_cols = [c for c in tagged.columns if c in S.TRIP_COLUMNS]
    rows = tagged_rows(tagged, params.run_id, data_source, data_cols, [SLICE])
    stored = W.replace_tagged(rows, "_verdict", SLICE, slices, {
        False: (_t(params, "bronze", "quarantine"), "entity", entity_prefix),
        True: (_t(params, "bronze", "yellow_trips"), SLICE, "")})
    table = T.read(spark, params.root, "bronze", "yellow_trips").filter(F.col(SLICE).isin(*slices))
    nulls = {r[0]: r[1] for r in table.groupBy(SLICE).agg(F.count_if(F.col("passenger_count").isNull())).collect()}
    summary = {ym: {"rows_read": int(read.get(ym, 0)), "rows_valid": stored[True][ym],
                    "rows_quarantined": stored[False][ym],
                    "null_passenger_count": int(nulls.get(ym, 0))} for ym in slices}
    M.append_many(spark, _t(params, "audit", "data_quality_log"), params.run_id, "bronze",
                  {f"{entity_prefix}{ym}": m for ym, m in summary.items()})
    return summary


def _ingest_small(spark: SparkSession, params: JobParams, df: DataFrame, rules, entity: str, table: str,
                  keys: list[str], data_source: str) -> dict[str, int]:
    """Shared shape of the small entities: split, quarantine, upsert, metrics.

    The rows read are observed on the scan, below the split, while the quarantine is written (the valid rows' own
    filters still reach their scan), so a row that neither output has shows as a difference (D14). The valid rows are
    counted before the key dedupe (S-17).
    """
    seen = Observation(f"read_{entity}_{uuid.uuid4().hex[:8]}")
    _, invalid = rules.split(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    q = quarantine_rows(invalid, entity, params.run_id, reasons=rules.reasons(invalid))
    # no exchange between the scan and the writer: an empty stage would take the observation with it
    stored_q = W.replace_slices(q, _t(params, "bronze", "quarantine"), "entity", [entity], rebalance=False)[entity]
    valid, _ = rules.split(df)
    n_valid = valid.count()
    W.upsert(with_audit(valid, data_source, params.run_id), _t(params, "bronze", table), keys)
    m = {"rows_read": int(seen.get["rows"]), "rows_valid": n_valid, "rows_quarantined": stored_q}
    _log(spark, params, "bronze", entity, m)
    return m


def ingest_zones(spark: SparkSession, params: JobParams, path: str, preset: Preset = P.TRIP_PRESET):
    """Zones from CSV or Parquet by parameter."""
    df = R.read_entity(spark, path, params.source_format, S.ZONE_SCHEMA, S.ZONE_DRIFT)
    src = "zones_parquet" if params.source_format == "parquet" else "zones_csv"
    return _ingest_small(spark, params, df, zone_rules(preset), "taxi_zones", "taxi_zones", ["location_id"], src)


def ingest_codes(spark: SparkSession, params: JobParams, path: str):
    """Code dictionary from JSON Lines."""
    df = R.read_text(spark, path, S.CODE_SCHEMA, "json")
    return _ingest_small(spark, params, df, code_rules(), "ref_codes", "ref_codes", ["code_type", "code"],
                         "codes_jsonl")


def weather_rows(spark: SparkSession, path: str) -> DataFrame:
    """A4 + A5: landed weather documents -> one typed row per day, and one for a document that can't be read."""
    doc = R.read_document_json(spark, path, S.WEATHER_DOCUMENT)
    return R.explode_parallel(doc, "daily", "time", S.WEATHER_VARS, "weather_date", S.WEATHER_TARGETS)


def ingest_weather(spark: SparkSession, params: JobParams, path: str):
    """Landed JSON documents -> bronze weather (upsert on the date)."""
    return _ingest_small(spark, params, weather_rows(spark, path), weather_rules(), "weather_daily",
                         "weather_daily", ["weather_date"], "weather_json")


def build_dims(spark: SparkSession, params: JobParams, preset: Preset = P.TRIP_PRESET) -> dict[str, int]:
    """dim_zone, dim_reference, dim_date (calendar over the contiguous slice range)."""
    now = F.current_timestamp()
    zones = dims.zone_dim(T.read(spark, params.root, "bronze", "taxi_zones"), preset).withColumn("updated_ts", now)
    W.upsert(zones, _t(params, "silver", "dim_zone"), ["location_id"])
    refs = dims.reference_dim(T.read(spark, params.root, "bronze", "ref_codes")).withColumn("updated_ts", now)
    W.upsert(refs, _t(params, "silver", "dim_reference"), ["code_type", "code"])
    start, end = slice_bounds(params.slices)
    weather = T.read(spark, params.root, "bronze", "weather_daily")
    dd = dims.calendar_enriched(dims.calendar(spark, start, end), weather, preset.weather).withColumn("updated_ts", now)
    W.upsert(dd, _t(params, "silver", "dim_date"), ["date"])
    dz, dd2 = (T.read(spark, params.root, "silver", name) for name in ("dim_zone", "dim_date"))
    m = dz.agg(F.count("*").alias("dim_zone_rows"), F.count_if("is_unknown").alias("zones_unknown")).first().asDict()
    m.update(dd2.agg(F.count("*").alias("dim_date_rows"),
                     F.count_if(F.col("weather_condition") == P.WEATHER_NO_DATA).alias("days_without_weather"))
             .first().asDict())
    m["dim_reference_rows"] = T.read(spark, params.root, "silver", "dim_reference").count()
    _log(spark, params, "silver", "dimensions", m)
    return m


def build_fact_stage(spark: SparkSession, params: JobParams, preset: Preset = P.TRIP_PRESET,
                     cluster: bool = True) -> dict[str, int]:
    """Bronze slices -> silver fact, slice replace, clustered by pickup zone; metrics in the same pass."""
    slices = params.slices
    bronze = T.read(spark, params.root, "bronze", "yellow_trips").filter(F.col(SLICE).isin(*slices))
    zones, codes = (T.read(spark, params.root, "silver", name) for name in ("dim_zone", "dim_reference"))
    fact = facts.build_fact(bronze, zones, codes, preset, stored=True)
    if cluster:
        size = W.slice_bytes(spark, _t(params, "bronze", "yellow_trips"), SLICE, slices)
        fact = W.clustered(fact, [SLICE, "pu_location_id"], tiebreak="trip_id", size=size)
    counters = [F.count_if(c).alias(c) for c in ("is_suspicious", "is_airport_trip", "has_cbd_fee",
                                                  *facts.FLAG_COLUMNS)]
    out_obs = Observation("fact_output")
    written = W.replace_slices(fact, _t(params, "silver", "fact_trips"), SLICE, slices, observe=out_obs,
                               extra_metrics=counters, rebalance=not cluster)
    # Row count of the stored bronze slices: answered from Parquet footers, no column data read.
    m = {"bronze_rows": bronze.count(), "silver_rows": sum(written.values())}
    got = out_obs.get
    m.update({"suspicious_rows": got.get("is_suspicious", 0), "airport_trips": got.get("is_airport_trip", 0),
              "trips_with_cbd_fee": got.get("has_cbd_fee", 0), **{c: got.get(c, 0) for c in facts.FLAG_COLUMNS}})
    m = {k: int(v or 0) for k, v in m.items()}
    m["duplicates_removed"] = m["bronze_rows"] - m["silver_rows"]
    _log(spark, params, "silver", "fact_trips", m)
    return m


def build_marts(spark: SparkSession, params: JobParams, preset: Preset = P.TRIP_PRESET) -> dict[str, int]:
    """G1-G7 over every loaded slice from one scan of the fact (grouping sets, then a
    checkpointed small aggregate); stops on an empty fact instead of writing empty marts (J4)."""
    path = _t(params, "silver", "fact_trips")
    fact = W.read_table(spark, path) if W.table_exists(spark, path) else None
    if fact is None or fact.limit(1).count() == 0:
        raise RuntimeError("silver fact_trips is empty: run the fact stage first")
    dim_date = T.read(spark, params.root, "silver", "dim_date")
    m = {}
    for name, df in marts.all_marts_one_pass(fact, dim_date, preset).items():
        obs = Observation(f"mart_{name}")
        W.overwrite(df.observe(obs, F.count(F.lit(1)).alias("n")), _t(params, "gold", name))
        m[f"{name}_rows"] = int(obs.get.get("n", 0))
    _log(spark, params, "gold", "marts", m)
    return m


def export_marts(spark: SparkSession, params: JobParams, url: str, options: Mapping[str, str]) -> dict[str, int]:
    """Publish the marts over JDBC when enabled; missing marts are reported as 0."""
    if not params.export_enabled:
        return {}
    frames = {}
    for name in marts.MART_NAMES:
        p = _t(params, "gold", name)
        frames[name] = W.read_table(spark, p) if W.table_exists(spark, p) else None
    m = W.publish_jdbc(frames, url, options)
    _log(spark, params, "gold", "export", m)
    return m


def run(spark: SparkSession, params: JobParams, trip_paths: Mapping[str, str], zones_path: str,
        codes_path: str, weather_path: str, preset: Preset = P.TRIP_PRESET, export_url: str | None = None,
        export_options: Mapping[str, str] | None = None) -> dict[str, object]:
    """Whole workflow in dependency order (J6); missing tables are created first.

    ``params.top_k`` overrides the preset's; with ``params.export_enabled`` the marts go to ``export_url`` last.
    """
    if params.export_enabled and not export_url:
        raise ValueError("export is enabled but no export_url is given")
    preset = dataclasses.replace(preset, top_k=params.top_k)
    out: dict[str, object] = {"created": T.ensure_all(spark, params.root)}
    out["trips"] = ingest_trips(spark, params, trip_paths, preset)
    out["zones"] = ingest_zones(spark, params, zones_path, preset)
    out["codes"] = ingest_codes(spark, params, codes_path)
    out["weather"] = ingest_weather(spark, params, weather_path)
    out["dims"] = build_dims(spark, params, preset)
    out["fact"] = build_fact_stage(spark, params, preset)
    out["marts"] = build_marts(spark, params, preset)
    out["export"] = export_marts(spark, params, export_url, export_options or {}) if params.export_enabled else {}
    return out
