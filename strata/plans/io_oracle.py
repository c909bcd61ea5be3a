"""Oracle SQL of the write/read-back queries (the state each must end in)."""

from __future__ import annotations

from strata.plans import oracle as O
from strata.plans.io_queries import CUTOFF, RUN_SLICES
from strata.params import parse_slices


def _in(values) -> str:
    return ", ".join(O.sql_str(v) for v in values)


_AUDIT = "CAST(NULL AS VARCHAR) AS raw_record, CAST(NULL AS VARCHAR) AS reasons"


def _stored(valid: str, source: str, columns: str, bad: str, cte: str) -> str:
    """Valid rows, and the bad ones as (raw_record, reasons)."""
    nulls = ", ".join(f"CAST(NULL AS {t}) AS {c}" for c, t in (x.split() for x in columns.split(",")))
    names = ", ".join(x.split()[0] for x in columns.split(","))
    return O.w(cte, f"""SELECT {names}, {_AUDIT}, '{source}' AS data_source, 'driver' AS run_id, TRUE AS from_file
            FROM ({valid})
            UNION ALL SELECT {nulls}, raw_record, reasons, CAST(NULL AS VARCHAR), 'driver', TRUE FROM ({bad})""")


_ZONE = "location_id INTEGER,borough VARCHAR,zone VARCHAR,service_zone VARCHAR"
_CODE = "code_type VARCHAR,code INTEGER,description VARCHAR"
_DAY = ("weather_date DATE,temperature_max_c DOUBLE,temperature_min_c DOUBLE,precipitation_mm DOUBLE,"
        "snowfall_cm DOUBLE,wind_speed_max_kmh DOUBLE")


def entity_oracle_sql() -> dict[str, str]:
    """Small entities landed with bad lines: five regions make a bad line each, wherever lines are text."""
    json_zone = ("'{\"location_id\":' || (location_id + 9000) || ',\"borough\":\"' || borough || '\",\"zone\":\"' || zone "
                 "|| '\",\"service_zone\":\"' || service_zone || '\"}'")
    return {
        "zones_from_csv": _stored(
            "SELECT location_id, borough, NULLIF(zone, '') AS zone, service_zone FROM zone_src", "zones_csv", _ZONE,
            "SELECT 'x' || r_regionkey || ',' || r_name || ',bad line,none' AS raw_record, "
            "'corrupt_record,required_location_id,zone_in_domain' AS reasons FROM region", O.ZONES),
        "zones_from_parquet": _stored(
            "SELECT * FROM zone_src WHERE location_id % 7 <> 0", "zones_parquet", _ZONE,
            f"SELECT {json_zone} AS raw_record, 'zone_in_domain' AS reasons FROM zone_src WHERE location_id % 7 = 0",
            O.ZONES),
        "codes_from_jsonl": _stored(
            "SELECT * FROM code_src WHERE code IS NOT NULL", "codes_jsonl", _CODE,
            "SELECT '{\"code_type\": \"vendor\", ' || r_name AS raw_record, 'corrupt_record,known_code_type,"
            "required_code,required_code_type,required_description' AS reasons FROM region UNION ALL "
            "SELECT '{\"code_type\":\"' || code_type || '\",\"description\":\"' || description || '\"}', 'required_code' "
            "FROM code_src, (SELECT unnest([1, 2])) twice WHERE code IS NULL", O.CODES),
        "weather_from_documents": _stored(
            "SELECT * FROM weather", "weather_json", _DAY,
            "SELECT DISTINCT '{\"temperature_max_c\":0.0,\"temperature_min_c\":1.0,\"precipitation_mm\":2.0,"
            "\"snowfall_cm\":3.0,\"wind_speed_max_kmh\":4.0}' AS raw_record, 'required_weather_date' AS reasons, "
            "strftime(weather_date, '%Y-%m') AS month FROM weather", O.WEATHER),
        "entity_metrics": O.w(O.ZONES + "," + O.CODES + "," + O.WEATHER + """,
n AS (SELECT (SELECT count(*) FROM zone_src) AS zones, (SELECT count(*) FROM region) AS bad,
  (SELECT count(*) FROM zones WHERE is_unknown) AS unknown,
  (SELECT count(*) FROM code_src) AS codes, (SELECT count(*) FROM code_src WHERE code IS NULL) AS uncoded,
  (SELECT count(*) FROM weather) AS days, (SELECT count(DISTINCT strftime(weather_date, '%Y-%m')) FROM weather) AS months,
  (SELECT count(*) FROM weather WHERE weather_date BETWEEN DATE '1998-11-01' AND DATE '1999-01-31') AS known)""",
            " UNION ALL ".join(
                f"SELECT '{layer}' AS layer, '{entity}' AS entity, '{metric}' AS metric, CAST({e} AS BIGINT) AS value FROM n"
                for layer, entity, metric, e in (
                    ("bronze", "taxi_zones", "rows_read", "zones + bad"), ("bronze", "taxi_zones", "rows_valid", "zones"),
                    ("bronze", "taxi_zones", "rows_quarantined", "bad"),
                    ("bronze", "ref_codes", "rows_read", "2 * codes + bad"),
                    ("bronze", "ref_codes", "rows_valid", "2 * (codes - uncoded)"),
                    ("bronze", "ref_codes", "rows_quarantined", "2 * uncoded + bad"),
                    ("bronze", "weather_daily", "rows_read", "days + months"), ("bronze", "weather_daily", "rows_valid", "days"),
                    ("bronze", "weather_daily", "rows_quarantined", "months"),
                    ("silver", "dimensions", "dim_zone_rows", "zones"), ("silver", "dimensions", "zones_unknown", "unknown"),
                    ("silver", "dimensions", "dim_date_rows", "92"),
                    ("silver", "dimensions", "days_without_weather", "92 - known"),
                    ("silver", "dimensions", "dim_reference_rows", "codes - uncoded")))),
        "overwrite": "SELECT c_nationkey, count(*) AS customers FROM customer GROUP BY c_nationkey",
    }


def io_oracle_sql() -> dict[str, str]:
    run = parse_slices(RUN_SLICES)
    months = """
months AS (
  SELECT strftime(unnest(generate_series(date_trunc('month', min(o_orderdate)),
                                         date_trunc('month', max(o_orderdate)) + INTERVAL 1 MONTH,
                                         INTERVAL 1 MONTH)), '%Y-%m') AS ym
  FROM orders)"""
    bronze_counts = f"""
slice_counts AS (
  SELECT m.ym,
    CAST(count(r._valid) AS BIGINT) AS rows_read,
    CAST(COALESCE(count_if(r._valid), 0) AS BIGINT) AS rows_valid,
    CAST(COALESCE(count_if(NOT r._valid), 0) AS BIGINT) AS rows_quarantined,
    CAST(COALESCE(count_if(r._valid AND r.passenger_count IS NULL), 0) AS BIGINT) AS null_passenger_count
  FROM months m LEFT JOIN raw_flagged r ON r.source_year_month = m.ym
  GROUP BY m.ym)"""
    silver = ("SELECT CAST(count(*) AS BIGINT) AS silver_rows, "
              + ", ".join(f"CAST(count_if({c}) AS BIGINT) AS {c}" for c in (
                  "is_suspicious", "is_airport_trip", "has_cbd_fee", "flag_long_duration", "flag_zero_distance",
                  "flag_high_speed", "flag_extreme_fare", "flag_unknown_zone"))
              + " FROM fact")
    silver_names = [("bronze_rows", "(SELECT count(*) FROM bronze)"), ("silver_rows", "s.silver_rows"),
                    ("suspicious_rows", "s.is_suspicious"), ("airport_trips", "s.is_airport_trip"),
                    ("trips_with_cbd_fee", "s.has_cbd_fee"),
                    *[(c, f"s.{c}") for c in ("flag_long_duration", "flag_zero_distance", "flag_high_speed",
                                              "flag_extreme_fare", "flag_unknown_zone")],
                    ("duplicates_removed", "(SELECT count(*) FROM bronze) - s.silver_rows")]
    silver_rows = " UNION ALL ".join(
        f"SELECT 'silver' AS layer, 'fact_trips' AS entity, {O.sql_str(n)} AS metric, CAST({e} AS BIGINT) AS value "
        f"FROM silver_counts s" for n, e in silver_names)
    bronze_rows = " UNION ALL ".join(
        f"SELECT 'bronze' AS layer, 'yellow_trips_' || ym AS entity, {O.sql_str(mn)} AS metric, {mn} AS value "
        f"FROM slice_counts" for mn in ("rows_read", "rows_valid", "rows_quarantined", "null_passenger_count"))
    return {
        "drift_normalize": f"""SELECT o_orderkey AS order_key, o_custkey AS cust_key, o_orderstatus AS status,
              o_totalprice AS total_price, o_orderdate AS order_date,
              CASE WHEN o_orderdate < TIMESTAMP '{CUTOFF}' THEN o_orderpriority END AS priority,
              CASE WHEN o_orderdate < TIMESTAMP '{CUTOFF}' THEN 'A' ELSE 'B' END AS delivery
            FROM orders""",
        "delivery_groups": f"""WITH o AS (SELECT *, coalesce(strftime(o_orderdate, '%Y-%m'), 'none') AS delivery,
              coalesce(year(o_orderdate) % 2 = 1, FALSE) AS odd FROM orders)
            SELECT delivery, count(*) AS orders,
              {O.R("CAST(sum(CAST(round(o_totalprice * 100) AS HUGEINT)) AS DOUBLE) / 100", 2)} AS total_price,
              (SELECT CAST(count(DISTINCT odd) AS INTEGER) FROM o) AS scans
            FROM o GROUP BY delivery""",
        "bucketed_upsert": """SELECT c_custkey, c_name, c_nationkey,
              CASE WHEN c_custkey % 1000 = 0 THEN CAST(0 AS DOUBLE) ELSE c_acctbal END AS c_acctbal, c_mktsegment, FALSE AS stale
            FROM customer WHERE c_custkey IS NOT NULL
            UNION ALL SELECT c_custkey + 1, c_name, c_nationkey, c_acctbal, c_mktsegment, FALSE
            FROM customer WHERE c_custkey = (SELECT max(c_custkey) FROM customer)""",
        "skipped_files": O.w(O.FACT, "SELECT pu_location_id, count(*) AS trips FROM fact GROUP BY pu_location_id"),
        "parallel_arrays_to_rows": O.w(O.WEATHER, "SELECT * FROM weather"),
        "slice_scan": f"""SELECT *, strftime(o_orderdate, '%Y-%m') AS source_year_month FROM orders
            WHERE strftime(o_orderdate, '%Y-%m') IN ({_in(run)})""",
        "replace_slices": O.w(O.BRONZE, f"""SELECT * FROM bronze
            WHERE source_year_month NOT IN ({_in(run)})
               OR (source_year_month IN ({_in(run[:2])}) AND vendor_id <> 9)"""),
        "upsert": """SELECT c_custkey, c_name, c_nationkey,
              CASE WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN c_acctbal + 100 ELSE c_acctbal END
                AS c_acctbal, c_mktsegment
            FROM customer""",
        "clustered_layout": O.w(O.FACT, "SELECT * FROM fact"),
        "load_metrics": O.w(O.FACT + "," + months + "," + bronze_counts + f""",
silver_counts AS ({silver})""", bronze_rows + " UNION ALL " + silver_rows),
    }
