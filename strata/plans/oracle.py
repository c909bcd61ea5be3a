"""DuckDB SQL equivalents of the driver queries (the correctness oracle).

Each query is an independent SQL text over the pre-registered views. Rounding
goes through the decimal text of the double, as Spark's ``round`` does, and
integer widths are cast to Spark's.
"""

from __future__ import annotations

from types import SimpleNamespace

# Fixed values, written out: the oracle must not follow the engine's presets.
P = SimpleNamespace(
    UNKNOWN_LABEL="Desconocido", LABEL_NULL_TOKENS=("N/A", "NA", "Unknown", ""), CARD_PAYMENT=1,
    DAY_NAMES={1: "domingo", 2: "lunes", 3: "martes", 4: "miércoles", 5: "jueves", 6: "viernes", 7: "sábado"},
    MONTH_NAMES={1: "enero", 2: "febrero", 3: "marzo", 4: "abril", 5: "mayo", 6: "junio", 7: "julio",
                 8: "agosto", 9: "septiembre", 10: "octubre", 11: "noviembre", 12: "diciembre"},
    WEATHER_SNOW="nieve", WEATHER_HEAVY_RAIN="lluvia fuerte", WEATHER_RAIN="lluvia", WEATHER_DRY="seco",
    WEATHER_NO_DATA="sin dato", PERIOD_WITH="con cobro", PERIOD_WITHOUT="sin cobro")
DP = SimpleNamespace(
    zone_min_id=1, zone_max_id=265, unknown_zone_ids=(24, 25), unknown_label="Desconocido", top_k=20,
    focus_borough="AMERICA", cutover_slice="1998-01",
    flags=SimpleNamespace(long_duration_min=2_000_000.0, high_speed_mph=0.02, extreme_fare=900.0),
    weather=SimpleNamespace(snow_above=1.0, heavy_rain_from=3.0, rain_from=1.0))
EVENT_SUSPICIOUS_VALUE = 100.0


def R(expr: str, digits: int) -> str:
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def dbl(x) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def case_map(expr: str, mapping: dict) -> str:
    whens = " ".join(f"WHEN {k} THEN {sql_str(v)}" for k, v in mapping.items())
    return f"CASE {expr} {whens} END"


def clean(expr: str) -> str:
    toks = ", ".join(sql_str(t) for t in P.LABEL_NULL_TOKENS)
    return (f"CASE WHEN trim({expr}) IS NULL OR trim({expr}) IN ({toks}) "
            f"THEN {sql_str(P.UNKNOWN_LABEL)} ELSE trim({expr}) END")


def pct(num: str, den: str, digits: int = 2) -> str:
    return R(f"CAST({num} AS DOUBLE) * CAST(100.0 AS DOUBLE) / NULLIF({den}, 0)", digits)


MEASURE_SCALE = {"trip_distance_km": 3, "duration_min": 2, "tip_pct": 2, "avg_speed_mph": 2, "total_amount": 6}


def total(expr: str) -> str:
    return f"CAST(sum(CAST(round(({expr}) * 1000000) AS HUGEINT)) AS DOUBLE) / 1000000"


def mean(expr: str, scale: int | None) -> str:
    if scale is None:
        return f"avg({expr})"
    m = 10 ** scale
    return f"CAST(sum(CAST(round(({expr}) * {m}) AS BIGINT)) AS DOUBLE) / NULLIF(count({expr}) * {m}, 0)"


def avg_where(expr: str, cond: str | None, digits: int = 2) -> str:
    x = expr if cond is None else f"CASE WHEN {cond} THEN {expr} END"
    return R(mean(x, MEASURE_SCALE.get(expr)), digits)


RAW_COLS = ["vendor_id", "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance", "ratecode_id",
            "store_and_fwd_flag", "pu_location_id", "do_location_id", "payment_type", "fare_amount", "extra",
            "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount",
            "congestion_surcharge", "airport_fee", "cbd_congestion_fee", "source_year_month"]

RAW_TRIPS = """
raw_trips AS (
  SELECT
    CAST(CASE o.o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 9 END AS INTEGER) AS vendor_id,
    o.o_orderdate AS pickup_datetime,
    l.l_shipdate AS dropoff_datetime,
    CAST(l.l_linenumber % 4 AS INTEGER) AS passenger_count,
    l.l_quantity - 1 AS trip_distance,
    CAST(CASE l.l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 END AS INTEGER) AS ratecode_id,
    CASE WHEN l.l_linestatus = 'O' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    CAST(c.c_nationkey + 1 AS INTEGER) AS pu_location_id,
    CAST(s.s_nationkey + 1 AS INTEGER) AS do_location_id,
    CAST(split_part(o.o_orderpriority, '-', 1) AS INTEGER) AS payment_type,
    l.l_extendedprice / 100 AS fare_amount,
    l.l_tax AS extra,
    CAST(0.5 AS DOUBLE) AS mta_tax,
    (l.l_extendedprice / 100) * l.l_discount AS tip_amount,
    CAST(0.0 AS DOUBLE) AS tolls_amount,
    CAST(1.0 AS DOUBLE) AS improvement_surcharge,
    (l.l_extendedprice / 100) * (1 + l.l_discount + l.l_tax) AS total_amount,
    CAST(2.5 AS DOUBLE) AS congestion_surcharge,
    CASE WHEN l.l_linenumber = 6 THEN CAST(1.75 AS DOUBLE) END AS airport_fee,
    CASE WHEN l.l_linestatus = 'O' AND o.o_orderdate >= TIMESTAMP '1998-01-01'
         THEN CAST(0.75 AS DOUBLE) END AS cbd_congestion_fee,
    strftime(CASE WHEN l.l_linenumber = 7 THEN o.o_orderdate + INTERVAL 1 MONTH ELSE o.o_orderdate END,
             '%Y-%m') AS source_year_month
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
)"""

# name -> SQL predicate, in RuleSet order
TRIP_RULES = [
    ("required_pickup_datetime", "pickup_datetime IS NOT NULL"),
    ("required_dropoff_datetime", "dropoff_datetime IS NOT NULL"),
    ("required_pu_location_id", "pu_location_id IS NOT NULL"),
    ("required_do_location_id", "do_location_id IS NOT NULL"),
    ("dropoff_after_pickup", "dropoff_datetime > pickup_datetime"),
    ("pickup_in_slice", "strftime(pickup_datetime, '%Y-%m') = source_year_month"),
    ("distance_non_negative", "trip_distance >= 0"),
    ("fare_non_negative", "fare_amount >= 0"),
    ("total_non_negative", "total_amount >= 0"),
    ("pu_zone_in_domain", f"pu_location_id BETWEEN {DP.zone_min_id} AND {DP.zone_max_id}"),
    ("do_zone_in_domain", f"do_location_id BETWEEN {DP.zone_min_id} AND {DP.zone_max_id}"),
]
VERDICT = "COALESCE(" + " AND ".join(f"({e})" for _, e in TRIP_RULES) + ", FALSE)"

BRONZE = RAW_TRIPS + f""",
raw_flagged AS (SELECT *, {VERDICT} AS _valid FROM raw_trips),
bronze AS (SELECT * EXCLUDE (_valid) FROM raw_flagged WHERE _valid),
rejected AS (SELECT * EXCLUDE (_valid) FROM raw_flagged WHERE NOT _valid)"""

KEY = ["vendor_id", "pickup_datetime", "dropoff_datetime", "pu_location_id", "do_location_id",
       "trip_distance", "fare_amount", "total_amount", "payment_type"]
TRIP_ID = "sha256(concat_ws('|', " + ", ".join(f"CAST({k} AS VARCHAR)" for k in KEY) + "))"

def derived_ctes(src: str, prefix: str = "") -> str:
    return f"""
{prefix}derived1 AS (
  SELECT * REPLACE (
      CASE WHEN passenger_count > 0 THEN passenger_count END AS passenger_count,
      COALESCE(cbd_congestion_fee, CAST(0.0 AS DOUBLE)) AS cbd_congestion_fee,
      COALESCE(airport_fee, CAST(0.0 AS DOUBLE)) AS airport_fee),
    {TRIP_ID} AS trip_id,
    CAST(pickup_datetime AS DATE) AS pickup_date,
    CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour,
    CAST(dayofweek(pickup_datetime) + 1 AS INTEGER) AS pickup_day_of_week,
    {R("date_diff('second', pickup_datetime, dropoff_datetime) / 60", 2)} AS duration_min,
    {R("trip_distance * CAST(1.60934 AS DOUBLE)", 3)} AS trip_distance_km,
    CASE WHEN payment_type = {P.CARD_PAYMENT} AND fare_amount > 0
         THEN {R("tip_amount / fare_amount * 100", 2)} END AS tip_pct
  FROM {src}),
{prefix}derived AS (
  SELECT *,
    CASE WHEN duration_min > 0 THEN {R("trip_distance / (duration_min / 60)", 2)} END AS avg_speed_mph,
    cbd_congestion_fee > 0 AS has_cbd_fee
  FROM {prefix}derived1)"""


DERIVED = BRONZE + "," + derived_ctes("bronze")

ZONES = f"""
zone_src AS (
  SELECT CAST(n.n_nationkey + 1 AS INTEGER) AS location_id,
    CASE WHEN n.n_nationkey = 24 THEN 'N/A'
         WHEN n.n_nationkey % 2 = 0 THEN ' ' || r.r_name || ' ' ELSE r.r_name END AS borough,
    CASE WHEN n.n_nationkey = 0 THEN '' ELSE n.n_name END AS zone,
    CASE WHEN n.n_nationkey = 5 THEN 'EWR' WHEN n.n_nationkey % 4 = 0 THEN 'Airports'
         WHEN n.n_nationkey % 4 = 1 THEN 'Yellow Zone' WHEN n.n_nationkey % 4 = 2 THEN ' Boro Zone '
         ELSE 'Unknown' END AS service_zone
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey),
zone_clean AS (
  SELECT location_id, {clean("borough")} AS borough, {clean("zone")} AS zone,
         {clean("service_zone")} AS service_zone
  FROM zone_src
  WHERE location_id IS NOT NULL AND location_id BETWEEN {DP.zone_min_id} AND {DP.zone_max_id}),
zones AS (
  SELECT *, service_zone IN ('Airports', 'EWR') AS is_airport, service_zone = 'Yellow Zone' AS is_yellow_zone,
         (borough = {sql_str(P.UNKNOWN_LABEL)} OR location_id IN ({", ".join(map(str, DP.unknown_zone_ids))}))
           AS is_unknown
  FROM zone_clean)"""

CODES = """
code_src AS (
  SELECT * FROM (SELECT DISTINCT 'vendor' AS code_type,
      CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 9 END AS INTEGER) AS code,
      'order status ' || o_orderstatus AS description FROM orders)
  UNION ALL
  SELECT * FROM (SELECT DISTINCT 'ratecode', CAST(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 END AS INTEGER),
      ' return flag ' || l_returnflag || ' ' FROM lineitem)
  UNION ALL
  SELECT * FROM (SELECT DISTINCT 'payment_type', CAST(split_part(o_orderpriority, '-', 1) AS INTEGER),
      substr(o_orderpriority, strpos(o_orderpriority, '-') + 1) FROM orders)),
codes AS (
  SELECT code_type, code, trim(description) AS description FROM code_src
  WHERE code_type IS NOT NULL AND code IS NOT NULL AND description IS NOT NULL
    AND code_type IN ('vendor', 'ratecode', 'payment_type'))"""

FL = DP.flags


def enriched_ctes(derived: str, p: str = "") -> str:
    return f"""
{p}enriched0 AS (
  SELECT d.*,
    pz.borough AS pu_borough, pz.zone AS pu_zone, pz.is_airport AS pu_is_airport, pz.is_unknown AS pu_is_unknown,
    dz.borough AS do_borough, dz.zone AS do_zone, dz.is_airport AS do_is_airport, dz.is_unknown AS do_is_unknown,
    COALESCE(cv.description, {sql_str(DP.unknown_label)}) AS vendor_name,
    COALESCE(cr.description, {sql_str(DP.unknown_label)}) AS ratecode_desc,
    COALESCE(cp.description, {sql_str(DP.unknown_label)}) AS payment_desc
  FROM {derived} d
  LEFT JOIN zones pz ON d.pu_location_id = pz.location_id
  LEFT JOIN zones dz ON d.do_location_id = dz.location_id
  LEFT JOIN (SELECT code, description FROM codes WHERE code_type = 'vendor') cv ON d.vendor_id = cv.code
  LEFT JOIN (SELECT code, description FROM codes WHERE code_type = 'ratecode') cr ON d.ratecode_id = cr.code
  LEFT JOIN (SELECT code, description FROM codes WHERE code_type = 'payment_type') cp
    ON d.payment_type = cp.code),
{p}enriched1 AS (
  SELECT *,
    (COALESCE(pu_is_airport OR do_is_airport, FALSE) OR ratecode_id IN (2, 3) OR airport_fee > 0)
      AS is_airport_trip,
    duration_min > {dbl(FL.long_duration_min)} AS flag_long_duration,
    (trip_distance = 0 AND fare_amount > 0) AS flag_zero_distance,
    avg_speed_mph > {dbl(FL.high_speed_mph)} AS flag_high_speed,
    fare_amount > {dbl(FL.extreme_fare)} AS flag_extreme_fare,
    COALESCE(pu_is_unknown OR do_is_unknown, TRUE) AS flag_unknown_zone
  FROM {p}enriched0),
{p}enriched AS (
  SELECT *, (COALESCE(flag_long_duration, FALSE) OR COALESCE(flag_zero_distance, FALSE)
             OR COALESCE(flag_high_speed, FALSE) OR COALESCE(flag_extreme_fare, FALSE)
             OR COALESCE(flag_unknown_zone, FALSE)) AS is_suspicious
  FROM {p}enriched1)"""


ENRICHED = DERIVED + "," + ZONES + "," + CODES + "," + enriched_ctes("derived")

FACT_COLUMNS = [
    "trip_id", "source_year_month", "vendor_id", "vendor_name",
    "pickup_datetime", "dropoff_datetime", "pickup_date", "pickup_hour", "pickup_day_of_week",
    "pu_location_id", "pu_borough", "pu_zone", "do_location_id", "do_borough", "do_zone",
    "passenger_count", "trip_distance", "trip_distance_km", "duration_min", "avg_speed_mph",
    "ratecode_id", "ratecode_desc", "payment_type", "payment_desc",
    "fare_amount", "extra", "mta_tax", "tip_amount", "tip_pct", "tolls_amount", "improvement_surcharge",
    "congestion_surcharge", "airport_fee", "cbd_congestion_fee", "total_amount",
    "has_cbd_fee", "is_airport_trip", "flag_long_duration", "flag_zero_distance", "flag_high_speed",
    "flag_extreme_fare", "flag_unknown_zone", "is_suspicious",
]
_ORDER = ", ".join(f"{c} ASC NULLS FIRST" for c in RAW_COLS)
# The fact de-duplicates bronze rows on trip_id first (survivor: smallest row in bronze column order).
FACT = BRONZE + f""",
bronze_keyed AS (SELECT *, {TRIP_ID} AS _tid FROM bronze),
bronze_dedup AS (
  SELECT * EXCLUDE (_rn, _tid) FROM (
    SELECT *, row_number() OVER (PARTITION BY _tid ORDER BY {_ORDER}) AS _rn FROM bronze_keyed)
  WHERE _rn = 1),""" + derived_ctes("bronze_dedup", "f_") + "," + ZONES + "," + CODES + "," + \
    enriched_ctes("f_derived", "f_") + f""",
fact AS (SELECT {", ".join(FACT_COLUMNS)} FROM f_enriched)"""

WL = DP.weather
WEATHER = f"""
weather AS (
  SELECT CAST(o_orderdate AS DATE) AS weather_date,
    {R("max(o_totalprice) / 10000", 1)} AS temperature_max_c,
    {R("min(o_totalprice) / 10000", 1)} AS temperature_min_c,
    CAST(count_if(o_orderpriority = '1-URGENT') AS DOUBLE) AS precipitation_mm,
    CAST(count_if(o_orderpriority = '5-LOW' AND o_orderstatus = 'P') AS DOUBLE) AS snowfall_cm,
    CAST(count(*) AS DOUBLE) AS wind_speed_max_kmh
  FROM orders GROUP BY 1)"""


def ladder_sql(snow: str = "snowfall_cm", rain: str = "precipitation_mm") -> str:
    return (f"CASE WHEN {snow} > {dbl(WL.snow_above)} THEN {sql_str(P.WEATHER_SNOW)} "
            f"WHEN {rain} >= {dbl(WL.heavy_rain_from)} THEN {sql_str(P.WEATHER_HEAVY_RAIN)} "
            f"WHEN {rain} >= {dbl(WL.rain_from)} THEN {sql_str(P.WEATHER_RAIN)} "
            f"WHEN {rain} IS NOT NULL THEN {sql_str(P.WEATHER_DRY)} ELSE {sql_str(P.WEATHER_NO_DATA)} END")


CALENDAR = f"""
bounds AS (SELECT CAST(date_trunc('month', min(o_orderdate)) AS DATE) AS start_d,
                  CAST(last_day(max(o_orderdate)) AS DATE) AS end_d FROM orders),
cal AS (SELECT CAST(unnest(generate_series(start_d, end_d, INTERVAL 1 DAY)) AS DATE) AS date FROM bounds),
calendar AS (
  SELECT date,
    CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key,
    CAST(year(date) AS INTEGER) AS year,
    CAST(quarter(date) AS INTEGER) AS quarter,
    CAST(month(date) AS INTEGER) AS month,
    strftime(date, '%Y-%m') AS year_month,
    CAST(day(date) AS INTEGER) AS day,
    CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week,
    {case_map("dayofweek(date) + 1", P.DAY_NAMES)} AS day_name,
    {case_map("month(date)", P.MONTH_NAMES)} AS month_name,
    dayofweek(date) + 1 IN (1, 7) AS is_weekend
  FROM cal)"""

DIM_DATE = CALENDAR + "," + WEATHER + f""",
dim_date AS (
  SELECT c.*, w.temperature_max_c, w.temperature_min_c, w.precipitation_mm, w.snowfall_cm,
         w.wind_speed_max_kmh, {ladder_sql("w.snowfall_cm", "w.precipitation_mm")} AS weather_condition
  FROM calendar c LEFT JOIN weather w ON c.date = w.weather_date)"""

CLEAN = "NOT is_suspicious"


def base_aggs() -> str:
    return (f"CAST(count(*) AS BIGINT) AS trips, {R(total('total_amount'), 2)} AS revenue, "
            f"{avg_where('total_amount', CLEAN)} AS avg_total_amount, "
            f"{avg_where('trip_distance_km', CLEAN)} AS avg_distance_km, "
            f"{avg_where('duration_min', CLEAN)} AS avg_duration_min, "
            f"{avg_where('tip_pct', CLEAN)} AS avg_tip_pct")


def w(ctes: str, body: str) -> str:
    return "WITH " + ctes.strip() + "\n" + body


def oracle_sql() -> dict[str, str]:
    rule_union = " UNION ALL ".join(
        f"SELECT {sql_str(n)} AS rule, CAST(count_if(NOT COALESCE({e}, FALSE)) AS BIGINT) AS rows_failed "
        f"FROM raw_trips" for n, e in TRIP_RULES)
    reasons = "concat_ws(',', " + ", ".join(
        f"CASE WHEN NOT COALESCE({e}, FALSE) THEN {sql_str(n)} END" for n, e in TRIP_RULES) + ")"
    ts = "strftime({c}, '%Y-%m-%dT%H:%M:%S.%g')"

    def jfield(c: str) -> str:
        if c in ("pickup_datetime", "dropoff_datetime"):
            v = "'\"' || " + ts.format(c=c) + " || '\"'"
        elif c in ("store_and_fwd_flag", "source_year_month"):
            v = "'\"' || " + c + " || '\"'"
        else:
            v = f"CAST({c} AS VARCHAR)"
        return f"'\"{c}\":' || {v}"

    raw_json = "'{' || concat_ws(',', " + ", ".join(jfield(c) for c in RAW_COLS) + ") || '}'"
    li_cols = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
               "l_returnflag", "l_linestatus", "l_shipdate"]
    li_order = ", ".join(f"{c} ASC NULLS FIRST" for c in li_cols)

    q = {
        "hard_rules_valid": w(BRONZE, "SELECT * FROM bronze"),
        "hard_rules_invalid": w(BRONZE, "SELECT * FROM rejected"),
        "rule_violations": w(RAW_TRIPS, rule_union),
        "quarantine_json": w(BRONZE, f"SELECT 'trips_' || source_year_month AS entity, {raw_json} AS raw_record, "
                                     f"{reasons} AS reasons FROM rejected"),
        "clean_labels": w(ZONES, f"SELECT location_id, borough AS borough_raw, {clean('borough')} AS borough, "
                                 f"zone AS zone_raw, {clean('zone')} AS zone, service_zone AS service_zone_raw, "
                                 f"{clean('service_zone')} AS service_zone FROM zone_src"),
        "zone_dim": w(ZONES, "SELECT * FROM zones"),
        "reference_dim": w(CODES, "SELECT * FROM codes"),
        "calendar_dim": w(CALENDAR, "SELECT * FROM calendar"),
        "condition_ladder": w(WEATHER, f"SELECT weather_date, precipitation_mm, snowfall_cm, {ladder_sql()} "
                                       f"AS weather_condition FROM weather"),
        "calendar_enriched": w(DIM_DATE, "SELECT * FROM dim_date"),
        "row_hash": w(DERIVED, "SELECT trip_id, " + ", ".join(KEY) + " FROM derived"),
        "dedupe": ("SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, "
                   f"l_linenumber ORDER BY {li_order}) AS _rn FROM lineitem) WHERE _rn = 1"),
        "trip_derived": w(DERIVED, "SELECT trip_id, source_year_month, pickup_date, pickup_hour, pickup_day_of_week, "
                                   "duration_min, trip_distance_km, avg_speed_mph, passenger_count, tip_pct, "
                                   "cbd_congestion_fee, airport_fee, has_cbd_fee FROM derived"),
        "soft_flags": w(ENRICHED, "SELECT trip_id, flag_long_duration, flag_zero_distance, flag_high_speed, "
                                  "flag_extreme_fare, flag_unknown_zone, is_airport_trip, is_suspicious "
                                  "FROM enriched"),
        "role_playing_lookup": w(ENRICHED, "SELECT trip_id, pu_location_id, pu_borough, pu_zone, pu_is_airport, "
                                           "pu_is_unknown, do_location_id, do_borough, do_zone, do_is_airport, "
                                           "do_is_unknown FROM enriched"),
        "code_dictionary_lookup": w(ENRICHED, "SELECT trip_id, vendor_id, vendor_name, ratecode_id, ratecode_desc, "
                                              "payment_type, payment_desc FROM enriched"),
        "avg_where": w(FACT, f"SELECT pu_borough, CAST(count(*) AS BIGINT) AS trips, "
                             f"{avg_where('total_amount', CLEAN)} AS avg_total_amount, "
                             f"{R('avg(total_amount)', 2)} AS avg_total_amount_all, "
                             f"{avg_where('tip_pct', CLEAN)} AS avg_tip_pct FROM fact GROUP BY pu_borough"),
        "safe_pct": w(FACT, f"SELECT trip_distance, trips, {pct('trips', 'sum(trips) OVER ()')} AS share_pct, "
                            f"{pct('f', 'dist')} AS fare_per_mile_pct FROM (SELECT trip_distance, "
                            f"CAST(count(*) AS BIGINT) AS trips, sum(fare_amount) AS f, sum(trip_distance) AS dist "
                            f"FROM fact GROUP BY trip_distance)"),
        "flag_counts": w(FACT, "SELECT CAST(count(*) AS BIGINT) AS silver_rows, "
                               + ", ".join(f"CAST(sum(CAST({c} AS INTEGER)) AS BIGINT) AS {a}" for c, a in [
                                   ("is_suspicious", "suspicious_rows"), ("is_airport_trip", "airport_trips"),
                                   ("has_cbd_fee", "trips_with_cbd_fee"),
                                   *[(f, f) for f in FACT_COLUMNS if f.startswith("flag_")]])
                               + " FROM fact"),
        "trips_daily": w(FACT + "," + DIM_DATE,
                         f"SELECT a.*, d.day_name, d.is_weekend, d.weather_condition, d.temperature_max_c, "
                         f"d.temperature_min_c, d.precipitation_mm, d.snowfall_cm FROM (SELECT pickup_date, "
                         f"pu_borough, {base_aggs()} FROM fact GROUP BY pickup_date, pu_borough) a "
                         f"LEFT JOIN dim_date d ON a.pickup_date = d.date"),
        "zone_performance": w(FACT, f"""SELECT *, {pct('trips', 'sum(trips) OVER ()', 3)} AS share_trips_pct,
              CAST(dense_rank() OVER (PARTITION BY pu_borough ORDER BY trips DESC) AS INTEGER) AS rank_in_borough,
              CAST(dense_rank() OVER (ORDER BY trips DESC) AS INTEGER) AS rank_overall
            FROM (SELECT pu_location_id, pu_borough, pu_zone, {base_aggs()},
                    {R("avg(CAST(is_airport_trip AS INTEGER)) * CAST(100.0 AS DOUBLE)", 2)} AS airport_trips_pct
                  FROM fact GROUP BY pu_location_id, pu_borough, pu_zone)"""),
        "top_routes": w(FACT, f"""SELECT * FROM (
              SELECT *, CAST(row_number() OVER (PARTITION BY pu_borough ORDER BY trips DESC,
                  pu_zone ASC NULLS FIRST, do_borough ASC NULLS FIRST, do_zone ASC NULLS FIRST) AS INTEGER)
                  AS rank_in_borough
              FROM (SELECT pu_borough, pu_zone, do_borough, do_zone, CAST(count(*) AS BIGINT) AS trips,
                      {avg_where("duration_min", None)} AS avg_duration_min,
                      {avg_where("total_amount", None)} AS avg_total_amount,
                      {R(f"{total('fare_amount')} / NULLIF({total('trip_distance')}, 0)", 2)} AS fare_per_mile
                    FROM fact WHERE {CLEAN} GROUP BY pu_borough, pu_zone, do_borough, do_zone))
            WHERE rank_in_borough <= {DP.top_k}"""),
        "payment_mix": w(FACT, f"""SELECT *, {pct('trips', 'sum(trips) OVER (PARTITION BY pu_borough)')}
                AS share_in_borough_pct
            FROM (SELECT pu_borough, payment_desc, CAST(count(*) AS BIGINT) AS trips,
                    {R(total("tip_amount"), 2)} AS total_tips, {avg_where('tip_pct', CLEAN)} AS avg_tip_pct
                  FROM fact GROUP BY pu_borough, payment_desc)"""),
        "period_compare": w(FACT, f"""SELECT * EXCLUDE (_prev),
                {pct('trips - _prev', '_prev')} AS trips_change_pct,
                CASE WHEN source_year_month >= {sql_str(DP.cutover_slice)} THEN {sql_str(P.PERIOD_WITH)}
                     ELSE {sql_str(P.PERIOD_WITHOUT)} END AS period
            FROM (SELECT *, {pct('trips_with_cbd_fee', 'trips')} AS cbd_fee_trips_pct,
                    lag(trips) OVER (ORDER BY source_year_month) AS _prev
                  FROM (SELECT source_year_month, CAST(count(*) AS BIGINT) AS trips,
                          CAST(sum(CAST(has_cbd_fee AS INTEGER)) AS BIGINT) AS trips_with_cbd_fee,
                          {R(total("cbd_congestion_fee"), 2)} AS cbd_fee_revenue,
                          {R(total("total_amount"), 2)} AS revenue,
                          {avg_where('total_amount', CLEAN)} AS avg_total_amount,
                          {avg_where('avg_speed_mph', f"{CLEAN} AND pu_borough = {sql_str(DP.focus_borough)}")}
                            AS avg_speed_manhattan_mph,
                          {avg_where('duration_min', f"{CLEAN} AND pu_borough = {sql_str(DP.focus_borough)}")}
                            AS avg_duration_manhattan_min
                        FROM fact GROUP BY source_year_month))"""),
        "weather_impact": w(FACT + "," + DIM_DATE, f"""SELECT weather_condition, is_weekend,
                CAST(count(*) AS BIGINT) AS days, {R("avg(trips)", 0)} AS avg_daily_trips,
                {R(mean("avg_tip_pct", 2), 2)} AS avg_tip_pct
            FROM (SELECT a.*, d.weather_condition, d.is_weekend
                  FROM (SELECT pickup_date, CAST(count(*) AS BIGINT) AS trips,
                          {avg_where('tip_pct', CLEAN)} AS avg_tip_pct FROM fact GROUP BY pickup_date) a
                  JOIN dim_date d ON a.pickup_date = d.date)
            GROUP BY weather_condition, is_weekend"""),
        "hourly_demand": f"""WITH ev AS (
              SELECT CAST(dayofweek(ts) + 1 AS INTEGER) AS pickup_day_of_week, CAST(hour(ts) AS INTEGER) AS pickup_hour,
                CAST(json_extract_string(props, '$.k') AS DOUBLE) AS avg_speed_mph, value AS total_amount,
                COALESCE(value > {dbl(EVENT_SUSPICIOUS_VALUE)}, FALSE) AS is_suspicious
              FROM events)
            SELECT *, {case_map('pickup_day_of_week', P.DAY_NAMES)} AS day_name,
              {pct('trips', 'sum(trips) OVER ()', 3)} AS share_pct,
              CAST(dense_rank() OVER (ORDER BY trips DESC) AS INTEGER) AS rank_busiest
            FROM (SELECT pickup_day_of_week, pickup_hour, CAST(count(*) AS BIGINT) AS trips,
                    {avg_where('avg_speed_mph', CLEAN)} AS avg_speed_mph,
                    {avg_where('total_amount', CLEAN)} AS avg_total_amount
                  FROM ev GROUP BY pickup_day_of_week, pickup_hour)""",
    }
    from strata.plans.io_oracle import entity_oracle_sql, io_oracle_sql
    q.update(io_oracle_sql())
    q.update(entity_oracle_sql())
    return q
