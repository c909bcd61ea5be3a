"""Driver queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator group.

Every query reads the driver's tables (or frames Spark derives from them) in
full; none runs on fixed input alone. Column names match ``strata.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.exprs import count_true, pct
from strata.operators import facts, marts
from strata.operators.quality import quarantine_rows
from strata.operators.rules import trip_rules
from strata.plans import driver as D
from strata.plans import mapping as M
from strata.presets import DRIVER_PRESET

Query = Callable[[SparkSession, str], DataFrame]



# -- B1 / B2 / B6: hard rules and quarantine ---------------------------------

def hard_rules_valid(spark, d):
    return D.bronze_split(spark, d)[0]


def hard_rules_invalid(spark, d):
    return D.bronze_split(spark, d)[1]


def rule_violations(spark, d):
    return trip_rules(DRIVER_PRESET).violations(M.raw_trips(spark, d))


def quarantine_json(spark, d):
    raw = M.raw_trips(spark, d)
    rules = trip_rules(DRIVER_PRESET)
    _, invalid = rules.split(raw)
    q = quarantine_rows(invalid, F.concat(F.lit("trips_"), F.col("source_year_month")), "driver",
                        reasons=rules.reasons(invalid))
    return q.select("entity", "raw_record", F.array_join("reasons", ",").alias("reasons"))


# -- B8-B10: dimensions ------------------------------------------------------

def clean_labels(spark, d):
    from strata.functions.exprs import clean_label
    from strata.presets import LABEL_NULL_TOKENS, UNKNOWN_LABEL
    src = M.zone_source(spark, d)
    return src.select(
        "location_id",
        F.col("borough").alias("borough_raw"), clean_label("borough", UNKNOWN_LABEL, LABEL_NULL_TOKENS).alias("borough"),
        F.col("zone").alias("zone_raw"), clean_label("zone", UNKNOWN_LABEL, LABEL_NULL_TOKENS).alias("zone"),
        F.col("service_zone").alias("service_zone_raw"),
        clean_label("service_zone", UNKNOWN_LABEL, LABEL_NULL_TOKENS).alias("service_zone"))


def zone_dim(spark, d):
    return D.zones(spark, d)


def reference_dim(spark, d):
    return D.codes_frame(spark, d)


# -- A11 / B11-B13 / C4: calendar --------------------------------------------

def calendar_dim(spark, d):
    return D.calendar(spark, d)


def condition_ladder(spark, d):
    return D.daily_conditions(spark, d)


def calendar_enriched(spark, d):
    return D.dim_date(spark, d)


# -- B14-B25, C1-C3, D11: the fact -------------------------------------------

def row_hash(spark, d):
    return facts.derive(D.bronze(spark, d)).select("trip_id", *facts.TRIP_KEY)


def dedupe(spark, d):
    li = M.table(spark, d, "lineitem")
    return facts.dedupe(li, ["l_orderkey", "l_linenumber"])


TRIP_DERIVED_COLUMNS = ["trip_id", "source_year_month", "pickup_date", "pickup_hour", "pickup_day_of_week",
                        "duration_min", "trip_distance_km", "avg_speed_mph", "passenger_count", "tip_pct",
                        "cbd_congestion_fee", "airport_fee", "has_cbd_fee"]


def trip_derived(spark, d):
    return facts.derive(D.bronze(spark, d)).select(*TRIP_DERIVED_COLUMNS)


def soft_flags(spark, d):
    return D.enriched(spark, d).select("trip_id", *facts.FLAG_COLUMNS, "is_airport_trip", "is_suspicious")


def role_playing_lookup(spark, d):
    return D.enriched(spark, d).select(
        "trip_id", "pu_location_id", "pu_borough", "pu_zone", "pu_is_airport", "pu_is_unknown",
        "do_location_id", "do_borough", "do_zone", "do_is_airport", "do_is_unknown")


def code_dictionary_lookup(spark, d):
    return D.enriched(spark, d).select("trip_id", "vendor_id", "vendor_name", "ratecode_id", "ratecode_desc",
                                       "payment_type", "payment_desc")


# -- D2 / B29 / D6 / D10: aggregate helpers ----------------------------------

def avg_where_q(spark, d):
    return D.fact(spark, d).groupBy("pu_borough").agg(
        F.count("*").alias("trips"),
        marts.avg_of("total_amount").alias("avg_total_amount"),
        F.round(F.avg("total_amount"), 2).alias("avg_total_amount_all"),
        marts.avg_of("tip_pct").alias("avg_tip_pct"))


def safe_pct(spark, d):
    sums = (D.fact(spark, d).groupBy("trip_distance")
            .agg(F.count("*").alias("trips"), F.sum("fare_amount").alias("_fare"),
                 F.sum("trip_distance").alias("_dist")))
    # the total is one row by construction; distances are any number, so no window over all of them
    total = sums.agg(F.sum("trips").alias("_all")).withColumn("_one", F.lit(1))
    return (sums.withColumn("_one", F.lit(1)).join(F.broadcast(total), "_one")
            .select("trip_distance", "trips",
                    pct(F.col("trips"), F.col("_all")).alias("share_pct"),
                    pct(F.col("_fare"), F.col("_dist")).alias("fare_per_mile_pct")))


def flag_counts(spark, d):
    f = D.fact(spark, d)
    return f.agg(F.count("*").alias("silver_rows"),
                 count_true("is_suspicious").alias("suspicious_rows"),
                 count_true("is_airport_trip").alias("airport_trips"),
                 count_true("has_cbd_fee").alias("trips_with_cbd_fee"),
                 *[count_true(c).alias(c) for c in facts.FLAG_COLUMNS])


# -- G1-G7: marts ------------------------------------------------------------

def trips_daily(spark, d):
    return marts.trips_daily(D.fact(spark, d), D.dim_date(spark, d))


def hourly_demand(spark, d):
    return marts.hourly_demand(M.events_as_trips(spark, d))


def zone_performance(spark, d):
    return marts.zone_performance(D.fact(spark, d))


def top_routes(spark, d):
    return marts.top_routes(D.fact(spark, d), DRIVER_PRESET.top_k)


def payment_mix(spark, d):
    return marts.payment_tips(D.fact(spark, d))


def period_compare(spark, d):
    return marts.congestion_pricing_monthly(D.fact(spark, d), DRIVER_PRESET)


def weather_impact(spark, d):
    return marts.weather_impact(D.fact(spark, d), D.dim_date(spark, d))


def registry() -> dict[str, Query]:
    from strata.plans import entity_queries, io_queries
    q: dict[str, Query] = {
        "hard_rules_valid": hard_rules_valid,
        "hard_rules_invalid": hard_rules_invalid,
        "rule_violations": rule_violations,
        "quarantine_json": quarantine_json,
        "clean_labels": clean_labels,
        "zone_dim": zone_dim,
        "reference_dim": reference_dim,
        "calendar_dim": calendar_dim,
        "condition_ladder": condition_ladder,
        "calendar_enriched": calendar_enriched,
        "row_hash": row_hash,
        "dedupe": dedupe,
        "trip_derived": trip_derived,
        "soft_flags": soft_flags,
        "role_playing_lookup": role_playing_lookup,
        "code_dictionary_lookup": code_dictionary_lookup,
        "avg_where": avg_where_q,
        "safe_pct": safe_pct,
        "flag_counts": flag_counts,
        "trips_daily": trips_daily,
        "hourly_demand": hourly_demand,
        "zone_performance": zone_performance,
        "top_routes": top_routes,
        "payment_mix": payment_mix,
        "period_compare": period_compare,
        "weather_impact": weather_impact,
    }
    q.update(io_queries.registry())
    q.update(entity_queries.registry())
    return q
