"""Maps the driver's TPC-H-like tables onto the canonical trip inputs.

Nothing here is synthesized: every frame is derived from the given tables, so
the work grows with them. One order line plays one trip:

=====================  ====================================================
canonical column       expression
=====================  ====================================================
pickup / dropoff       o_orderdate / l_shipdate (about half the lines ship
                       before the order date, so the time-order rule splits)
source_year_month      month of o_orderdate, one month later for line 7
                       (those lines break the "pickup in slice" rule)
pu / do_location_id    c_nationkey + 1 / s_nationkey + 1 (nations = zones,
                       regions = boroughs)
trip_distance          l_quantity - 1 (gives zero distances)
fare / tip / total     l_extendedprice / 100; fare * l_discount;
                       fare * (1 + l_discount + l_tax)
passenger_count        l_linenumber % 4 (0 = unknown)
payment_type           first character of o_orderpriority (1-5)
ratecode_id            returnflag A -> 1, N -> 2, R -> NULL
vendor_id              orderstatus F -> 1, O -> 2, P -> 9
cbd_congestion_fee     0.75 for open lines ordered from 1998 on, else NULL
airport_fee            1.75 on line 6, else NULL
=====================  ====================================================

Zones come from nation x region, the code dictionary from the distinct codes
of orders and lineitem, daily "weather" from per-day order counts, and the
hour-level demand from ``events``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.quality import FlagSet, Rule
from strata.sources.schemas import TRIP_COLUMNS

EVENT_SUSPICIOUS_VALUE = 100.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(c: Column, mapping: dict, otherwise=None) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    return expr if otherwise is None else expr.otherwise(F.lit(otherwise))


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical raw trips (20 trip columns + ``source_year_month``), before any rule.

    Join order: lineitem x supplier, then x (orders x customer). Every join is an
    equi-join on a key; the planner picks shuffle or broadcast per side from
    statistics and AQE revises it at run time. Without cost statistics a join's
    size is estimated as the product of its inputs, so a joined side never looks
    small: this order keeps lineitem, the largest input, on the streamed side.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
                                               "o_orderpriority")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    su = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    oc = od.join(cu, od.o_custkey == cu.c_custkey)
    base = li.join(su, li.l_suppkey == su.s_suppkey).join(oc, F.col("l_orderkey") == F.col("o_orderkey"))
    fare = F.col("l_extendedprice") / F.lit(100)
    slice_day = F.when(F.col("l_linenumber") == 7, F.add_months(F.col("o_orderdate"), 1)) \
        .otherwise(F.to_date("o_orderdate"))
    return base.select(
        _case(F.col("o_orderstatus"), {"F": 1, "O": 2}, 9).cast("int").alias("vendor_id"),
        F.col("o_orderdate").alias("pickup_datetime"),
        F.col("l_shipdate").alias("dropoff_datetime"),
        (F.col("l_linenumber") % 4).cast("int").alias("passenger_count"),
        (F.col("l_quantity") - F.lit(1)).alias("trip_distance"),
        _case(F.col("l_returnflag"), {"A": 1, "N": 2}).cast("int").alias("ratecode_id"),
        F.when(F.col("l_linestatus") == "O", F.lit("Y")).otherwise(F.lit("N")).alias("store_and_fwd_flag"),
        (F.col("c_nationkey") + 1).cast("int").alias("pu_location_id"),
        (F.col("s_nationkey") + 1).cast("int").alias("do_location_id"),
        F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).cast("int").alias("payment_type"),
        fare.alias("fare_amount"),
        F.col("l_tax").alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        (fare * F.col("l_discount")).alias("tip_amount"),
        F.lit(0.0).alias("tolls_amount"),
        F.lit(1.0).alias("improvement_surcharge"),
        (fare * (F.lit(1) + F.col("l_discount") + F.col("l_tax"))).alias("total_amount"),
        F.lit(2.5).alias("congestion_surcharge"),
        F.when(F.col("l_linenumber") == 6, F.lit(1.75)).alias("airport_fee"),
        F.when((F.col("l_linestatus") == "O") & (F.col("o_orderdate") >= F.lit("1998-01-01")),
               F.lit(0.75)).alias("cbd_congestion_fee"),
        F.date_format(slice_day, "yyyy-MM").alias("source_year_month"),
    )


RAW_TRIP_COLUMNS = [*TRIP_COLUMNS, "source_year_month"]


def zone_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone master from nation x region, with label dirt derived from the keys."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    k = F.col("n_nationkey")
    borough = (F.when(k == 24, F.lit("N/A"))
               .when(k % 2 == 0, F.concat(F.lit(" "), F.col("r_name"), F.lit(" ")))
               .otherwise(F.col("r_name")))
    zone = F.when(k == 0, F.lit("")).otherwise(F.col("n_name"))
    service = (F.when(k == 5, F.lit("EWR"))
               .when(k % 4 == 0, F.lit("Airports"))
               .when(k % 4 == 1, F.lit("Yellow Zone"))
               .when(k % 4 == 2, F.lit(" Boro Zone "))
               .otherwise(F.lit("Unknown")))
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        (k + 1).cast("int").alias("location_id"), borough.alias("borough"), zone.alias("zone"),
        service.alias("service_zone"))


def code_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code dictionary from the distinct codes in the data (code_type, code, description).

    Return flag R has no rate code, so its entry has a NULL code and fails the
    dictionary's required-column rule.
    """
    od = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem")
    vendor = od.select(
        F.lit("vendor").alias("code_type"),
        _case(F.col("o_orderstatus"), {"F": 1, "O": 2}, 9).cast("int").alias("code"),
        F.concat(F.lit("order status "), F.col("o_orderstatus")).alias("description")).distinct()
    rate = li.select(
        F.lit("ratecode").alias("code_type"),
        _case(F.col("l_returnflag"), {"A": 1, "N": 2}).cast("int").alias("code"),
        F.concat(F.lit(" return flag "), F.col("l_returnflag"), F.lit(" ")).alias("description")).distinct()
    pay = od.select(
        F.lit("payment_type").alias("code_type"),
        F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).cast("int").alias("code"),
        F.expr("substring(o_orderpriority, instr(o_orderpriority, '-') + 1)").alias("description")).distinct()
    return vendor.unionByName(rate).unionByName(pay)


def daily_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-day measures from orders, shaped like the daily weather table.

    One row per order day, so its size is bounded by the calendar, not the data.
    """
    od = table(spark, sf_dir, "orders")
    return (od.groupBy(F.to_date("o_orderdate").alias("weather_date"))
            .agg(F.round(F.max("o_totalprice") / F.lit(10000), 1).alias("temperature_max_c"),
                 F.round(F.min("o_totalprice") / F.lit(10000), 1).alias("temperature_min_c"),
                 F.count_if(F.col("o_orderpriority") == "1-URGENT").cast("double").alias("precipitation_mm"),
                 F.count_if((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P"))
                 .cast("double").alias("snowfall_cm"),
                 F.count("*").cast("double").alias("wind_speed_max_kmh")))


def calendar_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First day of the first order month and last day of the last one (one lazy row)."""
    od = table(spark, sf_dir, "orders")
    return od.agg(F.trunc(F.min("o_orderdate"), "MM").alias("start"),
                  F.last_day(F.max("o_orderdate")).alias("end"))


def events_as_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hour-level demand input from ``events``: value plays the amount, props.k the speed."""
    ev = table(spark, sf_dir, "events")
    flags = FlagSet(flags=(Rule("flag_extreme_fare", F.col("total_amount") > F.lit(EVENT_SUSPICIOUS_VALUE)),))
    return flags.apply(ev.select(
        F.dayofweek("ts").alias("pickup_day_of_week"),
        F.hour("ts").alias("pickup_hour"),
        F.get_json_object("props", "$.k").cast("double").alias("avg_speed_mph"),
        F.col("value").alias("total_amount")))
