"""Hard-rule sets of the four bronze entities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata import presets as P
from strata.functions.exprs import in_month
from strata.operators.quality import Rule, RuleSet
from strata.presets import Preset

TRIP_REQUIRED = ("pickup_datetime", "dropoff_datetime", "pu_location_id", "do_location_id")


MEASURES = ("trip_distance", "fare_amount", "total_amount")


def trip_rules(preset: Preset = P.TRIP_PRESET, slice_value: str | Column | tuple[Column, Column] | None = None,
               not_nan: bool = False) -> RuleSet:
    """B2. ``slice_value`` is the file's month as a literal (pushes down as a range), a
    column, or its first moment and the next month's as two columns; by default the
    ``source_year_month`` column.

    NaN sorts above every number in Spark, so it passes ``>= 0`` (S-2); ``not_nan``
    adds explicit NaN rules for the three measures (off by default, as in the
    original rule set).
    """
    ym = F.col("source_year_month") if slice_value is None else slice_value
    t = F.col("pickup_datetime")
    in_slice = (t >= ym[0]) & (t < ym[1]) if isinstance(ym, tuple) else in_month(t, ym)
    lo, hi = preset.zone_min_id, preset.zone_max_id
    nan_rules = tuple(Rule(f"{c}_not_nan", ~F.isnan(F.col(c))) for c in MEASURES) if not_nan else ()
    return RuleSet(required=TRIP_REQUIRED, rules=nan_rules + (
        Rule("dropoff_after_pickup", F.col("dropoff_datetime") > F.col("pickup_datetime")),
        Rule("pickup_in_slice", in_slice),
        Rule("distance_non_negative", F.col("trip_distance") >= 0),
        Rule("fare_non_negative", F.col("fare_amount") >= 0),
        Rule("total_non_negative", F.col("total_amount") >= 0),
        Rule("pu_zone_in_domain", F.col("pu_location_id").between(lo, hi)),
        Rule("do_zone_in_domain", F.col("do_location_id").between(lo, hi)),
    ))


def code_rules() -> RuleSet:
    """All three columns required and a known code type."""
    return RuleSet(required=("code_type", "code", "description"),
                   rules=(Rule("known_code_type", F.col("code_type").isin(*P.CODE_TYPES)),))


def zone_rules(preset: Preset = P.TRIP_PRESET) -> RuleSet:
    """Id required and inside the zone domain."""
    return RuleSet(required=("location_id",),
                   rules=(Rule("zone_in_domain", F.col("location_id").between(preset.zone_min_id,
                                                                               preset.zone_max_id)),))


def weather_rules() -> RuleSet:
    """The date is required."""
    return RuleSet(required=("weather_date",))
