"""Domain presets: labels, thresholds, id ranges and cut-over slice.

The trip preset holds values that must equal the reference pipeline for the
same results. The driver preset maps the same operators onto the TPC-H-like
test tables (see ``strata.plans.mapping``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's, in its own order)
# ---------------------------------------------------------------------------
UNKNOWN_LABEL = "Desconocido"
LABEL_NULL_TOKENS = ("N/A", "NA", "Unknown", "")
DAY_NAMES = {1: "domingo", 2: "lunes", 3: "martes", 4: "miércoles", 5: "jueves", 6: "viernes", 7: "sábado"}
MONTH_NAMES = {1: "enero", 2: "febrero", 3: "marzo", 4: "abril", 5: "mayo", 6: "junio", 7: "julio",
               8: "agosto", 9: "septiembre", 10: "octubre", 11: "noviembre", 12: "diciembre"}
AIRPORT_SERVICE_ZONES = ("Airports", "EWR")
YELLOW_SERVICE_ZONE = "Yellow Zone"
CODE_TYPES = ("vendor", "ratecode", "payment_type")
AIRPORT_RATECODES = (2, 3)
CARD_PAYMENT = 1
KM_PER_MILE = 1.60934
WEATHER_SNOW, WEATHER_HEAVY_RAIN, WEATHER_RAIN, WEATHER_DRY, WEATHER_NO_DATA = (
    "nieve", "lluvia fuerte", "lluvia", "seco", "sin dato")
PERIOD_WITH, PERIOD_WITHOUT = "con cobro", "sin cobro"
DEFAULT_MONTHS = "2024-12,2025-01,2025-02"
# Code dictionary shipped with the reference, as (code_type, code, description).
REFERENCE_CODES = [
    ("vendor", 1, "Creative Mobile Technologies"),
    ("vendor", 2, "Curb Mobility"),
    ("vendor", 6, "Myle Technologies"),
    ("vendor", 7, "Helix"),
    ("ratecode", 1, "Tarifa estándar"),
    ("ratecode", 2, "JFK"),
    ("ratecode", 3, "Newark"),
    ("ratecode", 4, "Nassau o Westchester"),
    ("ratecode", 5, "Tarifa negociada"),
    ("ratecode", 6, "Viaje grupal"),
    ("ratecode", 99, "Desconocido"),
    ("payment_type", 0, "Tarifa flexible"),
    ("payment_type", 1, "Tarjeta de crédito"),
    ("payment_type", 2, "Efectivo"),
    ("payment_type", 3, "Sin cargo"),
    ("payment_type", 4, "Disputa"),
    ("payment_type", 5, "Desconocido"),
    ("payment_type", 6, "Viaje anulado"),
]
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class WeatherLadder:
    """Thresholds of the weather class ladder (B13); first match wins."""
    snow_above: float = 0.0
    heavy_rain_from: float = 5.0
    rain_from: float = 0.5


@dataclass(frozen=True)
class FlagThresholds:
    """Soft-rule thresholds."""
    long_duration_min: float = 180.0
    high_speed_mph: float = 80.0
    extreme_fare: float = 500.0


@dataclass(frozen=True)
class Preset:
    name: str
    zone_min_id: int = 1
    zone_max_id: int = 265
    unknown_zone_ids: tuple[int, ...] = (264, 265)
    flags: FlagThresholds = field(default_factory=FlagThresholds)
    weather: WeatherLadder = field(default_factory=WeatherLadder)
    focus_borough: str = "Manhattan"
    cutover_slice: str = "2025-01"
    top_k: int = 20
    unknown_label: str = UNKNOWN_LABEL


TRIP_PRESET = Preset(name="trips")

# Same operators on the driver's TPC-H-like tables: 25 nations play the zones,
# regions play the boroughs; thresholds are sized to that data (strata.plans.mapping).
DRIVER_PRESET = Preset(
    name="driver",
    unknown_zone_ids=(24, 25),
    flags=FlagThresholds(long_duration_min=2_000_000.0, high_speed_mph=0.02, extreme_fare=900.0),
    weather=WeatherLadder(snow_above=1.0, heavy_rain_from=3.0, rain_from=1.0),
    focus_borough="AMERICA",
    cutover_slice="1998-01",
)
