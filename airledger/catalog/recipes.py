"""How measures are derived from one amount column, for tables that hold no weather.

Each measure is ``((cents * factor) % modulus + shift) / 100``. The moduli reach beyond the
permitted ranges, so that some rows are rejected. Integer arithmetic up to the last division
keeps the values identical in every engine. The expressions are plain SQL.
"""

from __future__ import annotations

from dataclasses import dataclass

from airledger.schemas import AQI_MEASURES, DAILY_MEASURES, HOURLY_MEASURES, INTEGER_MEASURES


@dataclass(frozen=True)
class Recipe:
    measure: str
    factor: int
    modulus: int
    shift: int
    null_every: int | None = None

    def sql(self, cents: str) -> str:
        whole = f"(({cents} * {self.factor}) % {self.modulus} + {self.shift})"
        if self.measure in INTEGER_MEASURES:
            value = f"CAST({whole} AS INTEGER)"
        else:
            value = f"CAST({whole} AS DOUBLE) / CAST(100 AS DOUBLE)"
        if self.null_every:
            value = f"CASE WHEN {cents} % {self.null_every} <> 0 THEN {value} END"
        return f"{value} AS {self.measure}"


_SPANS = {
    "temperature_2m_mean": (1, 5600, -700, None),
    "temperature_2m_max": (3, 5600, -600, None),
    "temperature_2m_min": (7, 5600, -800, 17),
    "apparent_temperature_mean": (1, 7000, -1100, None),
    "wind_speed_10m_max": (11, 10200, 0, 13),
    "wind_gusts_10m_max": (13, 15100, 0, None),
    "shortwave_radiation_sum": (17, 4100, 0, 19),
    "precipitation_sum": (19, 80300, 0, None),
    "rain_sum": (23, 80200, 0, None),
    "weather_code": (1, 100, 0, 29),
    "temperature_2m": (1, 5200, -600, None),
    "apparent_temperature": (3, 6700, -1100, 17),
    "relative_humidity_2m": (7, 10100, 0, None),
    "dew_point_2m": (11, 4600, -1050, None),
    "surface_pressure": (13, 10200, 94950, 23),
    "vapour_pressure_deficit": (17, 810, 0, None),
    "wind_speed_10m": (19, 10100, 0, None),
    "wind_direction_10m": (23, 36300, 0, 13),
    "wind_gusts_10m": (29, 15100, 0, None),
    "cloud_cover": (31, 10050, 0, None),
    "shortwave_radiation": (37, 140500, 0, None),
    "precipitation": (41, 30100, 0, 19),
    "rain": (43, 30100, 0, None),
    "soil_moisture_0_to_7cm": (47, 101, 0, None),
    "pm10": (1, 100300, 0, None),
    "pm2_5": (3, 50200, 0, 13),
    "carbon_monoxide": (1009, 10000500, 0, None),
    "carbon_dioxide": (7, 90000, 0, None),
    "nitrogen_dioxide": (11, 100200, 0, None),
    "sulphur_dioxide": (13, 100200, 0, 17),
    "ozone": (17, 50300, 0, None),
    "aerosol_optical_depth": (19, 300, 0, None),
    "dust": (211, 1000900, 0, None),
    "uv_index": (23, 2020, 0, None),
    "uv_index_clear_sky": (29, 2020, 0, 19),
    "methane": (31, 220000, 0, None),
}


def recipes(measures: tuple[str, ...]) -> list[Recipe]:
    return [Recipe(m, *_SPANS[m]) for m in measures]


DAILY_RECIPES = recipes(DAILY_MEASURES)
HOURLY_RECIPES = recipes(HOURLY_MEASURES)
AQI_RECIPES = recipes(AQI_MEASURES)
