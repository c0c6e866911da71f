"""Inclusive range rules per feed, as data."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RangeRule:
    """Bounds are kept as text because the reason message quotes them as written."""

    field: str
    low: str
    high: str

    def violated(self) -> Column:
        """False for null; NaN and values outside the bounds violate."""
        inside = f"{self.field} between {self.low}D and {self.high}D"
        return F.expr(f"{self.field} is not null and not ({inside})")

    def reason(self) -> str:
        return f"{self.field} must be between {self.low} and {self.high}"


def _rules(*rows: tuple[str, str, str]) -> tuple[RangeRule, ...]:
    return tuple(RangeRule(*row) for row in rows)


# Permitted ranges, bounds as they appear in the reason text.
COORDINATE_RULES = _rules(
    ("latitude", "20.5", "21.5"),
    ("longitude", "105.2", "106.1"),
)
DAILY_RULES = COORDINATE_RULES + _rules(
    ("temperature_2m_mean", "-5.0", "45.0"),
    ("temperature_2m_max", "-5.0", "45.0"),
    ("temperature_2m_min", "-5.0", "45.0"),
    ("apparent_temperature_mean", "-10.0", "55.0"),
    ("relative_humidity_2m_mean", "0", "100"),
    ("dew_point_2m_mean", "-10.0", "35.0"),
    ("surface_pressure_mean", "950", "1050"),
    ("vapour_pressure_deficit_mean", "0", "8"),
    ("wind_speed_10m_max", "0", "100"),
    ("wind_gusts_10m_max", "0", "150"),
    ("cloud_cover_mean", "0", "100"),
    ("shortwave_radiation_sum", "0", "40"),
    ("precipitation_sum", "0", "800"),
    ("rain_sum", "0", "800"),
    ("soil_moisture_0_to_7cm_mean", "0", "1"),
)
HOURLY_RULES = COORDINATE_RULES + _rules(
    ("temperature_2m", "-5.0", "45.0"),
    ("apparent_temperature", "-10.0", "55.0"),
    ("relative_humidity_2m", "0", "100"),
    ("dew_point_2m", "-10.0", "35.0"),
    ("surface_pressure", "950", "1050"),
    ("vapour_pressure_deficit", "0", "8"),
    ("wind_speed_10m", "0", "100"),
    ("wind_direction_10m", "0", "360"),
    ("wind_gusts_10m", "0", "150"),
    ("cloud_cover", "0", "100"),
    ("shortwave_radiation", "0", "1400"),
    ("precipitation", "0", "300"),
    ("rain", "0", "300"),
    ("soil_moisture_0_to_7cm", "0", "1"),
)
AQI_RULES = COORDINATE_RULES + _rules(
    ("pm10", "0", "1000"),
    ("pm2_5", "0", "500"),
    ("carbon_monoxide", "0", "100000"),
    ("nitrogen_dioxide", "0", "1000"),
    ("sulphur_dioxide", "0", "1000"),
    ("ozone", "0", "500"),
    ("uv_index", "0", "20"),
    ("uv_index_clear_sky", "0", "20"),
    ("dust", "0", "10000"),
)


def applicable(rules: tuple[RangeRule, ...], columns: list[str]) -> list[RangeRule]:
    present = set(columns)
    return [rule for rule in rules if rule.field in present]


def any_violation(rules: list[RangeRule]) -> Column:
    return reduce(lambda a, b: a | b, [r.violated() for r in rules], F.lit(False))


def violation_count(rules: list[RangeRule]) -> Column:
    return reduce(lambda a, b: a + b, [r.violated().cast("int") for r in rules], F.lit(0))


def violation_structs(rules: list[RangeRule]) -> Column:
    """One struct per violated rule, in rule order."""
    return F.array_compact(
        F.array(
            *[
                F.when(
                    r.violated(),
                    F.struct(
                        F.lit(r.field).alias("field_name"),
                        F.col(r.field).cast("string").alias("invalid_value"),
                        F.lit(r.reason()).alias("reason"),
                        F.lit("error").alias("severity"),
                    ),
                )
                for r in rules
            ]
        )
    )
