"""Table contracts: measures, column types, keys and how each table is synced and released."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

LOCAL_ZONE = "Asia/Ho_Chi_Minh"

# Measure names, in the order the feeds deliver them.
DAILY_MEASURES = (
    "temperature_2m_mean",
    "temperature_2m_max",
    "temperature_2m_min",
    "apparent_temperature_mean",
    "wind_speed_10m_max",
    "wind_gusts_10m_max",
    "shortwave_radiation_sum",
    "precipitation_sum",
    "rain_sum",
    "weather_code",
)
HOURLY_MEASURES = (
    "temperature_2m",
    "apparent_temperature",
    "relative_humidity_2m",
    "dew_point_2m",
    "surface_pressure",
    "vapour_pressure_deficit",
    "wind_speed_10m",
    "wind_direction_10m",
    "wind_gusts_10m",
    "cloud_cover",
    "shortwave_radiation",
    "precipitation",
    "rain",
    "weather_code",
    "soil_moisture_0_to_7cm",
)
AQI_MEASURES = (
    "pm10",
    "pm2_5",
    "carbon_monoxide",
    "carbon_dioxide",
    "nitrogen_dioxide",
    "sulphur_dioxide",
    "ozone",
    "aerosol_optical_depth",
    "dust",
    "uv_index",
    "uv_index_clear_sky",
    "methane",
)
# Daily series that may arrive and are range-checked, but are never stored.
UNSTORED_DAILY_MEASURES = (
    "relative_humidity_2m_mean",
    "dew_point_2m_mean",
    "surface_pressure_mean",
    "vapour_pressure_deficit_mean",
    "cloud_cover_mean",
    "soil_moisture_0_to_7cm_mean",
)
INTEGER_MEASURES = ("weather_code",)

ANALYST = "analyst"
MONITORING = "monitoring"


def _fields(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in pairs])


def _measures(names: tuple[str, ...]) -> list[tuple[str, T.DataType]]:
    return [(n, T.ShortType() if n in INTEGER_MEASURES else T.FloatType()) for n in names]


@dataclass(frozen=True)
class TableSpec:
    """Everything the merge, sync and release operators need to know about one table.

    ``stored`` lists the columns in released order with their warehouse types.
    ``partitioned`` tables carry a physical ``month_key`` partition column that is a
    function of the primary key, so a partition-scoped merge equals a full merge.
    """

    name: str
    primary_key: tuple[str, ...]
    stored: T.StructType
    date_column: str | None = None
    date_via_hour: bool = False
    key_column: str | None = None
    district_column: str | None = None
    cutoff_column: str | None = None
    cutoff_via_hour: bool = False
    always_full: bool = False
    full_refresh: bool = False
    partitioned: bool = False

    def __post_init__(self) -> None:
        if self.cutoff_via_hour and self.key_column is None:
            raise ValueError("a cutoff taken from the hour dimension needs key_column")

    @property
    def columns(self) -> list[str]:
        return self.stored.fieldNames()

    @property
    def values(self) -> list[str]:
        return [c for c in self.columns if c not in self.primary_key]

    @property
    def released(self) -> T.StructType:
        """Types in published files: integers widen to long, reals to double."""
        return _fields(*[(f.name, released_type(f.dataType)) for f in self.stored])


def released_type(kind: T.DataType) -> T.DataType:
    if isinstance(kind, (T.ShortType, T.IntegerType, T.LongType)):
        return T.LongType()
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return T.DoubleType()
    if isinstance(kind, (T.BooleanType, T.StringType, T.DateType, T.TimestampType)):
        return kind
    raise TypeError(f"no released type for {kind.simpleString()}")


DIM_DISTRICT = TableSpec(
    name="dim_district",
    primary_key=("district_id",),
    stored=_fields(
        ("district_id", T.IntegerType()),
        ("district_name", T.StringType()),
        ("latitude", T.DoubleType()),
        ("longitude", T.DoubleType()),
    ),
    key_column="district_id",
    always_full=True,
    full_refresh=True,
)
DIM_DATE = TableSpec(
    name="dim_date",
    primary_key=("date_key",),
    stored=_fields(
        ("date_key", T.IntegerType()),
        ("date", T.DateType()),
        ("year", T.IntegerType()),
        ("quarter", T.IntegerType()),
        ("month", T.IntegerType()),
        ("day", T.IntegerType()),
        ("day_of_week", T.IntegerType()),
        ("is_weekend", T.BooleanType()),
    ),
    date_column="date",
    key_column="date_key",
    cutoff_column="date",
    full_refresh=True,
)
DIM_HOUR = TableSpec(
    name="dim_hour",
    primary_key=("hour_key",),
    stored=_fields(
        ("hour_key", T.IntegerType()),
        ("date_key", T.IntegerType()),
        ("observed_date", T.DateType()),
        ("observed_at", T.TimestampType()),
    ),
    date_column="observed_date",
    key_column="hour_key",
    cutoff_column="observed_at",
)
FACT_DAILY = TableSpec(
    name="fact_weather_daily",
    primary_key=("district_id", "date_key"),
    stored=_fields(
        ("district_id", T.IntegerType()),
        ("date_key", T.IntegerType()),
        ("observed_date", T.DateType()),
        *_measures(DAILY_MEASURES),
    ),
    date_column="observed_date",
    key_column="date_key",
    district_column="district_id",
    cutoff_column="observed_date",
    partitioned=True,
)
FACT_HOURLY = TableSpec(
    name="fact_weather_hourly",
    primary_key=("district_id", "hour_key"),
    stored=_fields(
        ("district_id", T.IntegerType()),
        *_measures(HOURLY_MEASURES),
        ("hour_key", T.IntegerType()),
    ),
    date_via_hour=True,
    key_column="hour_key",
    district_column="district_id",
    cutoff_column="observed_at",
    cutoff_via_hour=True,
    partitioned=True,
)
FACT_AQI = TableSpec(
    name="fact_aqi_hourly",
    primary_key=("district_id", "hour_key"),
    stored=_fields(
        ("district_id", T.IntegerType()),
        *_measures(AQI_MEASURES),
        ("hour_key", T.IntegerType()),
    ),
    date_via_hour=True,
    key_column="hour_key",
    district_column="district_id",
    cutoff_column="observed_at",
    cutoff_via_hour=True,
    partitioned=True,
)

# Parents before children, so that every foreign key resolves while tables are copied.
TABLE_SPECS = (DIM_DISTRICT, DIM_DATE, DIM_HOUR, FACT_DAILY, FACT_HOURLY, FACT_AQI)
SPECS = {spec.name: spec for spec in TABLE_SPECS}
FACT_SPECS = (FACT_DAILY, FACT_HOURLY, FACT_AQI)

# (child table, child column, parent table, parent column)
FOREIGN_KEYS = (
    ("dim_hour", "date_key", "dim_date", "date_key"),
    ("fact_weather_daily", "district_id", "dim_district", "district_id"),
    ("fact_weather_daily", "date_key", "dim_date", "date_key"),
    ("fact_weather_hourly", "district_id", "dim_district", "district_id"),
    ("fact_weather_hourly", "hour_key", "dim_hour", "hour_key"),
    ("fact_aqi_hourly", "district_id", "dim_district", "district_id"),
    ("fact_aqi_hourly", "hour_key", "dim_hour", "hour_key"),
)

_CONTEXT = T.MapType(T.StringType(), T.StringType())
ETL_RUNS = _fields(
    ("etl_run_id", T.LongType()),
    ("run_type", T.StringType()),
    ("status", T.StringType()),
    ("started_at", T.TimestampType()),
    ("finished_at", T.TimestampType()),
    ("rows_inserted", T.LongType()),
    ("rows_updated", T.LongType()),
    ("rows_skipped", T.LongType()),
    ("error_summary", T.StringType()),
)
ETL_LOGS = _fields(
    ("etl_run_id", T.LongType()),
    ("level", T.StringType()),
    ("event_name", T.StringType()),
    ("message", T.StringType()),
    ("context", _CONTEXT),
    ("created_at", T.TimestampType()),
)
VALIDATION_ERRORS = _fields(
    ("etl_run_id", T.LongType()),
    ("source_table", T.StringType()),
    ("district_id", T.IntegerType()),
    ("field_name", T.StringType()),
    ("invalid_value", T.StringType()),
    ("reason", T.StringType()),
    ("severity", T.StringType()),
    ("created_at", T.TimestampType()),
)
MONITORING_TABLES = {
    "etl_runs": ETL_RUNS,
    "etl_logs": ETL_LOGS,
    "validation_errors": VALIDATION_ERRORS,
}
