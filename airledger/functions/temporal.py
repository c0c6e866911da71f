"""Date, hour and time-zone expressions.

Every function here gives the same answer under any ``spark.sql.session.timeZone``: zones
are named explicitly instead of being taken from the session.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

from airledger.schemas import LOCAL_ZONE

_DATE_SHAPE = r"^\d{4}-\d{2}-\d{2}$"
_COMPACT_DATE_SHAPE = r"^\d{8}$"
_WEEK_DATE_SHAPE = r"^(\d{4})(-?)W(\d{2})(?:\2([1-7]))?$"
_INSTANT_SHAPE = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?)?$"
)
_HAS_OFFSET = r"[T ].*(Z|[+-]\d{2}:?\d{2})$"


def date_key(day: Column) -> Column:
    """yyyymmdd as an integer; plain arithmetic stays inside generated code."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def month_key(day: Column) -> Column:
    return F.year(day) * 100 + F.month(day)


def month_of_date_key(key: Column) -> Column:
    return F.floor(key / 100).cast("int")


def calendar_attributes(day: Column) -> list[Column]:
    iso_weekday = F.weekday(day) + 1
    return [
        date_key(day).alias("date_key"),
        day.alias("date"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        iso_weekday.alias("day_of_week"),
        (iso_weekday >= 6).alias("is_weekend"),
    ]


def local_wall_clock(instant: Column, zone: str = LOCAL_ZONE) -> Column:
    """Wall-clock reading (timestamp_ntz) of an instant in ``zone``."""
    return F.convert_timezone(None, F.lit(zone), instant)


def local_date(instant: Column, zone: str = LOCAL_ZONE) -> Column:
    return local_wall_clock(instant, zone).cast("date")


def instant_of_wall_clock(wall: Column, zone: str = LOCAL_ZONE) -> Column:
    """Instant (timestamp) at which clocks in ``zone`` show the timestamp_ntz ``wall``."""
    return F.convert_timezone(F.lit(zone), F.current_timezone(), wall).cast("timestamp")


def start_of_hour(wall: Column) -> Column:
    """Truncate a timestamp_ntz to its hour without going through the session zone."""
    return wall.cast("date").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.hour(wall)
    )


def try_iso_date(text: Column) -> Column:
    """ISO calendar date (with or without dashes) or week date; null for any other text."""
    compact = F.when(
        text.rlike(_COMPACT_DATE_SHAPE),
        F.concat_ws("-", text.substr(1, 4), text.substr(5, 2), text.substr(7, 2)).try_cast("date"),
    )
    usual = F.when(text.rlike(_DATE_SHAPE), text.try_cast("date"))
    return F.coalesce(usual, compact, _week_date(text))


def _week_date(text: Column) -> Column:
    """Week 1 is the week of 4 January; a year's last week is that of 28 December."""
    part = [F.regexp_extract(text, _WEEK_DATE_SHAPE, i).try_cast("int") for i in (1, 3, 4)]
    year, week = part[0], part[1]
    weekday = F.coalesce(part[2], F.lit(1))
    monday = F.date_sub(F.make_date(year, F.lit(1), F.lit(4)), F.weekday(F.make_date(year, F.lit(1), F.lit(4))))
    last = F.weekofyear(F.make_date(year, F.lit(12), F.lit(28)))
    return F.when(
        text.rlike(_WEEK_DATE_SHAPE) & week.between(1, last) & (year > 0),
        F.date_add(monday, (week - 1) * 7 + weekday - 1),
    )


def try_iso_instant(text: Column, zone: str = LOCAL_ZONE) -> Column:
    """ISO date-time to instant, null for any other text; without an offset it is wall-clock
    time in ``zone``.

    Seconds are optional. Feeds send ``yyyy-MM-ddTHH:mm`` almost always, so that shape is
    tried first and needs no pattern matching.
    """
    usual = (F.length(text) == 16) & (F.substring(text, 11, 1) == "T")
    quick = F.concat(text, F.lit(":00"), F.lit(zone))
    full = F.regexp_replace(text, r"^(.{10})$", "$1T00:00")
    full = F.regexp_replace(full, r"^(.{10})[T ](\d{2}:\d{2})(Z|[+-].*)?$", "$1T$2:00$3")
    full = F.regexp_replace(full, r"([+-]\d{2})(\d{2})$", "$1:$2")
    zoned = F.when(text.rlike(_HAS_OFFSET), full).otherwise(F.concat(full, F.lit(zone)))
    return F.when(usual, quick.try_cast("timestamp")).when(
        text.rlike(_INSTANT_SHAPE), zoned.try_cast("timestamp")
    )


def display_local(instant: Column, zone: str = LOCAL_ZONE) -> Column:
    """dd/MM/yyyy HH:mm:ss (UTC+7), or ``-`` when there is no instant."""
    shown = F.date_format(local_wall_clock(instant, zone), "dd/MM/yyyy HH:mm:ss")
    return F.coalesce(F.concat(shown, F.lit(" (UTC+7)")), F.lit("-"))


def duration_seconds(started: Column, finished: Column) -> Column:
    """Whole seconds between two instants, truncated, never negative."""
    micros = F.unix_micros(finished) - F.unix_micros(started)
    return F.greatest(F.lit(0).cast("long"), F.floor(micros / 1_000_000).cast("long"))


def catchup_date(started: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.date_sub(local_date(started, zone), 1)


def local_yesterday(now: datetime | None = None, zone: str = LOCAL_ZONE) -> date:
    """Default publishing target: the local calendar day before ``now``."""
    moment = datetime.now(timezone.utc) if now is None else now
    return moment.astimezone(ZoneInfo(zone)).date() - timedelta(days=1)
