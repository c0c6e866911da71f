"""The same results as plain SQL over the generic tables, for checking."""

from __future__ import annotations

from airledger.catalog.recipes import AQI_RECIPES, DAILY_RECIPES, HOURLY_RECIPES, Recipe
from airledger.functions import rules as R
from airledger.schemas import TABLE_SPECS

ORACLES: dict[str, str] = {}


def _cents(column: str) -> str:
    return f"CAST(ROUND({column} * 100) AS BIGINT)"


def _measures(recipes: list[Recipe]) -> str:
    return ", ".join(r.sql("cents") for r in recipes)


def _names(recipes: list[Recipe]) -> list[str]:
    return [r.measure for r in recipes]


DAILY = _names(DAILY_RECIPES)
HOURLY = _names(HOURLY_RECIPES)
AQI = _names(AQI_RECIPES)

_HOUR_SOURCE = """{name}_base AS (
  SELECT CAST(user_id AS INTEGER) AS district_id, date_trunc('hour', ts) AS observed_at,
         CAST(sum({cents}) AS BIGINT) AS cents
  FROM events WHERE {where} GROUP BY 1, 2),
{name} AS (SELECT district_id, observed_at, {measures} FROM {name}_base)"""


def _hour_source(name: str, recipes: list[Recipe], where: str = "TRUE") -> str:
    return _HOUR_SOURCE.format(
        name=name, cents=_cents("value"), where=where, measures=_measures(recipes)
    )



def _daily_source(name: str = "daily", where: str = "TRUE") -> str:
    return f"""{name}_base AS (
  SELECT CAST(o_custkey AS INTEGER) AS district_id,
         CAST(o_orderdate AS DATE) AS observed_date,
         CAST(sum({_cents("o_totalprice")}) AS BIGINT) AS cents
  FROM orders WHERE {where} GROUP BY 1, 2),
{name} AS (
  SELECT district_id, CAST(strftime(observed_date, '%Y%m%d') AS INTEGER) AS date_key,
         observed_date, {_measures(DAILY_RECIPES)}
  FROM {name}_base)"""


HOURS = """hours AS (
  SELECT CAST(row_number() OVER (ORDER BY observed_at) AS INTEGER) AS hour_key,
         CAST(strftime(observed_at, '%Y%m%d') AS INTEGER) AS date_key,
         CAST(observed_at AS DATE) AS observed_date, observed_at
  FROM (SELECT DISTINCT date_trunc('hour', ts) AS observed_at FROM events))"""

DISTRICTS = """districts AS (
  SELECT CAST(c_custkey AS INTEGER) AS district_id, c_name AS district_name,
         CAST(20.5 AS DOUBLE) + CAST(c_nationkey AS DOUBLE) * 5 / CAST(100 AS DOUBLE) AS latitude,
         CAST(105.2 AS DOUBLE) + CAST(c_nationkey AS DOUBLE) * 3 / CAST(100 AS DOUBLE) AS longitude
  FROM customer)"""


def _calendar(first: str, last: str, table: str) -> str:
    return f"""
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS "date",
         CAST(year(d) AS INTEGER) AS "year", CAST(quarter(d) AS INTEGER) AS "quarter",
         CAST(month(d) AS INTEGER) AS "month", CAST(day(d) AS INTEGER) AS "day",
         CAST(isodow(d) AS INTEGER) AS day_of_week, isodow(d) IN (6, 7) AS is_weekend
  FROM (SELECT unnest(generate_series({first}, {last}, INTERVAL 1 DAY)) AS d FROM {table})"""


def _days_of(column: str, table: str) -> str:
    return f"(SELECT min(CAST({column} AS DATE)) AS lo, max(CAST({column} AS DATE)) AS hi FROM {table})"


DATES = "dates AS (" + _calendar("lo", "hi", _days_of("ts", "events")) + ")"


def _with(*parts: str, then: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + then


def _cols(names: list[str], prefix: str = "") -> str:
    return ", ".join(prefix + n for n in names)


# -- reads ---------------------------------------------------------------------------------

ORACLES["daily_range"] = _with(
    _daily_source(),
    then="""SELECT * FROM daily
WHERE observed_date BETWEEN DATE '1996-03-01' AND DATE '1999-06-30'""",
)
ORACLES["daily_range_district"] = _with(
    _daily_source(),
    then="SELECT * FROM daily WHERE district_id = 7 AND observed_date >= DATE '1997-01-01'",
)


def _statistics(district: str, start: str, end: str, where: str) -> str:
    return _with(
        _daily_source(),
        then=f"""SELECT CAST({district} AS INTEGER) AS district_id,
  CAST({start} AS DATE) AS start_date, CAST({end} AS DATE) AS end_date,
  round(avg(temperature_2m_mean), 6) AS avg_temperature_2m_mean,
  max(temperature_2m_max) AS max_temperature_2m_max,
  min(temperature_2m_min) AS min_temperature_2m_min,
  round(sum(precipitation_sum), 6) AS total_precipitation_sum
FROM daily WHERE {where}""",
    )


ORACLES["daily_statistics"] = _statistics("NULL", "NULL", "NULL", "TRUE")
ORACLES["daily_statistics_filtered"] = _statistics(
    "3", "'1996-01-01'", "'1998-12-31'",
    "district_id = 3 AND observed_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'",
)
ORACLES["daily_statistics_no_match"] = _statistics("-1", "NULL", "NULL", "district_id = -1")


def _page(source: str, names: list[str], where: str, limit: int, offset: int) -> str:
    return _with(
        source,
        HOURS,
        then=f"""SELECT f.district_id, {_cols(names, "f.")}, h.hour_key, h.observed_date,
  h.observed_at
FROM fact f JOIN hours h USING (observed_at) WHERE {where}
ORDER BY h.observed_at, f.district_id LIMIT {limit} OFFSET {offset}""",
    )


_HOURLY = _hour_source("fact", HOURLY_RECIPES)
_AQI = _hour_source("fact", AQI_RECIPES)

ORACLES["hourly_page"] = _page(
    _HOURLY, HOURLY, "h.observed_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'", 200, 50
)
ORACLES["hourly_page_district"] = _page(_HOURLY, HOURLY, "f.district_id = 4", 100, 0)
ORACLES["aqi_page"] = _page(_AQI, AQI, "h.observed_date >= DATE '2024-01-08'", 1000, 10)
ORACLES["hourly_deep_page"] = _page(_HOURLY, HOURLY, "TRUE", 300, 9000)
ORACLES["export_window"] = _with(
    _HOURLY,
    HOURS,
    then=f"""SELECT f.district_id, {_cols(HOURLY, "f.")}, h.hour_key
FROM fact f JOIN hours h USING (observed_at)
WHERE h.observed_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'""",
)
ORACLES["export_window_daily"] = _with(
    _daily_source(),
    then="""SELECT * FROM daily
WHERE observed_date BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'""",
)
ORACLES["star_view"] = _with(
    _HOURLY,
    HOURS,
    DATES,
    DISTRICTS,
    then=f"""SELECT f.district_id, h.date_key, h.hour_key, {_cols(HOURLY, "f.")},
  h.observed_date, h.observed_at, d."year", d."quarter", d."month", d."day", d.day_of_week,
  d.is_weekend, p.district_name, p.latitude, p.longitude
FROM fact f JOIN hours h USING (observed_at) JOIN dates d ON d.date_key = h.date_key
JOIN districts p ON p.district_id = f.district_id""",
)
ORACLES["denormalised_hours"] = _with(
    _AQI,
    HOURS,
    then=f"""SELECT f.district_id, {_cols(AQI, "f.")}, h.hour_key, h.date_key,
  h.observed_date, h.observed_at FROM fact f JOIN hours h USING (observed_at)""",
)

# -- districts -----------------------------------------------------------------------------

ORACLES["district_lookup"] = _with(
    DISTRICTS, then="SELECT * FROM districts WHERE district_id = 7"
)
ORACLES["district_lookup_by_name"] = _with(
    DISTRICTS, then="SELECT * FROM districts WHERE district_name = 'Customer#000000003'"
)
ORACLES["district_subset"] = _with(
    DISTRICTS,
    then="""SELECT * FROM districts WHERE district_id IN (SELECT s_suppkey FROM supplier)
ORDER BY district_id LIMIT 10""",
)
ORACLES["district_unknown"] = """SELECT DISTINCT CAST(o_custkey * 2 AS INTEGER) AS district_id
FROM orders WHERE o_custkey * 2 NOT IN (SELECT c_custkey FROM customer)"""
ORACLES["skip_loaded"] = _with(
    DISTRICTS,
    then="""SELECT * FROM districts WHERE district_id NOT IN
  (SELECT user_id FROM events)""",
)

# -- calendar and hours --------------------------------------------------------------------

ORACLES["dim_date_build"] = _calendar("lo", "hi", _days_of("o_orderdate", "orders"))
ORACLES["hour_dim_build"] = _with(
    HOURS, then="SELECT date_key, observed_date, observed_at FROM hours"
)
ORACLES["hour_key_assign"] = _with(
    HOURS,
    then="""SELECT CAST(row_number() OVER (
    ORDER BY observed_at < TIMESTAMP '2024-01-11', observed_at) AS INTEGER) AS hour_key,
  date_key, observed_date, observed_at FROM hours""",
)
ORACLES["hour_key_lookup"] = _with(
    _HOURLY,
    HOURS,
    then="SELECT f.district_id, h.hour_key FROM fact f JOIN hours h USING (observed_at)",
)

# -- payloads ------------------------------------------------------------------------------

ORACLES["payload_daily"] = _with(_daily_source(), then="SELECT * FROM daily")
_KEYED = "CAST(strftime(observed_at, '%Y%m%d') AS INTEGER) AS date_key"
ORACLES["payload_hourly"] = _with(_HOURLY, then=f"SELECT *, {_KEYED} FROM fact")
ORACLES["payload_batch"] = ORACLES["payload_hourly"]
ORACLES["payload_aqi"] = _with(_AQI, then=f"SELECT *, {_KEYED} FROM fact")
_RAGGED = [c for c in HOURLY if c not in ("temperature_2m", "cloud_cover")]
ORACLES["payload_ragged"] = _with(
    _HOURLY,
    then=f"""SELECT district_id, observed_at, {_KEYED}, {_cols(_RAGGED)},
  CASE WHEN row_number() OVER (PARTITION BY district_id, CAST(observed_at AS DATE)
                               ORDER BY observed_at DESC) > 1
       THEN temperature_2m END AS temperature_2m,
  CAST(NULL AS DOUBLE) AS cloud_cover FROM fact""",
)
ORACLES["payload_problems"] = _with(
    _daily_source(),
    then="""SELECT 'archive-daily/' || d.district_id || '/' || d.first_day AS doc_id,
  'archive-daily' AS feed, CAST(d.district_id + extra AS INTEGER) AS district_id,
  CASE WHEN d.district_id % 5 = 1 THEN 'document is not valid JSON'
       ELSE 'document holds 1 payloads for 2 districts' END AS problem
FROM (SELECT DISTINCT district_id,
        strftime(date_trunc('month', observed_date), '%Y-%m-%d') AS first_day FROM daily) d
JOIN (VALUES (0), (100)) AS x(extra)
  ON d.district_id % 5 = 2 OR (d.district_id % 5 = 1 AND extra = 0)""",
)
ORACLES["missing_payload"] = """SELECT CAST(c_custkey AS INTEGER) AS district_id FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey % 5 NOT IN (1, 2))"""

# -- validation ----------------------------------------------------------------------------


def _violated(rule: R.RangeRule, prefix: str = "") -> str:
    c = prefix + rule.field
    return f"({c} IS NOT NULL AND NOT ({c} >= {rule.low} AND {c} <= {rule.high}))"


def _placed(names: list[str]) -> str:
    return "placed AS (SELECT f.*, p.latitude, p.longitude FROM fact f JOIN districts p USING (district_id))"


def _used(rules: tuple[R.RangeRule, ...], names: list[str]) -> list[R.RangeRule]:
    return [r for r in rules if r.field in (*names, "latitude", "longitude")]


def _daily_as_fact() -> str:
    return _daily_source("fact")


def _errors(source: str, names: list[str], rules, table: str, key: str) -> str:
    parts = [
        f"""SELECT '{table}' AS source_table, district_id, {key}, '{r.field}' AS field_name,
  CAST({r.field} AS VARCHAR) AS invalid_value, '{r.reason()}' AS reason, 'error' AS severity
FROM placed WHERE {_violated(r)}"""
        for r in _used(rules, names)
    ]
    return _with(source, DISTRICTS, _placed(names), then="\nUNION ALL\n".join(parts))


ORACLES["validate_range"] = """SELECT event_id,
  CASE WHEN event_id % 11 = 0 THEN FALSE WHEN event_id % 13 = 0 THEN TRUE
       ELSE NOT (value >= 5 AND value <= 120.5) END AS violated FROM events"""
ORACLES["validate_daily"] = _errors(
    _daily_as_fact(), DAILY, R.DAILY_RULES, "analyst.fact_weather_daily", "date_key"
)
ORACLES["validate_hourly"] = _errors(
    _HOURLY, HOURLY, R.HOURLY_RULES, "analyst.fact_weather_hourly", "observed_at"
)
ORACLES["validate_aqi"] = _errors(
    _AQI, AQI, R.AQI_RULES, "analyst.fact_aqi_hourly", "observed_at"
)


def _any(rules) -> str:
    return "(" + " OR ".join(_violated(r) for r in rules) + ")"


ORACLES["validate_valid"] = _with(
    _HOURLY, DISTRICTS, _placed(HOURLY),
    then=f"SELECT * FROM placed WHERE NOT {_any(_used(R.HOURLY_RULES, HOURLY))}",
)
ORACLES["validate_rejected"] = _with(
    _daily_as_fact(), DISTRICTS, _placed(DAILY),
    then=f"""SELECT district_id, date_key FROM placed
WHERE {_any(_used(R.DAILY_RULES, DAILY))}""",
)


def _counts(kind: str, source: str, names: list[str], rules) -> str:
    used = _used(rules, names)
    total = " + ".join(f"CAST({_violated(r)} AS INTEGER)" for r in used)
    inner = _with(
        source, DISTRICTS, _placed(names),
        then=f"""SELECT '{kind}' AS kind, count(*) FILTER (WHERE NOT {_any(used)}) AS rows_loaded,
  count(*) FILTER (WHERE {_any(used)}) AS rows_skipped,
  CAST(coalesce(sum({total}), 0) AS BIGINT) AS total_rejected FROM placed""",
    )
    return f"SELECT * FROM ({inner})"


ORACLES["validate_counts"] = "\nUNION ALL\n".join(
    [
        _counts("daily", _daily_as_fact(), DAILY, R.DAILY_RULES),
        _counts("hourly", _HOURLY, HOURLY, R.HOURLY_RULES),
        _counts("aqi-hourly", _AQI, AQI, R.AQI_RULES),
    ]
)
ORACLES["dup_keys"] = """SELECT CAST(user_id AS INTEGER) AS district_id,
  date_trunc('hour', ts) AS observed_at, count(*) AS copies
FROM events GROUP BY 1, 2 HAVING count(*) > 1"""
ORACLES["orphan_check"] = """SELECT DISTINCT CAST(o_custkey * 3 AS INTEGER) AS district_id
FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey * 3)"""
ORACLES["coordinate_check"] = _with(
    DISTRICTS,
    then="\nUNION ALL\n".join(
        f"""SELECT 'analyst.dim_district' AS source_table, district_id, '{r.field}' AS field_name,
  CAST({r.field} AS VARCHAR) AS invalid_value, '{r.reason()}' AS reason, 'error' AS severity
FROM districts WHERE {_violated(r)}"""
        for r in R.COORDINATE_RULES
    ),
)

# -- load and merge ------------------------------------------------------------------------


def _narrow(name: str, value: str | None = None) -> str:
    value = value or name
    if name == "weather_code":
        return f"CAST({value} AS INTEGER) AS {name}"
    return f"CAST(CAST({value} AS REAL) AS DOUBLE) AS {name}"


ORACLES["load_projection"] = _with(
    _daily_source(),
    DISTRICTS,
    then=f"""SELECT district_id, date_key, observed_date, {", ".join(_narrow(n) for n in DAILY)}
FROM daily JOIN districts USING (district_id)""",
)
ORACLES["release_widen"] = _with(
    _HOURLY,
    HOURS,
    then="SELECT CAST(district_id AS BIGINT) AS district_id, CAST(hour_key AS BIGINT) AS hour_key, "
    + ", ".join(
        f"CAST({n} AS BIGINT) AS {n}"
        if n == "weather_code"
        else f"CAST(CAST(CAST({n} AS REAL) AS VARCHAR) AS DOUBLE) AS {n}"
        for n in HOURLY
    )
    + " FROM fact JOIN hours USING (observed_at)",
)
ORACLES["insert_ignore"] = f"""SELECT date_key, "date", "year",
  CASE WHEN "date" <= DATE '1999-12-31' THEN 0 ELSE "quarter" END AS "quarter",
  "month", "day", day_of_week, is_weekend
FROM ({_calendar("lo", "hi", _days_of("o_orderdate", "orders"))})"""


def _plus_one(name: str) -> str:
    return name if name == "weather_code" else f"{name} + 1"


def _replaced(
    old: str, new: str, key: str, names: list[str], carry: list[str], show, extra: tuple = ()
) -> str:
    """Rows of ``new`` with shifted values, plus rows of ``old`` whose key ``new`` lacks."""
    carried = _cols(carry)
    return _with(
        old,
        new,
        *extra,
        then=f"""SELECT {carried}, {", ".join(show(n, _plus_one(n)) for n in names)} FROM newer
UNION ALL
SELECT {carried}, {", ".join(show(n, n) for n in names)} FROM older
WHERE ({key}) NOT IN (SELECT ({key}) FROM newer)""",
    )


_OLD_TS, _NEW_TS = "ts < TIMESTAMP '2024-01-21'", "ts >= TIMESTAMP '2024-01-16'"


def _keyed_source(name: str, recipes: list[Recipe], where: str) -> str:
    return (
        _hour_source(f"{name}_rows", recipes, where)
        + f",\n{name} AS (SELECT r.*, h.hour_key FROM {name}_rows r JOIN hours h USING (observed_at))"
    )


def _hourly_replaced(recipes: list[Recipe], names: list[str], show) -> str:
    carry = ["district_id", "hour_key"]
    return _replaced(
        HOURS + ",\n" + _keyed_source("older", recipes, _OLD_TS),
        _keyed_source("newer", recipes, _NEW_TS),
        "district_id, hour_key", names, carry, show,
    )


def _wide(name: str, value: str) -> str:
    if name == "weather_code":
        return f"CAST({value} AS BIGINT) AS {name}"
    return f"{value} AS {name}"


ORACLES["upsert_daily"] = _replaced(
    _daily_source("older", "o_orderdate < TIMESTAMP '2000-01-01'"),
    _daily_source("newer", "o_orderdate >= TIMESTAMP '1999-01-01'"),
    "district_id, date_key", DAILY, ["district_id", "date_key", "observed_date"], _narrow,
)
ORACLES["upsert_hourly"] = _hourly_replaced(HOURLY_RECIPES, HOURLY, _narrow)
ORACLES["upsert_aqi"] = _hourly_replaced(AQI_RECIPES, AQI, _narrow)
_KEPT = ("precipitation_sum", "rain_sum")
ORACLES["upsert_keep_absent"] = _with(
    _daily_source("older", "o_orderdate < TIMESTAMP '2000-01-01'"),
    _daily_source("newer", "o_orderdate >= TIMESTAMP '1999-01-01'"),
    then=f"""SELECT n.district_id, n.date_key, n.observed_date,
  {", ".join(_narrow(c, ("o." if c in _KEPT else "n.") + c) for c in DAILY)}
FROM newer n LEFT JOIN older o USING (district_id, date_key)
UNION ALL
SELECT district_id, date_key, observed_date, {", ".join(_narrow(c) for c in DAILY)} FROM older
WHERE (district_id, date_key) NOT IN (SELECT (district_id, date_key) FROM newer)""",
)
_MERGED = "SELECT CAST(district_id AS BIGINT) AS district_id, CAST(hour_key AS BIGINT) AS hour_key, {} FROM ({})"
ORACLES["merge_snapshot"] = _MERGED.format(
    _cols(HOURLY), _hourly_replaced(HOURLY_RECIPES, HOURLY, _wide)
)
ORACLES["merge_snapshot_first"] = _with(
    _daily_source(),
    then=f"""SELECT CAST(district_id AS BIGINT) AS district_id, CAST(date_key AS BIGINT) AS date_key,
  observed_date, {", ".join(_wide(n, n) for n in DAILY)} FROM daily""",
)
ORACLES["snapshot_schema_fill"] = _with(
    HOURS,
    _keyed_source("older", HOURLY_RECIPES, _OLD_TS),
    _keyed_source("newer", HOURLY_RECIPES, _NEW_TS),
    then=f"""SELECT CAST(district_id AS BIGINT) AS district_id, CAST(hour_key AS BIGINT) AS hour_key,
  {", ".join(_wide(n, n) for n in HOURLY)} FROM newer
UNION ALL
SELECT CAST(district_id AS BIGINT), CAST(hour_key AS BIGINT),
  {", ".join(_wide(n, "NULL" if n == "wind_direction_10m" else n) for n in HOURLY)} FROM older
WHERE (district_id, hour_key) NOT IN (SELECT (district_id, hour_key) FROM newer)""",
)

# -- sync ----------------------------------------------------------------------------------

ORACLES["watermarks_by_district"] = _with(
    HOURS,
    _keyed_source("whole", HOURLY_RECIPES, "TRUE"),
    then="SELECT district_id, max(hour_key) AS last_key FROM whole GROUP BY district_id",
)
ORACLES["watermark_dimension"] = _with(HOURS, then="SELECT max(hour_key) AS last_key FROM hours")
_TARGET = """target AS (SELECT f.* FROM copied f JOIN customer ON district_id = c_custkey
  WHERE c_nationkey BETWEEN 3 AND 19),
marks AS (SELECT c_custkey AS district_id, coalesce(max(hour_key), -1) AS mark
  FROM customer LEFT JOIN target ON district_id = c_custkey
  WHERE c_nationkey < 20 GROUP BY 1),
delta AS (SELECT w.* FROM whole w LEFT JOIN marks m USING (district_id)
  WHERE (m.mark IS NOT NULL AND w.hour_key > m.mark)
     OR w.observed_at >= TIMESTAMP '2024-01-20 07:00:00')"""
_SYNC = (
    HOURS,
    _keyed_source("copied", HOURLY_RECIPES, "ts < TIMESTAMP '2024-01-17'"),
    _keyed_source("whole", HOURLY_RECIPES, "TRUE"),
    _TARGET,
)
ORACLES["sync_delta_facts"] = _with(
    *_SYNC, then=f"SELECT district_id, hour_key, {_cols(HOURLY)} FROM delta"
)
ORACLES["sync_delta_daily"] = _with(
    _daily_source("copied", "o_orderdate < TIMESTAMP '2000-01-01'"),
    _daily_source("whole"),
    """marks AS (SELECT c_custkey AS district_id, coalesce(max(date_key), -1) AS mark
  FROM customer LEFT JOIN copied ON district_id = c_custkey
  WHERE c_nationkey < 20 GROUP BY 1)""",
    then="""SELECT w.* FROM whole w LEFT JOIN marks m USING (district_id)
WHERE (m.mark IS NOT NULL AND w.date_key > m.mark) OR w.observed_date >= DATE '2000-06-01'""",
)
ORACLES["sync_delta_dim"] = _with(
    HOURS,
    then="""SELECT * FROM hours
WHERE hour_key > (SELECT max(hour_key) FROM hours WHERE observed_date <= DATE '2024-01-16')
   OR observed_at >= TIMESTAMP '2024-01-12 07:00:00'""",
)
ORACLES["sync_apply"] = _MERGED.format(
    _cols(HOURLY),
    _with(
        *_SYNC,
        then=f"""SELECT district_id, hour_key, {", ".join(_wide(n, n) for n in HOURLY)} FROM delta
UNION ALL
SELECT district_id, hour_key, {", ".join(_wide(n, _plus_one(n)) for n in HOURLY)} FROM target
WHERE (district_id, hour_key) NOT IN (SELECT (district_id, hour_key) FROM delta)""",
    ),
)

# -- releases ------------------------------------------------------------------------------


def _stat(name: str, table: str, column: str | None) -> str:
    low = f"CAST(min({column}) AS VARCHAR)" if column else "CAST(NULL AS VARCHAR)"
    high = f"CAST(max({column}) AS VARCHAR)" if column else "CAST(NULL AS VARCHAR)"
    return (
        f"SELECT '{name}' AS name, count(*) AS row_count, {low} AS min_date, "
        f"{high} AS max_date FROM {table}"
    )


_STATS = (
    DISTRICTS,
    DATES,
    HOURS,
    _daily_source(),
    _hour_source("hourly", HOURLY_RECIPES),
    _hour_source("aqi", AQI_RECIPES),
    "stats AS (\n"
    + "\nUNION ALL\n".join(
        [
            _stat("dim_district", "districts", None),
            _stat("dim_date", "dates", '"date"'),
            _stat("dim_hour", "hours", "observed_date"),
            _stat("fact_weather_daily", "daily", "observed_date"),
            _stat("fact_weather_hourly", "hourly", None),
            _stat("fact_aqi_hourly", "aqi", None),
        ]
    )
    + ")",
    """ranged AS (SELECT s.name, s.row_count,
  CASE WHEN s.name IN ('fact_weather_hourly', 'fact_aqi_hourly') THEN h.min_date
       ELSE s.min_date END AS min_date,
  CASE WHEN s.name IN ('fact_weather_hourly', 'fact_aqi_hourly') THEN h.max_date
       ELSE s.max_date END AS max_date
  FROM stats s, (SELECT * FROM stats WHERE name = 'dim_hour') h)""",
)
ORACLES["table_stats"] = _with(*_STATS, then="SELECT * FROM stats")
ORACLES["release_hour_range"] = _with(*_STATS, then="SELECT * FROM ranged")

_FACTS = "('fact_weather_daily', 'fact_weather_hourly', 'fact_aqi_hourly')"


def _gate(source: str, end: str) -> str:
    expected = ", ".join(f"('{s.name}')" for s in TABLE_SPECS)
    return f"""SELECT coalesce(e.expected, g.name) AS name,
  'table set differs from the expected one' AS problem
FROM (VALUES {expected}) AS e(expected) FULL JOIN {source} g ON g.name = e.expected
WHERE e.expected IS NULL OR g.name IS NULL
UNION ALL SELECT name, 'table is empty' FROM {source} WHERE row_count <= 0
UNION ALL SELECT 'facts', 'fact max dates differ' FROM {source} WHERE name IN {_FACTS}
  HAVING NOT (count(max_date) = 3 AND min(max_date) = max(max_date))
UNION ALL SELECT 'facts', 'requested end date not reached' FROM {source} WHERE name IN {_FACTS}
  HAVING count(max_date) = 3 AND min(max_date) = max(max_date) AND max(max_date) < '{end}'"""


ORACLES["release_gate"] = _with(*_STATS, then=_gate("ranged", "2024-01-31"))
ORACLES["release_gate_incomplete"] = _with(
    *_STATS,
    """levelled AS (SELECT r.name, r.row_count, r.min_date,
  CASE WHEN r.max_date IS NOT NULL THEN h.max_date END AS max_date
  FROM ranged r, (SELECT max_date FROM ranged WHERE name = 'dim_hour') h
  WHERE r.name <> 'dim_date')""",
    then=_gate("levelled", "2030-01-01"),
)
ORACLES["release_retention"] = """WITH files AS (
  SELECT 'v1/releases/' || strftime(o_orderdate, '%Y%m%d')
      || CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE 'T040000Z' END
      || '/analyst/part-' || o_orderkey AS path,
    CASE WHEN o_orderkey % 10 <> 0
         THEN strftime(o_orderdate, '%Y%m%d') || 'T040000Z' END AS release_id
  FROM orders),
ranked AS (SELECT release_id, row_number() OVER (ORDER BY release_id DESC) AS rn
  FROM (SELECT DISTINCT release_id FROM files WHERE release_id <= '19990101T040000Z'))
SELECT release_id, path FROM files
WHERE release_id IN (SELECT release_id FROM ranked WHERE rn > 3)
  AND release_id <> '19990101T040000Z'"""
ORACLES["csv_roundtrip"] = _with(
    _daily_source(),
    then=f"""SELECT CAST(district_id AS BIGINT) AS district_id, CAST(date_key AS BIGINT) AS date_key,
  observed_date, {", ".join(
      _wide(n, n) if n == "weather_code"
      else f"CAST(CAST(CAST({n} AS REAL) AS VARCHAR) AS DOUBLE) AS {n}" for n in DAILY)}
FROM daily""",
)

# -- monitoring ----------------------------------------------------------------------------

_RUNS = """runs AS (
  SELECT event_id AS etl_run_id,
    CASE user_id % 3 WHEN 0 THEN 'incremental-daily' WHEN 1 THEN 'incremental-hourly'
         ELSE 'incremental-aqi-hourly' END AS run_type,
    CASE event_type WHEN 'signup' THEN 'running' WHEN 'error' THEN 'failed'
         ELSE 'completed' END AS status,
    ts AS started_at,
    CASE WHEN event_type <> 'signup'
         THEN ts + to_microseconds(CAST(floor(value * 1000000) AS BIGINT)) END AS finished_at,
    CAST(CASE WHEN event_type = 'signup' OR value < 2 THEN 0 ELSE floor(value) END AS BIGINT)
      AS rows_inserted,
    CASE WHEN event_type = 'signup' THEN 0 ELSE event_id % 7 END AS rows_skipped
  FROM events),
recent AS (SELECT * FROM runs WHERE started_at >= TIMESTAMP '2024-01-10')"""


def _shown(column: str) -> str:
    text = f"strftime({column} + INTERVAL 7 HOUR, '%d/%m/%Y %H:%M:%S') || ' (UTC+7)'"
    return f"coalesce({text}, '-')"


ORACLES["run_latest"] = _with(
    _RUNS, then="SELECT etl_run_id, run_type, status, rows_inserted FROM runs"
)
ORACLES["run_report"] = _with(
    _RUNS,
    then=f"""SELECT etl_run_id, run_type, status, rows_inserted, rows_skipped,
  {_shown("started_at")} AS started, {_shown("finished_at")} AS finished,
  status = 'completed' AND rows_inserted = 0 AS completed_empty,
  status <> 'completed' AS not_completed FROM recent""",
)
ORACLES["run_totals"] = _with(
    _RUNS,
    then="""SELECT count(*) AS runs, CAST(coalesce(sum(rows_inserted), 0) AS BIGINT) AS rows_inserted,
  string_agg(DISTINCT run_type, ', ' ORDER BY run_type) AS run_types,
  min(started_at) AS first_start,
  count(*) FILTER (WHERE status <> 'completed') AS not_completed FROM recent""",
)
ORACLES["run_catchup"] = _with(
    _RUNS,
    then="""SELECT needed, CASE WHEN needed THEN '2024-01-09' END AS catchup_date
FROM (SELECT count(*) = 0 OR count(*) FILTER (WHERE status <> 'completed') > 0 AS needed
      FROM recent)""",
)
ORACLES["job_duration"] = _with(
    _RUNS,
    then=f"""SELECT etl_run_id AS job_id, status, {_shown("started_at")} AS started,
  {_shown("finished_at")} AS finished,
  greatest(0, CAST(floor((epoch_us(finished_at) - epoch_us(started_at)) / 1000000) AS BIGINT))
    AS duration_seconds
FROM runs WHERE finished_at IS NOT NULL""",
)
ORACLES["warehouse_snapshot"] = _with(
    _daily_source(),
    _hour_source("hourly", HOURLY_RECIPES),
    _hour_source("aqi", AQI_RECIPES),
    then="""SELECT 'Daily weather' AS table_label, count(*) AS total_rows,
  coalesce(CAST(max(observed_date) AS VARCHAR), '-') AS latest_value FROM daily
UNION ALL SELECT 'Hourly weather', count(*), coalesce(CAST(max(observed_at) AS VARCHAR), '-')
FROM hourly
UNION ALL SELECT 'Hourly AQI', count(*), coalesce(CAST(max(observed_at) AS VARCHAR), '-')
FROM aqi""",
)

# -- jobs ----------------------------------------------------------------------------------

_INSIDE = f"""inside AS (SELECT * FROM districts
  WHERE NOT ({" OR ".join(_violated(r) for r in R.COORDINATE_RULES)}))"""
_SEEDED = "seeded AS (SELECT f.* FROM fact f JOIN inside USING (district_id))"


def _job(source: str, rules, names: list[str], then: str) -> str:
    used = [r for r in rules if r.field in names]
    good = f"good AS (SELECT *, NOT {_any(used)} AS passes FROM seeded)"
    return _with(source, DISTRICTS, _INSIDE, _SEEDED, good, then=then)


def _etl(source: str, rules, names: list[str], key: str) -> str:
    return _job(
        source, rules, names,
        f"SELECT district_id, {key}, {', '.join(_narrow(n) for n in names)} FROM good WHERE passes",
    )


ORACLES["etl_daily"] = _etl(_daily_as_fact(), R.DAILY_RULES, DAILY, "date_key, observed_date")
ORACLES["sync_two_warehouses"] = ORACLES["etl_daily"]
ORACLES["etl_hourly"] = _etl(_HOURLY, R.HOURLY_RULES, HOURLY, "observed_at")
ORACLES["etl_aqi"] = _etl(_AQI, R.AQI_RULES, AQI, "observed_at")
ORACLES["etl_errors"] = _with(
    _daily_as_fact(), DISTRICTS, _INSIDE, _SEEDED,
    then="\nUNION ALL\n".join(
        f"""SELECT 1 AS etl_run_id, 'analyst.fact_weather_daily' AS source_table, district_id,
  '{r.field}' AS field_name, CAST({r.field} AS VARCHAR) AS invalid_value,
  '{r.reason()}' AS reason, 'error' AS severity
FROM seeded WHERE {_violated(r)}"""
        for r in R.DAILY_RULES
        if r.field in DAILY
    ),
)
ORACLES["etl_counts"] = _job(
    _HOURLY, R.HOURLY_RULES, HOURLY,
    """SELECT 1 AS etl_run_id, 'historical-hourly' AS run_type, 'completed' AS status,
  count(*) FILTER (WHERE passes) AS rows_inserted,
  count(*) FILTER (WHERE NOT passes) + (SELECT count(*) FROM inside
    WHERE district_id NOT IN (SELECT user_id FROM events)) AS rows_skipped FROM good""",
)
ORACLES["etl_failures"] = _with(
    DISTRICTS, _INSIDE,
    then="""SELECT district_id, 'no document landed' AS error,
  'Failed to read data for district ' || district_name AS message
FROM inside WHERE district_id NOT IN (SELECT user_id FROM events)""",
)

# A batch of one district is a document like any other, and a week within it is preferred.
_OVERLAP_FACT = f"""batches AS (
  SELECT district_id // 50 AS batch, date_trunc('month', observed_date) AS m,
         count(DISTINCT district_id) AS members
  FROM months_base WHERE district_id % 5 = 0 AND day(observed_date) > 3 GROUP BY 1, 2),
fact AS (
  SELECT district_id, date_key, observed_date, {_measures(DAILY_RECIPES)}
  FROM (
    SELECT district_id, CAST(strftime(observed_date, '%Y%m%d') AS INTEGER) AS date_key,
           observed_date,
           cents + CASE
             WHEN district_id % 5 = 0 AND day(observed_date) > 3
               AND (members > 1 OR district_id % 3 <> 0 OR day(observed_date) > 7) THEN 2
             WHEN district_id % 3 = 0 AND day(observed_date) <= 7 THEN 1
             ELSE 0 END AS cents
    FROM months_base LEFT JOIN batches
      ON batch = district_id // 50 AND m = date_trunc('month', observed_date)))"""
ORACLES["etl_overlap"] = _etl(
    _daily_source("months") + ",\n" + _OVERLAP_FACT, R.DAILY_RULES, DAILY, "date_key, observed_date"
)
_SPOILT = "(district_id % 7 = 0 AND day(observed_at) % 4 = 0)"
ORACLES["etl_malformed"] = _etl(_HOURLY, R.HOURLY_RULES, HOURLY, "observed_at").replace(
    "WHERE passes", f"WHERE passes AND NOT {_SPOILT}"
)
ORACLES["etl_rejected_documents"] = _job(
    _HOURLY, R.HOURLY_RULES, HOURLY,
    f"""SELECT DISTINCT
  'archive-hourly/' || district_id || '/' || CAST(CAST(observed_at AS DATE) AS VARCHAR) AS doc_id,
  district_id, 'malformed time: 25 o''clock' AS error, 'WARNING' AS level
FROM good WHERE {_SPOILT}""",
)
ORACLES["etl_forecast"] = _etl(
    _daily_source("months")
    + """,
fact AS (SELECT * FROM (SELECT *, dense_rank() OVER (
    PARTITION BY district_id ORDER BY date_trunc('month', observed_date) DESC) AS rank FROM months)
  WHERE rank = CASE WHEN district_id % 8 = 0 THEN 3 WHEN district_id % 4 = 0 THEN 2 ELSE 1 END)""",
    R.DAILY_RULES, DAILY, "date_key, observed_date",
)

_REFERENCES = [
    ("dim_hour", "date_key", "dim_date", "hours",
     "date_key % 100 = 13 AND hour(observed_at) <> 5"),
    ("fact_weather_daily", "district_id", "dim_district", "daily", "district_id % 10 = 3"),
    ("fact_weather_daily", "date_key", "dim_date", "daily", "date_key % 100 = 13"),
    ("fact_weather_hourly", "district_id", "dim_district", "hourly", "district_id % 10 = 3"),
    ("fact_weather_hourly", "hour_key", "dim_hour", "hourly", "hour(observed_at) = 5"),
    ("fact_aqi_hourly", "district_id", "dim_district", "odd", "district_id % 10 = 3"),
    ("fact_aqi_hourly", "hour_key", "dim_hour", "odd", "hour(observed_at) = 5"),
]
ORACLES["foreign_keys"] = _with(
    HOURS,
    _daily_source(),
    _hour_source("hourly_rows", HOURLY_RECIPES),
    _hour_source("aqi_rows", AQI_RECIPES),
    "hourly AS (SELECT * FROM hourly_rows JOIN hours USING (observed_at))",
    "odd AS (SELECT * FROM aqi_rows JOIN hours USING (observed_at) WHERE district_id % 2 = 1)",
    then="\nUNION ALL\n".join(
        f"""SELECT '{child}' AS child_table, '{column}' AS child_column,
  '{parent}' AS parent_table, CAST({column} AS BIGINT) AS value, count(*) AS "rows"
FROM {source} WHERE {lost} GROUP BY {column}"""
        for child, column, parent, source, lost in _REFERENCES
    ),
)

# -- release jobs --------------------------------------------------------------------------


def _released(name: str) -> str:
    if name == "weather_code":
        return f"CAST({name} AS BIGINT) AS {name}"
    return f"CAST(CAST(CAST({name} AS REAL) AS VARCHAR) AS DOUBLE) AS {name}"


ORACLES["release_publish"] = _job(
    _HOURLY, R.HOURLY_RULES, HOURLY,
    f"""SELECT CAST(district_id AS BIGINT) AS district_id, observed_at,
  {", ".join(_released(n) for n in HOURLY)} FROM good WHERE passes""",
)


def _good(name: str, rules, names: list[str]) -> str:
    used = [r for r in rules if r.field in names]
    return f"""good_{name} AS (SELECT f.* FROM {name} f JOIN inside USING (district_id)
  WHERE NOT {_any(used)})"""


_DAILY_OF_EVENTS = f"""day_base AS (
  SELECT CAST(user_id AS INTEGER) AS district_id, CAST(ts AS DATE) AS observed_date,
         CAST(sum({_cents("value")}) AS BIGINT) AS cents FROM events GROUP BY 1, 2),
daily AS (SELECT district_id, observed_date, {_measures(DAILY_RECIPES)} FROM day_base)"""
ORACLES["release_manifest"] = _with(
    DISTRICTS,
    _INSIDE,
    DATES,
    _DAILY_OF_EVENTS,
    _hour_source("hourly", HOURLY_RECIPES),
    _hour_source("aqi", AQI_RECIPES),
    _good("daily", R.DAILY_RULES, DAILY),
    _good("hourly", R.HOURLY_RULES, HOURLY),
    _good("aqi", R.AQI_RULES, AQI),
    """hours AS (SELECT DISTINCT observed_at, CAST(observed_at AS DATE) AS observed_date
  FROM (SELECT observed_at FROM good_hourly UNION ALL SELECT observed_at FROM good_aqi))""",
    "stats AS (\n"
    + "\nUNION ALL\n".join(
        [
            _stat("dim_district", "inside", None),
            _stat("dim_date", "dates", '"date"'),
            _stat("dim_hour", "hours", "observed_date"),
            _stat("fact_weather_daily", "good_daily", "observed_date"),
            _stat("fact_weather_hourly", "good_hourly", None),
            _stat("fact_aqi_hourly", "good_aqi", None),
        ]
    )
    + ")",
    """ranged AS (SELECT s.name, s.row_count,
  CASE WHEN s.name IN ('fact_weather_hourly', 'fact_aqi_hourly') THEN h.min_date
       ELSE s.min_date END AS min_date,
  CASE WHEN s.name IN ('fact_weather_hourly', 'fact_aqi_hourly') THEN h.max_date
       ELSE s.max_date END AS max_date
  FROM stats s, (SELECT * FROM stats WHERE name = 'dim_hour') h)""",
    then="SELECT * FROM ranged",
)

ORACLES["release_summary"] = ORACLES["release_manifest"].replace(
    "SELECT * FROM ranged", "SELECT name, row_count AS \"rows\", TRUE AS has_files, max_date FROM ranged"
)
ORACLES["catch_up_release"] = _job(
    _AQI, R.AQI_RULES, AQI,
    f"""SELECT CAST(district_id AS BIGINT) AS district_id, observed_at,
  {", ".join(_released(n) for n in AQI)} FROM good WHERE passes""",
)
ORACLES["backfill_repair"] = _job(
    _HOURLY, R.HOURLY_RULES, HOURLY,
    f"""SELECT CAST(district_id AS BIGINT) AS district_id, observed_at,
  {_released("temperature_2m")},
  CASE WHEN CAST(observed_at AS DATE) BETWEEN DATE '2024-01-11' AND DATE '2024-01-20'
       THEN CAST(CAST(CAST(wind_direction_10m AS REAL) AS VARCHAR) AS DOUBLE)
  END AS wind_direction_10m FROM good WHERE passes""",
)

# -- histories, seeds, order, verification ----------------------------------------------------

_PASSES = "NOT " + _any([r for r in R.DAILY_RULES if r.field in DAILY])
ORACLES["history_skip"] = _with(
    _daily_source("months"),
    DISTRICTS,
    _INSIDE,
    f"""changed AS (SELECT district_id, observed_date, {_measures(DAILY_RECIPES)}
  FROM (SELECT district_id, observed_date, cents + 1 AS cents FROM months_base))""",
    f"""before AS (SELECT m.* FROM months m JOIN inside USING (district_id)
  WHERE district_id % 2 = 0 AND {_PASSES})""",
    f"""after AS (SELECT c.* FROM changed c JOIN inside USING (district_id)
  WHERE {_PASSES} AND district_id NOT IN (SELECT district_id FROM before))""",
    f"""loaded AS (SELECT district_id, observed_date, {_cols(DAILY)} FROM before
  UNION ALL SELECT district_id, observed_date, {_cols(DAILY)} FROM after)""",
    then=f"""SELECT district_id, CAST(strftime(observed_date, '%Y%m%d') AS INTEGER) AS date_key,
  observed_date, {", ".join(_narrow(n) for n in DAILY)} FROM loaded""",
)
ORACLES["seed_from_csv"] = _with(DISTRICTS, _INSIDE, then="SELECT * FROM inside")
ORACLES["sync_summary"] = _job(
    _daily_as_fact(), R.DAILY_RULES, DAILY,
    """SELECT name, n AS rows_read, n AS rows_upserted FROM (
  SELECT 'dim_district' AS name, (SELECT count(*) FROM inside) AS n
  UNION ALL SELECT 'fact_weather_daily',
    (SELECT count(*) FROM good WHERE passes AND observed_date > DATE '1999-12-31')
  UNION ALL VALUES ('dim_date', 0), ('dim_hour', 0), ('fact_weather_hourly', 0),
    ('fact_aqi_hourly', 0))""",
)
ORACLES["export_order"] = _with(
    _daily_source(),
    then="""SELECT district_id, date_key,
  row_number() OVER (ORDER BY district_id, date_key) AS ordinal FROM daily""",
)
ORACLES["read_order"] = _with(
    _daily_source(),
    then="""SELECT district_id, observed_date,
  row_number() OVER (ORDER BY observed_date, district_id) AS ordinal FROM daily
WHERE observed_date BETWEEN DATE '1996-03-01' AND DATE '1999-06-30'""",
)
_BLOCKS = """lines AS (
  SELECT c_custkey // 100 AS block, c_custkey,
         c_custkey || ',' || c_name || ',' || c_mktsegment || chr(10) AS line FROM customer),
blocks AS (SELECT block, string_agg(line, '' ORDER BY c_custkey) AS body FROM lines GROUP BY block)"""
ORACLES["release_inventory"] = _with(
    _BLOCKS,
    then="""SELECT 'table=block-' || block AS name, 'csv' AS format,
  strlen(body) AS length, sha256(body) AS sha256 FROM blocks""",
)
ORACLES["release_verify_tampered"] = _with(
    _BLOCKS,
    then="""SELECT 'table=block-' || block AS name, 'csv' AS format, 'changed' AS problem FROM lines
WHERE block % 5 = 1 AND c_custkey % 100 = 7
UNION ALL SELECT 'table=block-' || block, 'csv', 'missing' FROM blocks WHERE block % 5 = 2
UNION ALL SELECT 'table=block-' || (block + 10000000), 'csv', 'unexpected' FROM blocks
WHERE block % 5 = 3""",
)
ORACLES["run_types"] = _with(
    _RUNS,
    then="""SELECT run_type, count(*) AS runs, CAST(sum(rows_inserted) AS BIGINT) AS rows_inserted,
  count(*) FILTER (WHERE status <> 'completed') AS not_completed FROM recent GROUP BY run_type""",
)
ORACLES["run_catchup_flags"] = _with(
    _RUNS,
    "flags AS (SELECT * FROM (VALUES (TRUE), (FALSE)) a(scheduled), "
    "(VALUES (TRUE), (FALSE)) b(job_succeeded), (VALUES (TRUE), (FALSE)) c(error))",
    """counted AS (
  SELECT 'all' AS "window", count(*) AS runs,
         count(*) FILTER (WHERE status <> 'completed') AS bad, '2024-01-09' AS day FROM recent
  UNION ALL SELECT 'completed', count(*), 0, '2024-01-09' FROM recent WHERE status = 'completed'
  UNION ALL SELECT 'none', 0, 0, '2089-12-31')""",
    """judged AS (SELECT *, scheduled AND (NOT job_succeeded OR error OR bad > 0 OR runs = 0) AS needed
  FROM counted, flags)""",
    then="""SELECT "window", scheduled, job_succeeded, error, needed,
  CASE WHEN needed THEN day END AS catchup_date FROM judged""",
)
_JOBS = """jobs AS (
  SELECT CAST(CAST(ts AS DATE) AS VARCHAR) || '/' || event_type AS job_id, event_type,
         min(ts) AS first, max(ts) AS last, count(*) AS events
  FROM events WHERE ts >= TIMESTAMP '2024-01-12' GROUP BY CAST(ts AS DATE), event_type),
reported AS (SELECT * FROM jobs WHERE event_type <> 'view'),
since AS (SELECT min(first) AS moment FROM reported),
window_runs AS (SELECT runs.* FROM runs, since WHERE started_at >= moment)"""
ORACLES["job_reports"] = _with(
    _RUNS, _JOBS,
    then="""SELECT job_id, CASE WHEN events % 2 = 0 THEN 'success' ELSE 'failure' END AS status,
  strftime(first, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS started_at_utc,
  strftime(last, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS finished_at_utc,
  events AS duration_seconds FROM reported""",
)
ORACLES["workflow_report"] = _with(
    _RUNS, _JOBS,
    then=ORACLES["run_report"][ORACLES["run_report"].rindex("SELECT etl_run_id"):].replace(
        "FROM recent", "FROM window_runs"
    ),
)
ORACLES["workflow_totals"] = _with(
    _RUNS, _JOBS,
    then="""SELECT run_type, count(*) AS runs, CAST(sum(rows_inserted) AS BIGINT) AS rows_inserted,
  count(*) FILTER (WHERE status <> 'completed') AS not_completed,
  (SELECT count(*) = 0 OR count(*) FILTER (WHERE status <> 'completed') > 0 FROM window_runs)
    AS needed,
  CASE WHEN (SELECT count(*) = 0 OR count(*) FILTER (WHERE status <> 'completed') > 0
             FROM window_runs)
       THEN (SELECT CAST(CAST(moment + INTERVAL 7 HOUR AS DATE) - 1 AS VARCHAR) FROM since) END
    AS catchup_date
FROM window_runs GROUP BY run_type""",
)
