"""Landed documents to typed observation rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airledger.functions import rules as R
from airledger.functions.temporal import (
    date_key,
    local_date,
    month_key,
    try_iso_date,
    try_iso_instant,
)
from airledger.operators.merge import latest_per_key
from airledger.operators.ordering import ORDINAL
from airledger.schemas import (
    AQI_MEASURES,
    DAILY_MEASURES,
    FACT_AQI,
    FACT_DAILY,
    FACT_HOURLY,
    HOURLY_MEASURES,
    INTEGER_MEASURES,
    UNSTORED_DAILY_MEASURES,
    TableSpec,
)


@dataclass(frozen=True)
class Kind:
    """One family of observations: where its arrays sit, what they hold, where rows go."""

    name: str
    section: str
    measures: tuple[str, ...]
    rules: tuple[R.RangeRule, ...]
    spec: TableSpec

    @property
    def hourly(self) -> bool:
        return self.section == "hourly"

    @property
    def time(self) -> str:
        return "observed_at" if self.hourly else "observed_date"

    @property
    def document_schema(self) -> str:
        """Series are read as text: one odd element must not null a whole array."""
        series = ", ".join(f"{name}: array<string>" for name in ("time", *self.measures))
        return f"array<struct<{self.section}: struct<{series}>>>"


DAILY = Kind(
    "daily", "daily", DAILY_MEASURES + UNSTORED_DAILY_MEASURES, R.DAILY_RULES, FACT_DAILY
)
HOURLY = Kind("hourly", "hourly", HOURLY_MEASURES, R.HOURLY_RULES, FACT_HOURLY)
AQI = Kind("aqi-hourly", "hourly", AQI_MEASURES, R.AQI_RULES, FACT_AQI)
KINDS = {kind.name: kind for kind in (DAILY, HOURLY, AQI)}

_STEP_BITS = 22


def _checked(landing: DataFrame, kind: Kind) -> DataFrame:
    """Parse each body once and note why a document cannot be used, if so."""
    parsed = landing.select(
        "doc_id", "feed", "district_ids", "start_date", "end_date",
        F.from_json("body", kind.document_schema).alias("elements"),
    )
    problem = F.when(F.col("elements").isNull(), F.lit("document is not valid JSON")).when(
        F.size("elements") != F.size("district_ids"),
        F.concat(
            F.lit("document holds "), F.size("elements").cast("string"),
            F.lit(" payloads for "), F.size("district_ids").cast("string"),
            F.lit(" districts"),
        ),
    )
    return parsed.withColumn("problem", problem)


def unpack_documents(
    landing: DataFrame, kind: Kind, *, with_problems: bool = True
) -> DataFrame:
    """One row per (document, district) with the district's series and its times, parsed once.

    A lone object counts as an array of one. A document that is not JSON, or whose element
    count differs from its district count, yields one row per district with ``problem`` set
    and no series, or no rows if ``with_problems`` is off; other documents are unaffected.
    An element with a text that is no time has ``problem`` set too and no times, while the
    other elements of its document stay usable.
    The choice is made inside the exploded expression, because a filter on ``problem`` would
    be pushed below the parse and repeat it.
    """
    fine = F.col("problem").isNull()
    ids = F.col("district_ids").alias("district_id")
    if with_problems:
        nothing = F.array().cast(kind.document_schema)
        elements = F.when(fine, F.col("elements")).otherwise(nothing)
        paired = F.arrays_zip(ids, elements.alias("element"))
    else:
        paired = F.when(fine, F.arrays_zip(ids, F.col("elements").alias("element")))
    carried = ["doc_id", "feed", "start_date", "end_date", "problem", "is_batch", "district_id"]
    unpacked = (
        _checked(landing, kind)
        .select(
            "doc_id", "feed", "start_date", "end_date", "problem",
            (F.size("district_ids") > 1).alias("is_batch"),
            F.inline(paired).alias("district_id", "element"),
        )
        .select(*carried, F.col(f"element.{kind.section}").alias("series"))
    )
    read = try_iso_instant if kind.hourly else try_iso_date
    word = "malformed time: " if kind.hourly else "malformed date: "
    timed = unpacked.withColumn("times", F.transform("series.time", lambda t: read(t)))
    odd = F.exists("times", lambda t: t.isNull())
    first = F.get(F.filter("series.time", lambda t: read(t).isNull()), F.lit(0))
    return timed.withColumns(
        {
            "problem": F.when(
                odd, F.concat(F.lit(word), F.coalesce(first, F.lit("null")))
            ).otherwise(F.col("problem")),
            "times": F.when(odd, F.lit(None)).otherwise(F.col("times")),
        }
    )


def unpivot(elements: DataFrame, kind: Kind) -> DataFrame:
    """Column arrays to rows; the times alone decide how many.

    Shorter series are padded with null and longer ones cut. Elements without any time keep
    one row with the time null, so that a district which delivered nothing can be told from
    one whose document is missing. ``step`` is a row's place in its series.
    """
    empty = F.array().cast("array<string>")
    steps = F.greatest(F.coalesce(F.size("times"), F.lit(0)), F.lit(0))
    padded = F.arrays_zip(
        F.sequence(F.lit(1), F.greatest(F.col("steps"), F.lit(1))).alias("step"),
        F.coalesce("times", F.array()).alias(kind.time),
        *[F.coalesce(F.col(f"series.{name}"), empty).alias(name) for name in kind.measures],
    )
    # ``steps`` is taken before exploding, so that no array is carried onto the rows.
    rows = elements.withColumn("steps", steps).select(
        *[c for c in elements.columns if c not in ("series", "times")],
        "steps",
        F.inline_outer(F.slice(padded, F.lit(1), F.col("steps"))).alias(
            "step", kind.time, *kind.measures
        ),
    )
    typed = [
        F.col(m).cast("double").cast("int").alias(m)
        if m in INTEGER_MEASURES
        else F.col(m).cast("double").alias(m)
        for m in kind.measures
    ]
    carried = [c for c in rows.columns if c not in kind.measures]
    return rows.select(*carried, *typed)


def with_keys(rows: DataFrame, kind: Kind) -> DataFrame:
    """Derive the day and the keys that depend on it."""
    if kind.hourly:
        rows = rows.withColumn("observed_date", local_date(F.col("observed_at")))
    return rows.withColumns(
        {
            "date_key": date_key(F.col("observed_date")),
            "month_key": month_key(F.col("observed_date")),
        }
    )


def observations(rows: DataFrame) -> DataFrame:
    """Leave out the placeholders of elements that delivered nothing.

    A filter on ``steps`` would be pushed below the unpivot and parse the times again.
    """
    return rows.where(F.col("step").isNotNull()).drop("steps", "step")


def parse_payloads(landing: DataFrame, kind: Kind) -> DataFrame:
    """Landing rows to keyed observation rows; what has a problem is left out."""
    good = unpack_documents(landing, kind, with_problems=False)
    return observations(with_keys(unpivot(good, kind), kind))


def document_problems(landing: DataFrame, kind: Kind) -> DataFrame:
    affected = F.when(F.col("problem").isNotNull(), F.col("district_ids"))
    return _checked(landing, kind).select(
        "doc_id", "feed", F.explode(affected).alias("district_id"), "problem"
    )


def element_problems(rows: DataFrame) -> DataFrame:
    """(district_id, doc_id, problem) of the unpivoted elements that cannot be used."""
    return rows.where("problem IS NOT NULL").select("district_id", "doc_id", "problem").distinct()


def preference() -> list:
    """Order of documents for one time, the preferred one last.

    A batch goes before a single document, which is thereby only a fallback; then the one made
    for fewer days, then the one that ends later.
    """
    days = F.datediff("end_date", "start_date")
    return [F.col("is_batch"), days.desc(), F.col("end_date"), F.col("doc_id")]


# Order of forecasts: the latest start last.
NEWEST = ("start_date", "end_date", "is_batch", "doc_id")


def usable_documents(rows: DataFrame) -> DataFrame:
    """(district, document) pairs of unpivoted rows that have no problem."""
    return (
        rows.groupBy("district_id", "doc_id", "start_date", "end_date", "is_batch")
        .agg(F.count("problem").alias("problems"))
        .where("problems = 0")
        .drop("problems")
    )


def preferred_rows(rows: DataFrame, documents: DataFrame, kind: Kind) -> DataFrame:
    """One keyed row for each district and time, from the document with the greatest ordinal."""
    ranks = documents.select("district_id", "doc_id", ORDINAL)
    return ranked_rows(rows.join(ranks, ["district_id", "doc_id"]), kind)


def ranked_rows(rows: DataFrame, kind: Kind, carried: Sequence[str] = ()) -> DataFrame:
    """One keyed row for each district and time of rows that carry their document's ordinal.

    So documents may overlap in any way, and a time that the preferred one lacks comes from
    the next. Of a time that one document repeats, the last row counts. The choice is a hash
    aggregate over one number per row, combined before it is shuffled. ``carried`` columns
    follow from the district.
    """
    key = ["district_id", kind.time, *carried]
    place = F.shiftleft(F.col(ORDINAL), _STEP_BITS) + F.col("step")
    ranked = rows.where((F.col("steps") > 0) & F.col(ORDINAL).isNotNull()).select(
        *key, *kind.measures, place.alias("_place")
    )
    return with_keys(latest_per_key(ranked, key, "_place").drop("_place"), kind)
