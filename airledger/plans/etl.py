"""Landing documents into the warehouse: historical, incremental and forecast runs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airledger.functions.temporal import local_yesterday
from airledger.operators.calendar import CALENDAR_START, build_dim_date
from airledger.operators.districts import missing_payloads, not_yet_loaded, select_districts
from airledger.operators.hours import attach_hour_key, distinct_hours, refresh_hours
from airledger.operators.ordering import ORDINAL, with_ordinal
from airledger.operators.payload import (
    KINDS,
    NEWEST,
    Kind,
    element_problems,
    preference,
    ranked_rows,
    unpack_documents,
    unpivot,
    with_keys,
)
from airledger.operators.quality import (
    VIOLATIONS,
    coordinate_errors,
    count_judged,
    error_rows,
    judged,
    require_empty,
)
from airledger.operators.snapshot import load_projection
from airledger.schemas import ANALYST, DIM_DATE, DIM_DISTRICT, DIM_HOUR
from airledger.session import Staging, staging
from airledger.sinks.warehouse import Warehouse
from airledger.sources.landing import documents_between, forecast_documents

MODES = ("historical", "incremental", "forecast")
RUN_TYPES = tuple(f"{mode}-{kind}" for mode in MODES for kind in KINDS)
INCREMENTAL_DAYS = 1


@dataclass(frozen=True)
class RunResult:
    run_id: int
    rows_loaded: int
    rows_skipped: int
    total_rejected: int
    failed_districts: int


def split_run_type(run_type: str) -> tuple[str, Kind]:
    if run_type not in RUN_TYPES:
        raise ValueError(f"unsupported run type: {run_type}")
    mode, _, kind = run_type.partition("-")
    return mode, KINDS[kind]


def run_dates(
    run_type: str,
    start: date | None = None,
    end: date | None = None,
    yesterday: date | None = None,
) -> tuple[date, date]:
    """Inclusive date range of a run; explicit bounds come in pairs and win."""
    mode, _ = split_run_type(run_type)
    if (start is None) != (end is None):
        raise ValueError("start and end must be given together")
    if start is not None:
        if start > end:
            raise ValueError("start must be before or equal to end")
        return start, end
    last = yesterday or local_yesterday()
    if mode == "historical":
        return CALENDAR_START, last
    if mode == "incremental":
        return last - timedelta(days=INCREMENTAL_DAYS - 1), last
    return last, last


def feed_name(mode: str, kind: Kind) -> str:
    return f"{'forecast' if mode == 'forecast' else 'archive'}-{kind.name}"


def seed_districts(warehouse: Warehouse, districts: DataFrame) -> None:
    """Upsert districts after checking that they lie in the permitted area."""
    require_empty(coordinate_errors(districts), "district outside the permitted area")
    warehouse.upsert(DIM_DISTRICT, districts)


def ensure_dates(
    warehouse: Warehouse, start: date = CALENDAR_START, end: date | None = None
) -> None:
    """Insert missing calendar days, leaving existing ones untouched."""
    warehouse.insert_ignore(DIM_DATE, build_dim_date(warehouse.spark, start, end))


def run_etl(
    warehouse: Warehouse,
    landing: DataFrame,
    run_type: str,
    *,
    start: date | None = None,
    end: date | None = None,
    district_ids: Sequence[int] | None = None,
    first: int | None = None,
    districts: DataFrame | None = None,
    yesterday: date | None = None,
) -> RunResult:
    """One run over all districts at once, recorded in the monitoring tables.

    A document that cannot be used, a malformed time included, or a district without any, is
    logged and skipped while the others load. Districts the warehouse doesn't know are logged.
    """
    mode, kind = split_run_type(run_type)
    start, end = run_dates(run_type, start, end, yesterday)
    run_id = warehouse.start_run(run_type)
    try:
        known = districts if districts is not None else warehouse.table(DIM_DISTRICT)
        chosen = select_districts(known, district_ids, first)
        feed = feed_name(mode, kind)
        documents = (
            forecast_documents(landing, feed)
            if mode == "forecast"
            else documents_between(landing, feed, start, end)
        )
        result = _load(warehouse, documents, kind, chosen, run_id, mode == "forecast", start, end)
    except Exception as failure:
        warehouse.complete_run(run_id, "failed", error_summary=str(failure))
        raise
    _log_summary(warehouse, run_type, mode, kind, result, start, end)
    warehouse.complete_run(
        run_id, "completed", inserted=result.rows_loaded, skipped=result.rows_skipped
    )
    return result


def _load(
    warehouse: Warehouse,
    documents: DataFrame,
    kind: Kind,
    districts: DataFrame,
    run_id: int,
    forecast: bool,
    start: date,
    end: date,
) -> RunResult:
    places = districts.select("district_id", "latitude", "longitude")
    with staging(warehouse.spark, "etl") as stage:
        if forecast:
            parsed = _newest_forecasts(stage, documents, kind, places)
            usable = parsed.where("problem IS NULL")
        else:
            ranks = _document_ranks(stage, documents)
            parsed = stage.put(
                _unpivoted(_dealt_out(documents), kind, places, ranks), "parsed"
            )
            usable = _without_unusable(parsed)

        failed = stage.put(missing_payloads(places, usable), "failed")
        _log_failed(warehouse, failed, parsed, run_id)
        _log_documents(warehouse, documents, parsed, run_id)
        failed_districts = failed.count()

        if not forecast:
            usable = usable.where(F.col("observed_date").between(F.lit(start), F.lit(end)))
        chosen = ranked_rows(usable, kind, ["latitude", "longitude"])
        rows = stage.put(judged(chosen, kind.rules), "rows")
        outcome = count_judged(rows).first()
        if outcome.rows_skipped:
            table = f"{ANALYST}.{kind.spec.name}"
            rejected = rows.where(F.col(VIOLATIONS) > 0)
            errors = error_rows(rejected, kind.rules, table).select(
                F.lit(run_id).alias("etl_run_id"), "*", F.now().alias("created_at")
            )
            warehouse.append("validation_errors", errors)
        if outcome.rows_loaded:
            _store(warehouse, stage, rows.where(F.col(VIOLATIONS) == 0), kind)
        return RunResult(
            run_id,
            outcome.rows_loaded,
            outcome.rows_skipped + failed_districts,
            outcome.total_rejected,
            failed_districts,
        )


def _dealt_out(documents: DataFrame) -> DataFrame:
    """Documents spread over the tasks that parse them: a landed file is small, compressed as it
    is, for what its rows cost. Forecasts come from a join and are spread by it."""
    return documents.repartition("doc_id")


_DOCUMENT = ("doc_id", "start_date", "end_date", "is_batch")


def _document_ranks(stage: Staging, documents: DataFrame) -> DataFrame:
    """Ordinals by preference, from what the landing says of the documents: their bodies, and
    the districts in them, are not sorted."""
    listed = documents.select(
        "doc_id", "start_date", "end_date", (F.size("district_ids") > 1).alias("is_batch")
    )
    ranked = with_ordinal(stage, listed, preference(), "documents")
    return ranked.groupBy(*_DOCUMENT).agg(F.max(ORDINAL).alias(ORDINAL))


def _unpivoted(
    documents: DataFrame, kind: Kind, places: DataFrame, ranks: DataFrame | None = None
) -> DataFrame:
    """Keyed rows with the columns of their place and, if given, their document's rank."""
    elements = unpack_documents(documents, kind).join(places, "district_id")
    if ranks is not None:
        elements = elements.join(ranks, [*_DOCUMENT], "left")
    return with_keys(unpivot(elements, kind), kind)


def _without_unusable(parsed: DataFrame) -> DataFrame:
    """Rows of (district, document) pairs in which nothing has a problem."""
    pair = ("district_id", *_DOCUMENT)
    lost = parsed.where("problem IS NOT NULL").select(
        *[F.col(c).alias(f"_{c}") for c in pair]
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in pair]
    return parsed.join(lost.distinct(), reduce(Column.__and__, same), "left_anti")


def _newest_forecasts(
    stage: Staging, documents: DataFrame, kind: Kind, places: DataFrame
) -> DataFrame:
    """Rows of each district's newest forecasts up to the usable one, with their ordinals.

    Documents are ranked by what the landing says of them, without their bodies. One per
    district is parsed; districts whose document cannot be used step back to the next one, so
    there are as many rounds as the longest row of unusable documents.
    """
    offers = documents.select(
        "doc_id", "start_date", "end_date",
        (F.size("district_ids") > 1).alias("is_batch"),
        F.explode("district_ids").alias("district_id"),
    ).join(places.select("district_id"), "district_id", "left_semi")
    offers = stage.put(with_ordinal(stage, offers, NEWEST, "ranked"), "offers")
    open_offers, parts = offers, []
    while True:
        number = len(parts)
        best = open_offers.groupBy("district_id").agg(F.max(ORDINAL).alias(ORDINAL))
        best = stage.put(
            best.join(offers, ["district_id", ORDINAL]).select("district_id", "doc_id", ORDINAL),
            f"best-{number}",
        )
        wanted = documents.join(best.select("doc_id").distinct(), "doc_id", "left_semi")
        rows = _unpivoted(wanted, kind, places).join(best, ["district_id", "doc_id"])
        parts.append(stage.put(rows, f"parsed-{number}"))
        unusable = (
            parts[-1].where("problem IS NOT NULL")
            .select("district_id", F.col(ORDINAL).alias("_unusable")).distinct()
        )
        open_offers = stage.put(
            offers.join(unusable, "district_id")
            .where(F.col(ORDINAL) < F.col("_unusable"))
            .drop("_unusable"),
            f"open-{number}",
        )
        if open_offers.isEmpty():
            break
    return reduce(DataFrame.unionByName, parts)


def _store(warehouse: Warehouse, stage: Staging, rows: DataFrame, kind: Kind) -> None:
    if kind.hourly:
        hours = stage.put(distinct_hours(rows), "hours")
        warehouse.require_parents(DIM_HOUR, hours)
        warehouse.write_version(DIM_HOUR, refresh_hours(warehouse.table(DIM_HOUR), hours))
        rows = attach_hour_key(rows, warehouse.table(DIM_HOUR))
    # Not stored once more: of the stored rows each step of an upsert reads a few columns.
    warehouse.upsert(kind.spec, load_projection(rows, kind.spec))


def _log_documents(
    warehouse: Warehouse, documents: DataFrame, parsed: DataFrame, run_id: int
) -> None:
    """Documents that were parsed and cannot be used, and districts nobody knows."""
    rejected = element_problems(parsed).select(
        F.lit("document_rejected").alias("event_name"),
        F.lit("Document cannot be used").alias("message"),
        F.create_map(
            F.lit("doc_id"), F.col("doc_id"),
            F.lit("district_id"), F.col("district_id").cast("string"),
            F.lit("error"), F.col("problem"),
        ).alias("context"),
    )
    named = documents.select(F.explode("district_ids").alias("district_id")).distinct()
    unknown = named.join(warehouse.table(DIM_DISTRICT), "district_id", "left_anti").select(
        F.lit("unknown_district").alias("event_name"),
        F.lit("Documents name a district that is not in the warehouse").alias("message"),
        F.create_map(
            F.lit("district_id"), F.coalesce(F.col("district_id").cast("string"), F.lit("null"))
        ).alias("context"),
    )
    warehouse.append(
        "etl_logs",
        rejected.unionByName(unknown).select(
            F.lit(run_id).alias("etl_run_id"),
            F.lit("WARNING").alias("level"),
            "event_name", "message", "context",
            F.now().alias("created_at"),
        ),
    )


def _log_failed(
    warehouse: Warehouse, failed: DataFrame, parsed: DataFrame, run_id: int
) -> None:
    reasons = (
        parsed.where(F.col("problem").isNotNull())
        .groupBy("district_id")
        .agg(F.max("problem").alias("problem"))
    )
    named = warehouse.table(DIM_DISTRICT).select("district_id", "district_name")
    message = F.concat(F.lit("Failed to read data for district "), F.col("district_name"))
    warehouse.append(
        "etl_logs",
        failed.join(named, "district_id", "left")
        .join(reasons, "district_id", "left")
        .select(
            F.lit(run_id).alias("etl_run_id"),
            F.lit("ERROR").alias("level"),
            F.lit("extract_failed").alias("event_name"),
            F.coalesce(message, F.lit("Failed to read data for district")).alias("message"),
            F.create_map(
                F.lit("district_id"), F.col("district_id").cast("string"),
                F.lit("error"), F.coalesce("problem", F.lit("no document landed")),
            ).alias("context"),
            F.now().alias("created_at"),
        ),
    )


def _log_summary(
    warehouse: Warehouse,
    run_type: str,
    mode: str,
    kind: Kind,
    result: RunResult,
    start: date,
    end: date,
) -> None:
    warehouse.log(
        result.run_id,
        "INFO",
        f"{mode}_{kind.name}_complete".replace("-", "_"),
        f"{run_type} completed",
        {
            "rows_loaded": str(result.rows_loaded),
            "rows_skipped": str(result.rows_skipped),
            "total_rejected": str(result.total_rejected),
            "start_date": start.isoformat(),
            "end_date": end.isoformat(),
        },
    )


def load_history(
    warehouse: Warehouse,
    landing: DataFrame,
    kind_name: str,
    *,
    start: date = CALENDAR_START,
    end: date | None = None,
    skip_existing: bool = False,
) -> RunResult:
    """Full historical load of one kind, optionally leaving loaded districts out."""
    last = end or local_yesterday()
    ensure_dates(warehouse, start, last)
    districts = warehouse.table(DIM_DISTRICT)
    if skip_existing:
        districts = not_yet_loaded(districts, warehouse.table(KINDS[kind_name].spec))
    return run_etl(
        warehouse, landing, f"historical-{kind_name}", start=start, end=last, districts=districts
    )
