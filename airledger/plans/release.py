"""Snapshot releases: bootstrap, incremental publishing and repair of a date window."""

from __future__ import annotations

from datetime import date, datetime, timezone

from airledger.functions.temporal import local_yesterday
from airledger.operators.merge import PARTITION_COLUMN
from airledger.operators.quality import require_empty, require_unique
from airledger.operators.reads import export_window
from airledger.operators.snapshot import (
    hour_range_from_dimension,
    merge_snapshot,
    month_stats,
    publish_range,
    release_form,
    release_problems,
    table_stats,
)
from airledger.schemas import DIM_HOUR, TABLE_SPECS, TableSpec
from airledger.session import Staging, side_by_side, staging
from airledger.sinks.release_files import (
    ReleaseStore,
    build_manifest,
    inventory_totals,
    release_key,
    row_digest,
    write_csv,
    write_parquet,
)
from airledger.sinks.warehouse import Warehouse

STATS_SCHEMA = "name string, row_count bigint, min_date string, max_date string"


def bootstrap(
    warehouse: Warehouse, store: ReleaseStore, source: str, now: datetime | None = None
) -> dict:
    """First release: everything the warehouse holds, no date filter."""
    return _build(warehouse, store, source, None, None, now)


def publish(
    warehouse: Warehouse,
    store: ReleaseStore,
    source: str,
    *,
    target: date | None = None,
    start: date | None = None,
    end: date | None = None,
    force: bool = False,
    now: datetime | None = None,
) -> dict | None:
    """Publish what lies after the current release, or repair one window; None if current."""
    latest = store.read_latest()
    if latest is None:
        raise ValueError("nothing published yet: bootstrap first")
    max_dates = {name: t["max_date"] for name, t in latest[1]["tables"].items()}
    window = publish_range(
        max_dates, target or end or local_yesterday(now), start, end, force
    )
    return None if window is None else _build(warehouse, store, source, latest, window, now)


def release_result(status: str, manifest: dict) -> dict:
    return {
        "status": status,
        "release_id": manifest["release_id"],
        "generated_at_vietnam": manifest["generated_at_vietnam"],
        "tables": {
            name: {
                "rows": t["row_count"],
                "bytes": t["parquet_bytes"] + t["csv_bytes"],
                "max_date": t["max_date"],
            }
            for name, t in manifest["tables"].items()
        },
    }


def _build(
    warehouse: Warehouse,
    store: ReleaseStore,
    source: str,
    latest: tuple[dict, dict] | None,
    window: tuple[date, date] | None,
    now: datetime | None,
) -> dict:
    moment = (now or datetime.now(timezone.utc)).astimezone(timezone.utc)
    release_id = moment.strftime("%Y%m%dT%H%M%SZ")
    spark = warehouse.spark
    current = latest[1] if latest else None
    with staging(spark, "release") as stage:
        built = side_by_side(
            spark,
            lambda spec: _build_table(warehouse, store, stage, spec, release_id, current, window),
            TABLE_SPECS,
        )
    measured = [stats for stats, _ in built]
    months = {stats[0]: held for stats, held in built}
    stats = hour_range_from_dimension(spark.createDataFrame(measured, STATS_SCHEMA))
    require_empty(
        release_problems(stats, window[1] if window else None), "release must not be published"
    )
    store.record_inventory(release_id)
    outline = {
        "release_id": release_id,
        "tables": {name: {"months": held} for name, held in months.items()},
    }
    totals = inventory_totals(store.recorded_files(outline))
    manifest = build_manifest(
        release_id, source, moment, stats.collect(), totals.collect(), months
    )
    store.activate(manifest, moment, latest[0]["release_id"] if latest else None)
    return manifest


def _build_table(
    warehouse: Warehouse,
    store: ReleaseStore,
    stage: Staging,
    spec: TableSpec,
    release_id: str,
    current: dict | None,
    window: tuple[date, date] | None,
) -> tuple[tuple, dict[str, dict]]:
    """Write one table of a release; its statistics, and for a fact what release holds which
    month.

    Of a fact only the months that the window's rows lie in are read, merged and written; the
    others stay in the releases that hold them.
    """
    spark = warehouse.spark
    start, end = window if window and not spec.full_refresh else (None, None)
    exported = export_window(
        warehouse.physical(spec), spec, start, end, warehouse.table(DIM_HOUR)
    )
    delta = stage.put(release_form(exported, spec), f"{spec.name}-delta")
    if delta.isEmpty():
        raise ValueError(f"{spec.name} export returned zero rows")
    require_unique(delta, spec.primary_key, spec.name)

    touched, held = None, {}
    if spec.partitioned:
        # At most twelve values a year, whatever the number of rows.
        found = delta.select(PARTITION_COLUMN).distinct().collect()
        touched = [str(row[0]) for row in found]
        if current is not None:
            held = dict(current["tables"][spec.name].get("months", {}))
            if not held:
                raise ValueError(f"{spec.name} was released undivided: bootstrap anew")
    before = None if current is None else store.snapshot(current, spec, touched)
    merged = delta if before is None else merge_snapshot(before, delta, spec, current_unique=True)
    if before is not None:
        merged = stage.put(merged, spec.name)

    parquet = store.at(release_key(release_id, spec.name, "parquet"))
    write_parquet(merged, spec, parquet)
    written = spark.read.schema(merged.schema).parquet(parquet)
    if row_digest(written).first() != row_digest(merged.select(*written.columns)).first():
        raise RuntimeError(f"{spec.name} was not written as it was merged")
    write_csv(written, spec, store.at(release_key(release_id, spec.name, "csv")))
    if not spec.partitioned:
        return tuple(table_stats(written, spec).first()), {}
    for row in month_stats(written, spec).collect():
        held[str(row[PARTITION_COLUMN])] = {
            "release_id": release_id,
            "row_count": row.row_count,
            "min_date": row.min_date,
            "max_date": row.max_date,
        }
    low = [part["min_date"] for part in held.values() if part["min_date"] is not None]
    high = [part["max_date"] for part in held.values() if part["max_date"] is not None]
    count = sum(part["row_count"] for part in held.values())
    return (spec.name, count, min(low, default=None), max(high, default=None)), held
