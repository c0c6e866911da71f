"""Parquet warehouse: keyed upserts without a table format.

Facts are partitioned by ``month_key`` and upserted by rewriting only the months a delta
touches. The rewritten months go to a folder of their own, and one small document that says
which folder holds each month switches all of them at once; a load that stops before leaves
the old state. Small dimension tables are written as whole new versions; the newest version whose
write finished (it has a ``_SUCCESS`` marker) is the current one. Monitoring tables are only
appended to. As in any plain Parquet layout there must be a single writer per table.
"""

from __future__ import annotations

import json
import re
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airledger.operators.integrity import keys_of, require_parents
from airledger.operators.merge import (
    PARTITION_COLUMN,
    fold_delta,
    new_rows,
    normalise,
    replace_delta,
    require_known_columns,
)
from airledger.operators.quality import require_unique
from airledger.schemas import ANALYST, MONITORING, MONITORING_TABLES, SPECS, TableSpec
from airledger.session import MAX_RECORDS_PER_FILE, ROWS_PER_PIECE
from airledger.sources.files import (
    child_files,
    child_folders,
    delete_path,
    path_exists,
    publish_text,
    read_json_document,
)

KEPT_VERSIONS = 3
_LOAD = "load"
_PIECE = "_piece"
_SWITCH = re.compile(r"_months-(\d{8})\.json")


class Warehouse:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    # -- reading ---------------------------------------------------------------------

    def path(self, spec: TableSpec) -> str:
        return f"{self.root}/{ANALYST}/{spec.name}"

    def _versions(self, spec: TableSpec) -> list[str]:
        base = self.path(spec)
        return [
            f"{base}/{name}"
            for name in child_folders(self.spark, base)
            if name.startswith("version=") and path_exists(self.spark, f"{base}/{name}/_SUCCESS")
        ]

    def _switches(self, spec: TableSpec) -> list[int]:
        found = (_SWITCH.fullmatch(n) for n in child_files(self.spark, self.path(spec)))
        return sorted(int(m[1]) for m in found if m)

    def _switch_path(self, spec: TableSpec, number: int) -> str:
        return f"{self.path(spec)}/_months-{number:08d}.json"

    def _months(self, spec: TableSpec, number: int | None = None) -> dict[int, int]:
        """The load that holds each month, now or after switch ``number``."""
        if number is None:
            switches = self._switches(spec)
            if not switches:
                return {}
            number = switches[-1]
        listed = read_json_document(self.spark, self._switch_path(spec, number))
        return {int(month): load for month, load in listed.items()}

    def exists(self, spec: TableSpec) -> bool:
        return bool(self._switches(spec) if spec.partitioned else self._versions(spec))

    def physical(self, spec: TableSpec) -> DataFrame:
        """Stored columns, with the partition column for partitioned tables."""
        if spec.partitioned:
            return self._physical_months(spec)
        if not self.exists(spec):
            return self.spark.createDataFrame([], spec.stored)
        return self.spark.read.schema(spec.stored).parquet(self._versions(spec)[-1])

    def _physical_months(self, spec: TableSpec) -> DataFrame:
        """The current load of each month; others are left out as partitions."""
        month = T.StructField(PARTITION_COLUMN, T.IntegerType())
        schema = T.StructType([*spec.stored.fields, month])
        months = self._months(spec)
        if not months:
            return self.spark.createDataFrame([], schema)
        base = self.path(spec)
        loads = [f"{base}/{_LOAD}={n:08d}" for n in sorted(set(months.values()))]
        stored = T.StructType([*spec.stored.fields, T.StructField(_LOAD, T.LongType()), month])
        place = F.col(_LOAD) * 1_000_000 + F.col(PARTITION_COLUMN)
        current = [load * 1_000_000 + m for m, load in months.items()]
        return (
            self.spark.read.schema(stored)
            .option("basePath", base)
            .parquet(*loads)
            .where(place.isin(current))
            .drop(_LOAD)
        )

    def table(self, spec: TableSpec) -> DataFrame:
        """Logical columns. Partition pruning still works through ``physical``."""
        return self.physical(spec).select(*spec.columns)

    # -- writing ---------------------------------------------------------------------

    def upsert(self, spec: TableSpec, delta: DataFrame, *, keep_absent: bool = False) -> None:
        """Replace rows by key and insert new ones.

        Repeated keys inside the delta are an error, and so are references to rows that the
        parent tables don't have. ``delta`` is read more than once: hand in a stored or staged
        frame.
        """
        require_known_columns(delta, spec)
        require_unique(delta, spec.primary_key, spec.name)
        self.require_parents(spec, delta)
        if spec.partitioned:
            self._upsert_months(spec, delta, keep_absent)
        else:
            current = self.physical(spec) if self.exists(spec) else None
            self.write_version(spec, fold_delta(current, delta, spec, keep_absent=keep_absent))

    def require_parents(self, spec: TableSpec, rows: DataFrame) -> None:
        parents = {parent: self.table(SPECS[parent]) for _, _, parent, _ in keys_of(spec.name)}
        require_parents(spec.name, rows, parents)

    def _upsert_months(self, spec: TableSpec, delta: DataFrame, keep_absent: bool) -> None:
        if PARTITION_COLUMN not in delta.columns:
            raise ValueError(f"{spec.name} delta lacks {PARTITION_COLUMN}")
        sizes = _rows_by_month(delta)
        touched = list(sizes)
        if not touched:
            return
        if self.exists(spec):
            current = self.physical(spec).where(F.col(PARTITION_COLUMN).isin(touched))
            for month, count in _rows_by_month(current).items():
                sizes[month] += count
            rows = replace_delta(current, delta, spec, keep_absent=keep_absent)
        else:
            rows = normalise(delta, spec)
        number = self._next_load(spec)
        self._write_load(spec, rows, number, sizes)
        months = {**self._months(spec), **dict.fromkeys(touched, number)}
        self._switch(spec, months, number)

    def _next_load(self, spec: TableSpec) -> int:
        loads = [
            int(name.split("=")[1])
            for name in child_folders(self.spark, self.path(spec))
            if name.startswith(f"{_LOAD}=")
        ]
        return 1 + max([*loads, *self._switches(spec)], default=0)

    def _write_load(
        self,
        spec: TableSpec,
        rows: DataFrame,
        number: int,
        sizes: dict[int, int] | None = None,
    ) -> None:
        """Rebalancing by month and piece spreads a large month over many tasks and joins small
        ones, from the sizes of one shuffle: the merge runs once. ``sizes`` says about
        how many rows a month has; months not in it are one piece."""
        (
            rows.withColumn(_PIECE, _piece(spec, sizes or {}))
            .hint("rebalance", PARTITION_COLUMN, _PIECE)
            .sortWithinPartitions(PARTITION_COLUMN, *spec.primary_key)
            .drop(_PIECE)
            .write.mode("error")
            .option("compression", "zstd")
            .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
            .partitionBy(PARTITION_COLUMN)
            .parquet(f"{self.path(spec)}/{_LOAD}={number:08d}")
        )

    def _switch(self, spec: TableSpec, months: dict[int, int], number: int) -> None:
        """Make ``months`` the current state, then delete what no kept state refers to."""
        base = self.path(spec)
        listed = {str(month): load for month, load in sorted(months.items())}
        publish_text(self.spark, self._switch_path(spec, number), json.dumps(listed))
        switches = self._switches(spec)
        kept = switches[-KEPT_VERSIONS:]
        wanted = {(load, m) for n in kept for m, load in self._months(spec, n).items()}
        for name in child_folders(self.spark, base):
            load = int(name.split("=")[1]) if name.startswith(f"{_LOAD}=") else None
            if load is None or load > number:
                continue
            held = child_folders(self.spark, f"{base}/{name}")
            stale = [m for m in held if (load, int(m.split("=")[1])) not in wanted]
            for folder in [name] if len(stale) == len(held) else [f"{name}/{m}" for m in stale]:
                delete_path(self.spark, f"{base}/{folder}")
        for old in switches[:-KEPT_VERSIONS]:
            delete_path(self.spark, self._switch_path(spec, old))

    def write_version(self, spec: TableSpec, rows: DataFrame) -> None:
        if spec.partitioned:
            raise ValueError(f"{spec.name} is partitioned and has no versions")
        base = self.path(spec)
        finished = self._versions(spec)
        taken = [n for n in child_folders(self.spark, base) if n.startswith("version=")]
        number = 1 + max((int(n.split("=")[1]) for n in taken), default=0)
        # Rebalancing gives small tables one file and needs no sampling pass.
        (
            rows.select(*spec.columns)
            .hint("rebalance")
            .sortWithinPartitions(*spec.primary_key)
            .write.mode("error")
            .option("compression", "zstd")
            .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
            .parquet(f"{base}/version={number:08d}")
        )
        for stale in finished[: -(KEPT_VERSIONS - 1)]:
            delete_path(self.spark, stale)

    def insert_ignore(self, spec: TableSpec, rows: DataFrame) -> None:
        """Add rows with unseen keys; existing rows stay exactly as they are."""
        incoming = normalise(rows, spec).dropDuplicates(list(spec.primary_key))
        if self.exists(spec):
            current = self.table(spec)
            incoming = current.unionByName(new_rows(current, incoming, spec.primary_key))
        self.write_version(spec, incoming)

    # -- monitoring ------------------------------------------------------------------

    def monitoring_path(self, name: str) -> str:
        return f"{self.root}/{MONITORING}/{name}"

    def monitoring(self, name: str) -> DataFrame:
        schema = MONITORING_TABLES[name]
        path = self.monitoring_path(name)
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def append(self, name: str, rows: DataFrame) -> None:
        schema = MONITORING_TABLES[name]
        rows.select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]
        ).write.mode("append").parquet(self.monitoring_path(name))

    def start_run(self, run_type: str, now: datetime | None = None) -> int:
        top = self.monitoring("etl_runs").agg(F.max("etl_run_id")).first()[0]
        run_id = (top or 0) + 1
        self._record_run(run_id, run_type, "running", _moment(now), None, 0, 0, 0, None)
        return run_id

    def complete_run(
        self,
        run_id: int,
        status: str,
        *,
        inserted: int = 0,
        updated: int = 0,
        skipped: int = 0,
        error_summary: str | None = None,
        now: datetime | None = None,
    ) -> None:
        """Append the closing record; an unknown run id is ignored."""
        opened = self.monitoring("etl_runs").where(F.col("etl_run_id") == run_id).first()
        if opened is None:
            return
        self._record_run(
            run_id, opened.run_type, status, opened.started_at, _moment(now),
            inserted, updated, skipped, error_summary,
        )

    def _record_run(self, *values) -> None:
        row = self.spark.createDataFrame([tuple(values)], MONITORING_TABLES["etl_runs"])
        self.append("etl_runs", row.coalesce(1))

    def log(
        self,
        run_id: int | None,
        level: str,
        event: str,
        message: str,
        context: dict[str, str] | None = None,
        now: datetime | None = None,
    ) -> None:
        row = (run_id, level, event, message, context or {}, _moment(now))
        frame = self.spark.createDataFrame([row], MONITORING_TABLES["etl_logs"])
        self.append("etl_logs", frame.coalesce(1))


def _rows_by_month(rows: DataFrame) -> dict[int, int]:
    """At most twelve entries a year, whatever the number of rows."""
    counts = rows.groupBy(PARTITION_COLUMN).agg(F.count(F.lit(1)))
    return {month: count for month, count in counts.collect()}


def _piece(spec: TableSpec, sizes: dict[int, int]) -> Column:
    """The piece of its month that a row is written in: as many as the month's rows need."""
    pieces = {m: -(-n // ROWS_PER_PIECE) for m, n in sizes.items() if n > ROWS_PER_PIECE}
    if not pieces:
        return F.lit(0).cast("long")
    listed = F.create_map(*[F.lit(x) for pair in pieces.items() for x in pair])
    number = F.coalesce(F.try_element_at(listed, F.col(PARTITION_COLUMN)), F.lit(1))
    return F.pmod(F.xxhash64(*spec.primary_key), number.cast("long"))


def _moment(now: datetime | None) -> datetime:
    return datetime.now(timezone.utc) if now is None else now
