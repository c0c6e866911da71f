"""Release files: tables, manifest, current aliases and the pointer to the latest release."""

from __future__ import annotations

import json
from datetime import datetime, timezone
from functools import reduce
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airledger.functions.paths import release_id as release_id_of
from airledger.operators.merge import PARTITION_COLUMN
from airledger.operators.quality import require_empty
from airledger.operators.snapshot import (
    KEPT_RELEASES,
    REFERENCE_SCHEMA,
    deletable_folders,
    deletable_releases,
)
from airledger.schemas import ANALYST, LOCAL_ZONE, TABLE_SPECS, TableSpec
from airledger.session import MAX_RECORDS_PER_CSV, MAX_RECORDS_PER_FILE, side_by_side
from airledger.sources.files import (
    checksum_files,
    child_folders,
    delete_path,
    list_files,
    move_path,
    path_exists,
    read_json_document,
    set_digest,
    write_text,
)
from airledger.sources.tables import CSV_TIMESTAMP, conform

LATEST = "v1/latest.json"
RELEASES = "v1/releases"
CURRENT = f"v1/current/{ANALYST}"
SCHEMA_VERSION = 1
INVENTORY_SCHEMA = (
    "name string, format string, file string, length bigint, sha256 string, release_id string"
)


def release_key(release_id: str, name: str, suffix: str) -> str:
    return f"{RELEASES}/{release_id}/{ANALYST}/{name}.{suffix}"


def _by_key(df: DataFrame, spec: TableSpec) -> tuple[DataFrame, list[str]]:
    """Rows dealt out by ranges of their key, sorted, with the partition column if they have it.

    Parts are then key ranges in key order, and no task gets a whole table. ``df`` is read
    twice, once for the ranges: hand in stored rows.
    """
    months = [PARTITION_COLUMN] if PARTITION_COLUMN in df.columns else []
    order = [*months, *spec.primary_key]
    rows = df.select(*spec.columns, *months).repartitionByRange(*order)
    return rows.sortWithinPartitions(*order), months


def write_parquet(df: DataFrame, spec: TableSpec, path: str) -> None:
    rows, months = _by_key(df, spec)
    (
        rows.write.option("compression", "zstd")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy(*months)
        .parquet(path)
    )


def write_csv(df: DataFrame, spec: TableSpec, path: str) -> None:
    """UTF-8 with a header, null as an empty field, ISO times in UTC."""
    rows, months = _by_key(df, spec)
    (
        rows.write.option("header", "true")
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("timeZone", "UTC")
        .option("timestampFormat", CSV_TIMESTAMP)
        .option("maxRecordsPerFile", MAX_RECORDS_PER_CSV)
        .partitionBy(*months)
        .csv(path)
    )


def file_inventory(spark: SparkSession, *folders: str) -> DataFrame:
    """Name, format, file, length, SHA-256 and release of every table file below ``folders``."""
    pattern = r"([^/]+)\.(parquet|csv)/((?:[^/]+/)?[^/]+)$"
    return checksum_files(spark, *folders).select(
        F.regexp_extract("path", pattern, 1).alias("name"),
        F.regexp_extract("path", pattern, 2).alias("format"),
        F.regexp_extract("path", pattern, 3).alias("file"),
        "length",
        "sha256",
        release_id_of(F.col("path")).alias("release_id"),
    )


def inventory_totals(inventory: DataFrame) -> DataFrame:
    """Bytes and order-independent digest per table and format."""
    return inventory.groupBy("name", "format").agg(
        F.sum("length").alias("bytes"), set_digest(F.col("sha256")).alias("sha256")
    )


def _mark(column: str, kind: str) -> Column:
    value = F.col(column)
    mark = F.when(value.isNull(), "n")
    if kind in ("float", "double"):
        mark = mark.when(value == 0, value.cast("string"))
    return mark.otherwise("v")


def row_digest(df: DataFrame, *keys: str) -> DataFrame:
    """Row count and two sums of row hashes by ``keys``: equal for equal rows in any order."""
    values = [c for c in df.columns if c not in keys]
    # A hash passes over nulls and the sign of a zero, so it is told of them.
    marks = F.concat(*[_mark(c, t) for c, t in df.select(*values).dtypes])
    sums = [
        F.sum(F.xxhash64(F.lit(salt), marks, *values).cast("decimal(38,0)")).alias(salt)
        for salt in ("first", "second")
    ]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), *sums)


def csv_text(spark: SparkSession, folder: str, spec: TableSpec) -> DataFrame:
    """The fields of released CSV as they are written."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in spec.columns])
    return spark.read.schema(schema).option("header", "true").csv(folder)


def csv_digest(spark: SparkSession, folder: str, spec: TableSpec) -> tuple:
    return tuple(row_digest(csv_text(spark, folder, spec).select(*spec.columns)).first())


def _times(moment: datetime) -> tuple[str, str]:
    utc = moment.astimezone(timezone.utc)
    return utc.isoformat(), utc.astimezone(ZoneInfo(LOCAL_ZONE)).isoformat()


def build_manifest(
    release_id: str,
    source: str,
    moment: datetime,
    stats: list,
    totals: list,
    months: dict[str, dict] | None = None,
) -> dict:
    """``stats``: one row per table; ``totals``: one row per table and format; ``months``: for
    partitioned tables, which release holds each month, with its rows and dates."""
    size = {(t.name, t.format): t for t in totals}
    utc, local = _times(moment)
    tables = {}
    for row in stats:
        parquet, csv = size[row.name, "parquet"], size[row.name, "csv"]
        tables[row.name] = {
            "name": row.name,
            "row_count": row.row_count,
            "parquet_key": release_key(release_id, row.name, "parquet"),
            "parquet_bytes": parquet.bytes,
            "parquet_sha256": parquet.sha256,
            "csv_key": release_key(release_id, row.name, "csv"),
            "csv_bytes": csv.bytes,
            "csv_sha256": csv.sha256,
            "min_date": row.min_date,
            "max_date": row.max_date,
        }
        if months and months.get(row.name):
            tables[row.name]["months"] = months[row.name]
    return {
        "schema_version": SCHEMA_VERSION,
        "release_id": release_id,
        "source": source,
        "generated_at_utc": utc,
        "generated_at_vietnam": local,
        "tables": tables,
    }


def parts_by_release(release_id: str, months: dict[str, dict] | None) -> dict[str, list[str] | None]:
    """Releases that hold a table's files, with the months taken from each; None for all."""
    if not months:
        return {release_id: None}
    held: dict[str, list[str]] = {}
    for month, part in months.items():
        held.setdefault(part["release_id"], []).append(month)
    return held


def references(manifest: dict) -> list[tuple[str, str, str]]:
    """(release, table, month) of all a manifest's files; no month for undivided tables."""
    return [
        (holder, name, month)
        for name, entry in manifest["tables"].items()
        for holder, months in parts_by_release(
            manifest["release_id"], entry.get("months")
        ).items()
        for month in months or [""]
    ]


def to_json(document: dict) -> str:
    return json.dumps(document, ensure_ascii=False, indent=2, sort_keys=True)


class ReleaseStore:
    """A folder holding releases, their current CSV aliases and the latest pointer."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def at(self, key: str) -> str:
        return f"{self.root}/{key}"

    def inventory_path(self, release_id: str) -> str:
        return self.at(f"{RELEASES}/{release_id}/inventory")

    def read_latest(self) -> tuple[dict, dict] | None:
        """(pointer, manifest) of the active release, or None before the first one."""
        if not path_exists(self.spark, self.at(LATEST)):
            return None
        pointer = read_json_document(self.spark, self.at(LATEST))
        return pointer, read_json_document(self.spark, self.at(pointer["manifest_key"]))

    def read_manifest(self, release_id: str) -> dict:
        return read_json_document(self.spark, self.at(f"{RELEASES}/{release_id}/manifest.json"))

    def _parts(
        self, manifest: dict, spec: TableSpec, suffix: str, only: list[str] | None = None
    ) -> list[tuple[str, list[str] | None]]:
        """Folders that hold a table, with the months to take from each."""
        entry = manifest["tables"][spec.name]
        held = parts_by_release(manifest["release_id"], entry.get("months"))
        if only is not None:
            held = {r: [m for m in months if m in only] for r, months in held.items() if months}
        return [
            (self.at(release_key(release, spec.name, suffix)), months)
            for release, months in sorted(held.items())
            if months is None or months
        ]

    def snapshot(
        self, manifest: dict, spec: TableSpec, only: list[str] | None = None
    ) -> DataFrame | None:
        """A released table, put together from the releases that hold its months, with
        ``month_key`` for partitioned ones; ``only`` some months, none of the others is listed."""
        frames = []
        for folder, months in self._parts(manifest, spec, "parquet", only):
            rows = self.spark.read.parquet(folder)
            if months is not None:
                rows = rows.where(F.col(PARTITION_COLUMN).isin([int(m) for m in months]))
            kept = [PARTITION_COLUMN] if months is not None else []
            frames.append(
                conform(rows, T.StructType([*spec.released, *[rows.schema[c] for c in kept]]))
            )
        return reduce(DataFrame.unionByName, frames) if frames else None

    def _csv_rows(self, manifest: dict, spec: TableSpec, only: list[str] | None) -> DataFrame:
        frames = []
        for folder, months in self._parts(manifest, spec, "csv", only):
            rows = csv_text(self.spark, folder, spec)
            if months is not None:
                rows = rows.where(F.col(PARTITION_COLUMN).isin([int(m) for m in months]))
            frames.append(rows)
        return reduce(DataFrame.unionByName, frames)

    def record_inventory(self, release_id: str) -> None:
        """Hash the release's own files once and keep the result with the release."""
        folder = self.at(f"{RELEASES}/{release_id}/{ANALYST}")
        found = file_inventory(self.spark, folder).withColumn("release_id", F.lit(release_id))
        found.write.parquet(self.inventory_path(release_id))

    def _referred(self, files: DataFrame, manifest: dict) -> DataFrame:
        wanted = self.spark.createDataFrame(references(manifest), REFERENCE_SCHEMA)
        month = F.regexp_extract("file", rf"^{PARTITION_COLUMN}=(\d+)/", 1)
        return files.withColumn("month", month).join(
            wanted, ["release_id", "name", "month"], "left_semi"
        )

    def recorded_files(self, manifest: dict) -> DataFrame:
        """What the releases a manifest refers to recorded of the files it refers to."""
        holders = sorted({r for r, _, _ in references(manifest)})
        recorded = self.spark.read.schema(INVENTORY_SCHEMA).parquet(
            *[self.inventory_path(r) for r in holders]
        )
        return self._referred(recorded, manifest)

    def found_files(self, manifest: dict) -> DataFrame:
        """The files a manifest refers to as they are now."""
        folders = [
            self.at(release_key(holder, name, suffix)) + (f"/{PARTITION_COLUMN}={m}" if m else "")
            for holder, name, m in references(manifest)
            for suffix in ("parquet", "csv")
        ]
        there = [f for f in folders if path_exists(self.spark, f)]
        return self._referred(file_inventory(self.spark, *there), manifest)

    def findings(self, manifest: dict) -> DataFrame:
        """Files of a release that are missing, unexpected or changed since they were recorded."""
        return file_mismatches(self.recorded_files(manifest), self.found_files(manifest))

    def activate(self, manifest: dict, moment: datetime, replaces: str | None) -> None:
        """Manifest, new copies aside, the pointer, and the copies put in place.

        ``replaces`` is the release id that was active when building began; if another
        release has been activated since, neither pointer nor copies are touched. Copies that
        are not in place when the driver stops are put there by ``refresh_aliases``.
        """
        release_id = manifest["release_id"]
        manifest_key = f"{RELEASES}/{release_id}/manifest.json"
        write_text(self.spark, self.at(manifest_key), to_json(manifest))
        if read_json_document(self.spark, self.at(manifest_key)) != manifest:
            raise RuntimeError("manifest verification failed")
        self._require_active(replaces)
        copies = self._copies_aside(manifest)
        self._require_active(replaces)
        utc, local = _times(moment)
        pointer = {
            "schema_version": SCHEMA_VERSION,
            "release_id": release_id,
            "manifest_key": manifest_key,
            "published_at_utc": utc,
            "published_at_vietnam": local,
        }
        write_text(self.spark, self.at(LATEST), to_json(pointer))
        self._place_copies(manifest, copies)
        self.prune(release_id)

    def _require_active(self, expected: str | None) -> None:
        latest = self.read_latest()
        if (latest[0]["release_id"] if latest else None) != expected:
            raise RuntimeError("another release was activated meanwhile")

    def refresh_aliases(self, manifest: dict) -> None:
        """Bring the stable CSV copies up to a release, then check them."""
        self._place_copies(manifest, self._copies_aside(manifest))
        self.verify_aliases(manifest)

    def _mark(self, spec: TableSpec) -> dict | None:
        path = self.at(f"{CURRENT}/{spec.name}.json")
        return read_json_document(self.spark, path) if path_exists(self.spark, path) else None

    def _outdated(self, manifest: dict, spec: TableSpec) -> list[str] | None:
        """Months whose copy isn't of this manifest's release; None for undivided tables."""
        months = manifest["tables"][spec.name].get("months")
        if not months:
            return None
        mark = self._mark(spec) or {}
        held = mark.get("months", {})
        return [m for m, part in months.items() if held.get(m) != part["release_id"]]

    def _copies_aside(self, manifest: dict) -> dict[str, list[str] | None]:
        """Write the copies that have to change beside the current ones, and check them."""
        aside = self.at(f"{CURRENT}-{manifest['release_id']}")
        delete_path(self.spark, aside)
        published = [s for s in TABLE_SPECS if s.name in manifest["tables"]]
        outdated = {s.name: self._outdated(manifest, s) for s in published}

        def copy(spec: TableSpec) -> None:
            only = outdated[spec.name]
            if only == []:
                return
            folder = f"{aside}/{spec.name}.csv"
            write_csv(self.snapshot(manifest, spec, only), spec, folder)
            self._require_same(manifest, spec, folder, only)

        side_by_side(self.spark, copy, published)
        return outdated

    def _place_copies(self, manifest: dict, copies: dict[str, list[str] | None]) -> None:
        aside = self.at(f"{CURRENT}-{manifest['release_id']}")
        for name, months in copies.items():
            entry = manifest["tables"][name]
            goal = self.at(f"{CURRENT}/{name}.csv")
            if months is None:
                move_path(self.spark, f"{aside}/{name}.csv", goal)
            for month in months or []:
                part = f"{PARTITION_COLUMN}={month}"
                move_path(self.spark, f"{aside}/{name}.csv/{part}", f"{goal}/{part}")
            mark = {"release-id": manifest["release_id"], "sha256": entry["csv_sha256"]}
            if months is not None:
                mark["months"] = {m: p["release_id"] for m, p in entry["months"].items()}
            write_text(self.spark, self.at(f"{CURRENT}/{name}.json"), to_json(mark))
        delete_path(self.spark, aside)

    def _require_same(
        self, manifest: dict, spec: TableSpec, folder: str, only: list[str] | None
    ) -> None:
        """Text for text the released rows, month by month.

        Where a file ends follows the cluster's parallelism at the time, so a copy may be cut
        into other parts than the released CSV. One digest a month reaches the driver.
        """
        keys = [] if only is None else [PARTITION_COLUMN]
        released = row_digest(self._csv_rows(manifest, spec, only), *keys).collect()
        copied = row_digest(csv_text(self.spark, folder, spec), *keys).collect()
        if set(released) != set(copied):
            raise RuntimeError(f"the current copy of {spec.name} is not the released one")

    def verify_aliases(self, manifest: dict) -> None:
        """Each copy must name this release and hold its rows, text for text."""

        def check(spec: TableSpec) -> None:
            entry = manifest["tables"][spec.name]
            mark = self._mark(spec) or {}
            named = (mark.get("release-id"), mark.get("sha256"))
            if named != (manifest["release_id"], entry["csv_sha256"]):
                raise RuntimeError(f"the current copy of {spec.name} is not the released one")
            months = entry.get("months")
            folder = self.at(f"{CURRENT}/{spec.name}.csv")
            self._require_same(manifest, spec, folder, list(months) if months else None)

        published = [s for s in TABLE_SPECS if s.name in manifest["tables"]]
        side_by_side(self.spark, check, published)

    def verify(self, manifest: dict) -> None:
        """Re-hash every file of a release and its aliases against what was recorded."""
        require_empty(
            self.findings(manifest), "release files differ from their recorded checksums"
        )
        for total in inventory_totals(self.recorded_files(manifest)).collect():
            entry = manifest["tables"][total.name]
            if (
                entry[f"{total.format}_bytes"] != total.bytes
                or entry[f"{total.format}_sha256"] != total.sha256
            ):
                raise RuntimeError(f"object verification failed for {total.name}")
        self.verify_aliases(manifest)

    def prune(self, active: str, keep: int = KEPT_RELEASES) -> list[str]:
        """Delete releases beyond retention, but for the months that kept ones refer to.

        Only ids and folder names reach the driver. Of a release that is still referred to,
        the inventory stays, by which its months are verified.
        """
        listing = list_files(self.spark, self.at(RELEASES))
        given_up = [r.release_id for r in deletable_releases(listing, active, keep).collect()]
        kept = [
            self.read_manifest(name)
            for name in child_folders(self.spark, self.at(RELEASES))
            if name not in given_up
            and path_exists(self.spark, self.at(f"{RELEASES}/{name}/manifest.json"))
        ]
        wanted = [r for manifest in kept if manifest for r in references(manifest)]
        needed = {release for release, _, _ in wanted}.intersection(given_up)
        stale = []
        if needed:
            referred = self.spark.createDataFrame(wanted, REFERENCE_SCHEMA)
            found = deletable_folders(listing, active, keep, referred)
            stale = found.where(F.col("release_id").isin(sorted(needed))).collect()
        for release_id in given_up:
            if release_id not in needed:
                delete_path(self.spark, self.at(f"{RELEASES}/{release_id}"))
            else:
                delete_path(self.spark, self.at(f"{RELEASES}/{release_id}/manifest.json"))
        for row in stale:
            delete_path(self.spark, self.at(f"{RELEASES}/{row.release_id}/{ANALYST}/{row.folder}"))
        return given_up


def file_mismatches(recorded: DataFrame, found: DataFrame) -> DataFrame:
    """(name, format, file, problem) of files on one side only, or whose length or checksum
    differ."""
    key = ["name", "format", "file"]
    left = recorded.select(*key, F.col("length").alias("_l"), F.col("sha256").alias("_s"))
    right = found.select(*key, "length", "sha256")
    problem = (
        F.when(F.col("sha256").isNull(), F.lit("missing"))
        .when(F.col("_s").isNull(), F.lit("unexpected"))
        .when((F.col("_l") != F.col("length")) | (F.col("_s") != F.col("sha256")), F.lit("changed"))
    )
    return (
        left.join(right, key, "full_outer")
        .select(*key, problem.alias("problem"))
        .where("problem IS NOT NULL")
    )
