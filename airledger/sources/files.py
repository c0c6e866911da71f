"""Files and folders on whatever file system Spark is configured for.

Only names and small control documents pass through the driver. Listings and checksums of
data files are Spark scans.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST_SCHEMA = (
    "schema_version int, release_id string, source string, generated_at_utc string, "
    "generated_at_vietnam string, tables map<string, struct<name: string, row_count: bigint, "
    "parquet_key: string, parquet_bytes: bigint, parquet_sha256: string, csv_key: string, "
    "csv_bytes: bigint, csv_sha256: string, min_date: string, max_date: string, "
    "months: map<string, struct<release_id: string, row_count: bigint, min_date: string, "
    "max_date: string>>>>"
)
JOB_REPORT_SCHEMA = (
    "job_id string, display_name string, status string, started_at_utc string, "
    "finished_at_utc string, started_at_vietnam string, finished_at_vietnam string, "
    "duration_seconds bigint"
)


def _locate(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _locate(spark, path)
    return fs.exists(target)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, target = _locate(spark, path)
    fs.delete(target, True)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    fs, target = _locate(spark, path)
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory())


def child_files(spark: SparkSession, path: str) -> list[str]:
    fs, target = _locate(spark, path)
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isFile())


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Put a folder in the place of another one."""
    fs, goal = _locate(spark, target)
    fs.mkdirs(goal.getParent())
    fs.delete(goal, True)
    if not fs.rename(_locate(spark, source)[1], goal):
        raise RuntimeError(f"{source} could not be moved to {target}")


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small document that must not exist yet; readers see all of it or nothing."""
    fs, target = _locate(spark, path)
    aside = f"{path}.tmp"
    write_text(spark, aside, text)
    if not fs.rename(_locate(spark, aside)[1], target):
        raise FileExistsError(path)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace one small control document."""
    fs, target = _locate(spark, path)
    out = fs.create(target, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _locate(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def read_json_document(spark: SparkSession, path: str) -> dict:
    return json.loads(read_text(spark, path))


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, length) of every file below ``root``; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", "length")
    )


def checksum_files(spark: SparkSession, *roots: str) -> DataFrame:
    """(path, length, sha256) of every data file below ``roots``, hashed on the executors.

    A file is hashed in one piece, so writers bound file size with ``maxRecordsPerFile``.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "part-*")
        .load(list(roots))
        .select("path", "length", F.sha2("content", 256).alias("sha256"))
    )


def set_digest(sha256: F.Column) -> F.Column:
    """Aggregate per-file SHA-256 values into one, independent of file order.

    The 32-bit words of the digests are added modulo 2^32, so that equal files don't cancel;
    sums combine on the map side and need no list of files in one place. With a single file
    the result is that file's own SHA-256. Which file holds what is for ``file_mismatches``.
    """
    words = [
        F.sum(F.conv(F.substring(sha256, 1 + 8 * i, 8), 16, 10).cast("long")) % (1 << 32)
        for i in range(8)
    ]
    return F.concat(*[F.lpad(F.lower(F.hex(w)), 8, "0") for w in words])


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per table of a release manifest."""
    document = spark.read.schema(MANIFEST_SCHEMA).option("multiLine", "true").json(path)
    return document.select(
        "schema_version", "release_id", "source", "generated_at_utc", "generated_at_vietnam",
        F.explode(F.map_values("tables")).alias("table"),
    ).select(
        "schema_version", "release_id", "source", "generated_at_utc", "generated_at_vietnam",
        "table.*",
    )


def read_job_reports(spark: SparkSession, root: str) -> DataFrame:
    """Every job timing document below ``root``, oldest start first; others are ignored."""
    return (
        spark.read.schema(JOB_REPORT_SCHEMA)
        .option("multiLine", "true")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.json")
        .json(root)
        .where(F.col("job_id").isNotNull())
        .orderBy("started_at_utc")
    )
