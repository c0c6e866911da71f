"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from airledger.sources.files import delete_path

# Files are hashed whole, so both formats stay around a hundred megabytes per file.
MAX_RECORDS_PER_FILE = 2_000_000
MAX_RECORDS_PER_CSV = 500_000
# One task sorts and writes about so many rows of a month.
ROWS_PER_PIECE = 200_000

# Suitable starting points for a cluster. AQE coalesces the many initial shuffle partitions
# down to the advisory size and splits skewed ones; broadcast joins stay behind Spark's own
# size threshold, so no operator in this package forces one.
CLUSTER_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def cluster_builder(app_name: str = "airledger") -> SparkSession.Builder:
    builder = SparkSession.builder.appName(app_name)
    for key, value in CLUSTER_DEFAULTS.items():
        builder = builder.config(key, value)
    return builder


Item = TypeVar("Item")
Result = TypeVar("Result")


def side_by_side(
    spark: SparkSession, work: Callable[[Item], Result], items: Iterable[Item]
) -> list[Result]:
    """Submit the Spark jobs of independent items together; results keep their order.

    Small tables then do not hold the cluster up while a large one is written.
    """
    todo = list(items)
    with ThreadPoolExecutor(max_workers=max(1, len(todo))) as pool:
        return list(pool.map(inheritable_thread_target(spark)(work), todo))


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a session without ``spark.checkpoint.dir`` (tests, one machine) gets a folder of
    its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    created = tempfile.mkdtemp(prefix="airledger-")
    spark.conf.set("spark.checkpoint.dir", created)
    return created


def fresh_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


class Staging:
    """Tables written once to the shared folder and read back, so lineage ends there.

    Later passes read only the columns they need, and a lost executor costs a re-read
    instead of a recomputation.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        self.root = fresh_folder(spark, label)

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("error").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


@contextmanager
def staging(spark: SparkSession, label: str) -> Iterator[Staging]:
    area = Staging(spark, label)
    try:
        yield area
    finally:
        delete_path(spark, area.root)
