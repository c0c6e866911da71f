"""Reading the corpus tables and staging what is read more than once."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airledger.session import Staging, fresh_folder

_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per application.

    The archive goes through the shared folder, so it works where the library is installed on
    the driver alone.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = Path(__file__).resolve().parents[1]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for path in sorted(top.rglob("*.py")):
            archive.write(path, path.relative_to(top.parent).as_posix())
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{fresh_folder(spark, 'code')}/{top.name}.zip")
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(packed.getvalue()))
    finally:
        out.close()
    context.addPyFile(target.toString())
    _shipped.add(context.applicationId)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes inside drop their shuffle files when they are done, instead of whenever the driver
    collects garbage: what is written needs them no more."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends, executors may be lost."""
    with freed_shuffles(df.sparkSession):
        return Staging(df.sparkSession, label).put(df, "rows")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """Key and text of documents, a null text being empty; other columns are left behind."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *more,
    )


def passing(docs: DataFrame, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work(docs)``, all columns but doc_id, text and n_chars being named by place meanwhile.

    So no column of ``docs`` can clash with one that ``work`` makes for itself, whatever it is
    called. Columns that ``work`` adds come last.
    """
    names = docs.columns
    own = ("doc_id", "text", "n_chars")
    inside = [c if c in own else f"passed{i}" for i, c in enumerate(names)]
    found = work(docs.toDF(*inside))
    added = [c for c in found.columns if c not in inside]
    return found.select(*inside, *added).toDF(*names, *added)
