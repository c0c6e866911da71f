"""Expressions over release file paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TABLE_FILE = r"/((\w+)\.(?:parquet|csv)(?:/month_key=(\d+))?)/[^/]+$"
_RELEASE_FILE = r"(?:^|/)v1/releases/(\d{8}T\d{6}Z)/.+"


def release_id(path: Column) -> Column:
    """Release id of a file below ``v1/releases/``; null when the path is malformed."""
    return F.nullif(F.regexp_extract(path, _RELEASE_FILE, 1), F.lit(""))


def table_folder(path: Column) -> Column:
    """Folder of a release that a table file lies in, with the month if it has one:
    ``name.format`` or ``name.format/month_key=YYYYMM``; null for other files."""
    return F.nullif(F.regexp_extract(path, _TABLE_FILE, 1), F.lit(""))


def table_part(path: Column) -> list[Column]:
    """``name`` and ``month`` of a table file; no month for undivided tables."""
    return [
        F.regexp_extract(path, _TABLE_FILE, 2).alias("name"),
        F.regexp_extract(path, _TABLE_FILE, 3).alias("month"),
    ]
