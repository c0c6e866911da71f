"""Small landing documents and warehouses for tests."""

import json
from datetime import date, timedelta

from airledger.plans.etl import ensure_dates, seed_districts
from airledger.schemas import DIM_DISTRICT
from airledger.sinks.warehouse import Warehouse
from airledger.sources.landing import LANDING_SCHEMA

DISTRICTS = [
    (1, "North", 21.0, 105.8),
    (2, "South", 20.9, 105.7),
    (3, "East", 21.1, 105.9),
]


def district_frame(spark, rows=DISTRICTS):
    return spark.createDataFrame(rows, DIM_DISTRICT.stored)


def new_warehouse(spark, root, start=date(2024, 1, 1), end=date(2024, 3, 31)):
    warehouse = Warehouse(spark, str(root))
    seed_districts(warehouse, district_frame(spark))
    ensure_dates(warehouse, start, end)
    return warehouse


def daily_body(days, **series):
    return {"daily": {"time": [d.isoformat() for d in days], **series}}


def hourly_body(times, **series):
    return {"hourly": {"time": times, **series}}


def hours_of(day, count=24):
    return [f"{day.isoformat()}T{h:02d}:00" for h in range(count)]


def landing(spark, *documents):
    """documents: (doc_id, feed, district ids, start, end, body object or text)."""
    rows = [
        (name, feed, ids, start, end, body if isinstance(body, str) else json.dumps(body))
        for name, feed, ids, start, end, body in documents
    ]
    return spark.createDataFrame(rows, LANDING_SCHEMA)


def days(start, count):
    return [start + timedelta(days=i) for i in range(count)]


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())
