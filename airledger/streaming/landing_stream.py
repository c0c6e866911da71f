"""Picking up newly landed documents incrementally.

The daily run is a batch. This is the same load driven by a file stream that stops when it
has caught up, so a scheduler can start it at any interval and no document is read twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airledger.plans.etl import RUN_TYPES, feed_name, run_etl, split_run_type
from airledger.schemas import DIM_DISTRICT
from airledger.session import staging
from airledger.sinks.warehouse import Warehouse
from airledger.sources.landing import LANDING_SCHEMA


def load_new_documents(
    warehouse: Warehouse, landing_path: str, run_type: str, checkpoint: str
) -> None:
    """Load every document that landed since the last call, then return.

    A batch that is repeated after a failure upserts the same keys again, which changes
    nothing.
    """
    mode, kind = split_run_type(run_type)
    if run_type not in RUN_TYPES or mode == "forecast":
        raise ValueError("only archive feeds are picked up incrementally")
    feed = feed_name(mode, kind)

    def load(batch: DataFrame, _batch_id: int) -> None:
        with staging(warehouse.spark, "landed") as stage:
            documents = stage.put(batch.where(F.col("feed") == feed), "documents")
            span = documents.agg(F.min("start_date"), F.max("end_date")).first()
            if span[0] is None:
                return
            named = documents.select(F.explode("district_ids").alias("district_id")).distinct()
            districts = warehouse.table(DIM_DISTRICT).join(named, "district_id", "left_semi")
            run_etl(
                warehouse, documents, run_type,
                start=span[0], end=span[1], districts=districts,
            )

    stream = warehouse.spark.readStream.schema(LANDING_SCHEMA).parquet(landing_path)
    query = (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
