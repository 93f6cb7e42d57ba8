"""The scans of a data folder fed through the streaming jobs, for the registered queries."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.plans.refresh import Models, apply_batch, start_empty, throwaway
from waybill.schemas import RAW_EVENTS
from waybill.session import shared_folder
from waybill.sources import parcels
from waybill.sources.scratch import CODEC, staged
from waybill.streaming.jobs import Feed, dedup_feed, file_events, keep_current

#: Loads that the scans arrive in, each with labels of its own and times of the whole range.
LOADS = 4


def _stream_of(spark: SparkSession, folder: str, table: str) -> DataFrame:
    path = f"{folder}/{table}.parquet"
    schema: T.StructType = spark.read.parquet(path).schema
    # A pattern in the path lets the source take a single file as well as a folder of files.
    return spark.readStream.schema(schema).parquet(path[:-1] + f"[{path[-1]}]")


def replay(
    spark: SparkSession,
    folder: str,
    pick: Callable[[Models], DataFrame],
    with_ids: bool = False,
) -> DataFrame:
    """Feed the scans of a data folder through the stream and keep one of the resulting tables."""
    orders = parcels.table(spark, folder, "orders")
    scans = parcels.raw_events(orders, _stream_of(spark, folder, "lineitem"))
    with throwaway(spark) as models:
        start_empty(models, with_ids)
        batch_id = "labels" if with_ids else None
        apply_batch(models, label_rows=parcels.raw_labels(orders), batch_id=batch_id)
        checkpoint = f"{shared_folder(spark)}/waybill/{uuid.uuid4().hex}"
        keep_current(scans, models, checkpoint).awaitTermination()
        return staged(pick(models), "replay")


def replay_feed(
    spark: SparkSession, folder: str, apart: bool = False, remember: int | None = None
) -> Feed:
    """The deduplicated feed of a data folder whose scans arrive in loads out of time order.

    Loads go by order, or, with apart, by a hash of the columns beside the id, so that copies of an
    id come in different loads.
    """
    root = f"{shared_folder(spark)}/waybill/{uuid.uuid4().hex}"
    orders, lines = (parcels.table(spark, folder, name) for name in ("orders", "lineitem"))
    load = F.split("event_id", "_")[1].cast("long") % LOADS
    if apart:
        load = F.pmod(F.xxhash64(*[n for n in RAW_EVENTS.names if n != "event_id"]), F.lit(LOADS))
    scans = parcels.raw_events(orders, lines).withColumn("load", load.cast("int"))
    scans = staged(scans, "scans")
    feed = Feed(spark, f"{root}/feed")
    inbox, checkpoint = f"{root}/inbox", f"{root}/checkpoint"
    for number in range(LOADS):
        part = scans.where(F.col("load") == number).select(*RAW_EVENTS.names)
        part.write.mode("append").option("compression", CODEC).parquet(inbox)
        dedup_feed(file_events(spark, inbox), feed, checkpoint, remember=remember).awaitTermination()
    return feed
