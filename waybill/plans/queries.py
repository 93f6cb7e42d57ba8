"""The registered queries: each operator run over whole tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill import session
from waybill.functions import flags
from waybill.functions import timestamps as times
from waybill.functions.payload import parse_payload as _parse_payload
from waybill.operators import gold, latest, partials, profile, quality, silver
from waybill.plans import refresh, replays
from waybill.schemas import DELIVERY_PERFORMANCE, RAW_EVENTS, RAW_LABELS
from waybill.sources import parcels
from waybill.sources.scratch import Scratch, scratch, staged
from waybill.sources.tables import (
    land,
    land_all,
    land_and_report,
    preview,
    with_ingestion,
)

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}

RUN_TS = dt.datetime(2024, 1, 1)
CUTOFF = "1998-07-01"


class Layers:
    """The layers over one data folder, composed lazily."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return parcels.table(self.spark, self.folder, name)

    @property
    def raw_labels(self) -> DataFrame:
        return parcels.raw_labels(self.table("orders"))

    @property
    def raw_events(self) -> DataFrame:
        return parcels.raw_events(self.table("orders"), self.table("lineitem"))

    @property
    def labels(self) -> DataFrame:
        return silver.silver_labels(self.raw_labels)

    @property
    def events(self) -> DataFrame:
        return silver.silver_events(self.raw_events, self.labels)

    @property
    def gold(self) -> DataFrame:
        return gold.delivery_performance(self.labels, self.events)

    def stored_raw(self, space: Scratch, later: str | None = None) -> tuple[DataFrame, DataFrame]:
        """Raw labels and events, each derived once and read back.

        With a cutoff each has a column `later`: whether a row came from then on.
        """
        tables = ((self.raw_labels, "last_updated_at"), (self.raw_events, "event_received_at"))
        if later is None:
            return tuple(space.write(rows, "raw") for rows, _ in tables)
        return tuple(
            space.write(rows.withColumn("later", F.col(time) >= later), "raw", ["later"]) for rows, time in tables
        )

    def stored_silver(self) -> tuple[DataFrame, DataFrame]:
        """Silver labels and events, each written once and read back."""
        labels = staged(self.labels, "silver_labels")
        return labels, staged(silver.silver_events(self.raw_events, labels), "silver_events")

    def stored(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """As `stored_silver`, and the mart."""
        labels, events = self.stored_silver()
        return labels, events, staged(gold.delivery_performance(labels, events), "gold")


def plain_times(df: DataFrame) -> DataFrame:
    """Instants as zone-less UTC times, as Parquet and other engines show them."""
    moved = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in moved}) if moved else df


def query(build: Callable[[Layers], DataFrame]) -> Query:
    @wraps(build)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        session.configure(spark)
        result = build(Layers(spark, folder))
        return plain_times(result.drop("inserted_at") if build.__name__ != "stamp" else result)

    REGISTRY[build.__name__] = run
    return run


# ---- Raw tables ----------------------------------------------------------------------


@query
def raw_labels(x: Layers) -> DataFrame:
    return x.raw_labels


@query
def raw_events(x: Layers) -> DataFrame:
    return x.raw_events


@query
def land_contract_labels(x: Layers) -> DataFrame:
    return quality.land_contract(x.raw_labels, RAW_LABELS)


@query
def land_contract_events(x: Layers) -> DataFrame:
    return quality.land_contract(x.raw_events, RAW_EVENTS)


@query
def ingestion_metadata(x: Layers) -> DataFrame:
    landed = with_ingestion(x.raw_events, "batch-1")
    return landed.groupBy("_ingestion_batch_id").agg(
        F.count("*").alias("rows"), F.count("_ingestion_timestamp").alias("timed")
    )


# ---- Latest row per key ----------------------------------------------------------------


@query
def collapse_latest(x: Layers) -> DataFrame:
    return silver.current_labels(x.raw_labels)


@query
def collapse_latest_users(x: Layers) -> DataFrame:
    return latest.collapse_latest(x.table("events"), ["user_id"], ["ts"], ["event_id"])


@query
def dedup_events(x: Layers) -> DataFrame:
    return latest.dedup_events(x.raw_events)


@query
def dedup_lineitem(x: Layers) -> DataFrame:
    return latest.collapse_latest(
        x.table("lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"]
    )


@query
def dedup_logical(x: Layers) -> DataFrame:
    return latest.dedup_logical(x.events)


@query
def logical_duplicates(x: Layers) -> DataFrame:
    return latest.logical_duplicates(x.events)


@query
def merge_latest(x: Layers) -> DataFrame:
    log = x.raw_labels
    old = silver.current_labels(log.where(F.col("last_updated_at") < CUTOFF))
    new = log.where(F.col("last_updated_at") >= CUTOFF)
    return latest.merge_latest(old, new, ["label_id"], ["last_updated_at"])


@query
def scd2(x: Layers) -> DataFrame:
    return latest.scd2(x.raw_labels, ["label_id"], "last_updated_at")


@query
def scd2_users(x: Layers) -> DataFrame:
    states = x.table("events").select("user_id", "ts", "event_type", "event_id")
    return latest.scd2(states, ["user_id"], "ts")


# ---- Flags and times ---------------------------------------------------------------------


@query
def flag_weight(x: Layers) -> DataFrame:
    flag = flags.flag_weight(F.col("weight_oz"))
    return x.raw_labels.select("label_id", "weight_oz", flag.alias("can_be_weight_fraud"))


@query
def flag_void(x: Layers) -> DataFrame:
    flag = flags.flag_void(F.col("voided_at"), F.col("label_created_at"))
    return x.raw_labels.select("label_id", "voided_at", flag.alias("can_be_void_fraud"))


@query
def flag_insurance(x: Layers) -> DataFrame:
    flag = flags.flag_insurance(F.col("declared_value_cents"))
    return x.raw_labels.select(
        "label_id", "declared_value_cents", flag.alias("can_be_insurance_anomaly")
    )


@query
def flag_missing_zip(x: Layers) -> DataFrame:
    flag = flags.flag_missing_zip(F.col("origin_zip"), F.col("dest_zip"))
    return x.raw_labels.select(
        "label_id", "origin_zip", "dest_zip", flag.alias("can_be_missing_zip")
    )


@query
def abbr_to_offset(x: Layers) -> DataFrame:
    zone = times.zone_name(F.col("event_at"))
    return (
        x.raw_events.withColumn("zone", zone)
        .where(F.col("zone") != "")
        .groupBy("zone", times.abbr_to_offset(F.col("zone")).alias("zone_offset"))
        .agg(F.count("*").alias("events"))
    )


@query
def normalize_event_at(x: Layers) -> DataFrame:
    return times.repair_times(x.raw_events).select("event_id", "event_at", "normalized_iso")


@query
def parse_event_at(x: Layers) -> DataFrame:
    return times.repair_times(x.raw_events).select("event_id", "event_at", "parsed_at")


@query
def parse_event_at_with_fallback(x: Layers) -> DataFrame:
    repaired = times.repair_times(x.raw_events, fallback="event_received_at")
    return repaired.select("event_id", "event_at", "parsed_at")


@query
def flag_malformed(x: Layers) -> DataFrame:
    return times.repair_times(x.raw_events).select("event_id", "event_at", "is_malformed_timestamp")


@query
def time_shapes(x: Layers) -> DataFrame:
    return profile.time_shapes(x.raw_events)


@query
def flag_missing_type(x: Layers) -> DataFrame:
    flag = flags.flag_missing_type(F.col("event_code"), F.col("event_type"))
    return x.raw_events.select("event_id", "label_id", flag.alias("is_missing_event_type"))


@query
def canonical_event_name(x: Layers) -> DataFrame:
    name = flags.canonical_event_name(F.col("event_code"), F.col("event_type"))
    return x.raw_events.select("event_id", "event_code", "event_type", name.alias("event_name"))


@query
def parse_payload(x: Layers) -> DataFrame:
    schema = T.StructType([T.StructField("k", T.LongType())])
    read = _parse_payload(x.table("events"), "props", schema)
    return read.select("event_id", F.col("payload.k").alias("k"), "is_unparsable_payload")


# ---- Silver ------------------------------------------------------------------------------


@query
def silver_labels(x: Layers) -> DataFrame:
    return x.labels


@query
def silver_events(x: Layers) -> DataFrame:
    return x.events


@query
def flag_on_voided(x: Layers) -> DataFrame:
    events = x.raw_events.select("event_id", "label_id")
    return silver.flag_on_voided(events, x.labels)


@query
def stamp(x: Layers) -> DataFrame:
    return silver.stamp(x.labels.select("label_id"), RUN_TS)


@query
def orphaned_events(x: Layers) -> DataFrame:
    labels, events = x.stored_silver()
    return silver.orphaned_events(events, labels).drop("detected_at")


@query
def drop_orphans(x: Layers) -> DataFrame:
    labels, events = x.stored_silver()
    return silver.drop_orphans(events, labels)


# ---- Gold --------------------------------------------------------------------------------


@query
def latest_delivery(x: Layers) -> DataFrame:
    return gold.latest_delivery(x.events)


@query
def delivery_performance(x: Layers) -> DataFrame:
    return x.gold


@query
def on_time_summary(x: Layers) -> DataFrame:
    return gold.on_time_summary(x.gold)


@query
def on_time_by_carrier(x: Layers) -> DataFrame:
    return gold.on_time_by(x.gold, ["carrier"])


@query
def on_time_by_carrier_service(x: Layers) -> DataFrame:
    return gold.on_time_by(x.gold, ["carrier", "service_class"])


@query
def on_time_rollup(x: Layers) -> DataFrame:
    return gold.on_time_rollup(x.gold, ["carrier", "service_class"])


@query
def days_late(x: Layers) -> DataFrame:
    return gold.with_days_late(x.gold).select("label_id", "actual_delivery_at", "days_late")


@query
def delivery_details(x: Layers) -> DataFrame:
    return gold.delivery_details(x.labels, x.events)


@query
def delay_analysis(x: Layers) -> DataFrame:
    return gold.delay_analysis(x.gold)


@query
def delay_clusters(x: Layers) -> DataFrame:
    return gold.delay_clusters(x.gold)


@query
def data_freshness(x: Layers) -> DataFrame:
    return gold.data_freshness(*x.stored_silver())


# ---- Profiles ----------------------------------------------------------------------------


@query
def dq_profile(x: Layers) -> DataFrame:
    labels, events = x.stored_silver()
    return profile.dq_profile(x.raw_labels, x.raw_events, labels, events)


@query
def out_of_order(x: Layers) -> DataFrame:
    return profile.out_of_order(x.stored_silver()[1])


@query
def arrival_latency(x: Layers) -> DataFrame:
    return profile.arrival_latency(x.events)


@query
def late_arrivals(x: Layers) -> DataFrame:
    labels, events = x.stored_silver()
    flagged = profile.late_arrivals(events, labels)
    return flagged.select("event_id", "label_id", "latency_seconds", "is_late_arrival")


@query
def sequence_completeness(x: Layers) -> DataFrame:
    return profile.sequence_completeness(x.labels, x.events)


@query
def stage_summary(x: Layers) -> DataFrame:
    return profile.stage_summary(profile.sequence_completeness(x.labels, x.events))


@query
def promise_audit(x: Layers) -> DataFrame:
    return profile.promise_audit(x.labels)


@query
def change_history(x: Layers) -> DataFrame:
    return profile.change_history(x.raw_labels)


@query
def void_profile(x: Layers) -> DataFrame:
    labels, events = x.stored_silver()
    return profile.void_profile(labels, events)


@query
def mix_check(x: Layers) -> DataFrame:
    return profile.mix_check(x.labels)


@query
def format_contract(x: Layers) -> DataFrame:
    return profile.format_contract(x.raw_labels)


# ---- Quality -----------------------------------------------------------------------------


@query
def unique(x: Layers) -> DataFrame:
    return quality.unique(x.raw_events, "event_id")


@query
def unique_orders(x: Layers) -> DataFrame:
    return quality.unique(x.table("orders"), "o_orderkey")


@query
def not_null(x: Layers) -> DataFrame:
    return quality.not_null(x.raw_labels, "dest_zip")


@query
def relationships(x: Layers) -> DataFrame:
    return quality.relationships(x.raw_events, "label_id", x.labels, "label_id")


@query
def relationships_orders(x: Layers) -> DataFrame:
    return quality.relationships(x.table("orders"), "o_custkey", x.table("customer"), "c_custkey")


@query
def accepted_values(x: Layers) -> DataFrame:
    return quality.accepted_values(x.table("events"), "event_type", ["click", "view", "purchase"])


@query
def model_tests(x: Layers) -> DataFrame:
    return quality.model_tests(*x.stored())


@query
def dq_gate(x: Layers) -> DataFrame:
    return quality.dq_gate(*x.stored())


@query
def idempotency_snapshot(x: Layers) -> DataFrame:
    return quality.idempotency_snapshot(x.gold)


@query
def parity(x: Layers) -> DataFrame:
    """The mart against a second build of it, from the delivery row kept per label."""
    labels, events, built = x.stored()
    deliveries = events.where(F.col("event_name") == "delivered")
    kept = latest.collapse_latest(
        deliveries.select("label_id", "event_id", "event_at"), ["label_id"], ["event_at"]
    ).select("label_id", F.col("event_at").alias("actual_delivery_at"))
    actual, promised = F.col("actual_delivery_at"), F.col("carrier_promised_delivery_at")
    other = (
        labels.join(kept, "label_id", "left")
        .withColumn("is_delivered", actual.isNotNull())
        .withColumn("is_delivered_on_time", actual.isNotNull() & (actual <= promised))
        .select(*DELIVERY_PERFORMANCE)
    )
    return quality.parity_summary(built, other)


@query
def parity_altered(x: Layers) -> DataFrame:
    """The mart against a copy in which one carrier's verdicts are turned around."""
    _, _, built = x.stored()
    turned = F.when(F.col("carrier") == "FEDEX", ~F.col("is_delivered_on_time"))
    verdict = F.coalesce(turned, F.col("is_delivered_on_time"))
    return quality.parity_summary(built, built.withColumn("is_delivered_on_time", verdict))


@query
def idempotency_two_builds(x: Layers) -> DataFrame:
    """Figures of the first build, and what differs in a second one from the same raw tables."""
    with scratch(x.spark) as space, refresh.throwaway(x.spark) as models:
        land_all(*x.stored_raw(space), models.names)
        first = staged(refresh.full_refresh(models).gold, "first")
        second = staged(refresh.full_refresh(models).gold, "second")
    rows = quality.idempotency_snapshot(first).unionByName(
        quality.parity_summary(first, second), allowMissingColumns=True
    )
    return rows.agg(*[F.max(c).alias(c) for c in rows.columns])


@query
def change_history_repeated(x: Layers) -> DataFrame:
    """A change log in which some images landed twice."""
    log = x.raw_labels
    return profile.change_history(log.unionByName(log.where("weight_oz % 3 = 0")))


@query
def appended_and_ignored(x: Layers) -> DataFrame:
    """Rows of the raw labels after landing, landing again with ignore, and appending."""
    rows = []
    with refresh.throwaway(x.spark) as models:
        table = models.names.raw_labels
        for mode in ("overwrite", "ignore", "append"):
            landed = land(x.raw_labels, table, RAW_LABELS, mode)
            rows.append((mode, landed, models.stored(table).count()))
    return x.spark.createDataFrame(rows, "mode string, landed bigint, stored bigint")


@query
def preview_events(x: Layers) -> DataFrame:
    return preview(x.table("events"), 10, ["ts", "event_id"]).select("event_id", "user_id")


# ---- Tables, incremental loads, streaming -------------------------------------------------


@query
def land_and_validate(x: Layers) -> DataFrame:
    """Land both raw tables, check them, report."""
    with refresh.throwaway(x.spark) as models:
        report = land_and_report(x.raw_labels, x.raw_events, models.names)
    rows = [(name, report[f"{name}_count"], report["status"]) for name in ("labels", "events")]
    return x.spark.createDataFrame(rows, "landed string, rows bigint, status string")


@query
def full_refresh(x: Layers) -> DataFrame:
    """The mart from published tables."""
    with scratch(x.spark) as space, refresh.throwaway(x.spark) as models:
        land_all(*x.stored_raw(space), models.names)
        return staged(refresh.full_refresh(models).gold, "gold")


@query
def gated_builds(x: Layers) -> DataFrame:
    """What the gate says of the scans as sent, and of those that belong to a label."""
    known = F.substring("label_id", 5, 24).cast("long") < 100_000_000
    rows = []
    with session.freeing_shuffles(x.spark), scratch(x.spark) as space:
        labels, sent = x.stored_raw(space)
        for build, events in (("as sent", sent), ("without orphans", sent.where(known))):
            with refresh.throwaway(x.spark) as models:
                land_all(labels, events, models.names)
                said = refresh.gated_refresh(models)
                published = x.spark.catalog.tableExists(models.names.gold)
            rows.append((build, said["status"], said["checks"], ", ".join(said["failed"]), published))
    return x.spark.createDataFrame(
        rows, "build string, status string, checks bigint, failed string, published boolean"
    )


def _in_two_batches(
    x: Layers,
    pick: Callable[[refresh.Models], DataFrame],
    reports: bool = False,
    sums: bool = False,
) -> DataFrame:
    """Everything up to a day, then the rest on top of it."""
    with scratch(x.spark) as space, refresh.throwaway(x.spark) as models:
        labels, events = x.stored_raw(space, CUTOFF)
        refresh.start_empty(models)
        if sums:
            refresh.keep_partials(models)
        for part in (~F.col("later"), F.col("later")):
            refresh.apply_batch(models, labels.where(part), events.where(part), reports=reports, are_stored=True)
        return staged(pick(models), "batches")


@query
def published_delay_analysis(x: Layers) -> DataFrame:
    return _in_two_batches(x, lambda m: m.stored(m.names.delay_analysis), reports=True)


@query
def published_data_freshness(x: Layers) -> DataFrame:
    return _in_two_batches(x, lambda m: m.stored(m.names.data_freshness), reports=True)


@query
def partials_delay_analysis(x: Layers) -> DataFrame:
    """Published from partial aggregates that both batches kept."""
    return _in_two_batches(x, lambda m: m.stored(m.names.delay_analysis), reports=True, sums=True)


@query
def partials_on_time_rollup(x: Layers) -> DataFrame:
    by = ["carrier", "service_class"]
    return _in_two_batches(
        x, lambda m: partials.on_time_rollup_of(m.stored(m.names.delivery_partials), by), sums=True
    )


@query
def sketched_scans(x: Layers) -> DataFrame:
    """Exact counts per carrier, and whether the merged sketches of all periods are within their bounds."""

    def pick(m: refresh.Models) -> DataFrame:
        estimated = partials.scans_of(m.stored(m.names.scan_partials))
        return partials.estimates_hold(estimated, m.silver_events)

    return _in_two_batches(x, pick, sums=True)


@query
def incremental_silver_events(x: Layers) -> DataFrame:
    return _in_two_batches(x, lambda models: models.silver_events)


@query
def incremental_delivery_performance(x: Layers) -> DataFrame:
    return _in_two_batches(x, lambda models: models.gold)


@query
def stream_silver_events(x: Layers) -> DataFrame:
    return replays.replay(x.spark, x.folder, lambda models: models.silver_events)


@query
def stream_delivery_performance(x: Layers) -> DataFrame:
    return replays.replay(x.spark, x.folder, lambda models: models.gold)


@query
def stream_dedup_events(x: Layers) -> DataFrame:
    """Ids of the feed and of the late table, each once, though copies of an id come in different loads."""
    feed = replays.replay_feed(x.spark, x.folder, apart=True)
    return feed.rows.select("event_id").unionByName(feed.late.select("event_id"))


@query
def stream_dedup_recent(x: Layers) -> DataFrame:
    """The same with ids remembered for a week behind the newest arrival and looked up in the tables beyond."""
    feed = replays.replay_feed(x.spark, x.folder, apart=True, remember=8)
    return feed.rows.select("event_id").unionByName(feed.late.select("event_id"))


@query
def stream_late_events(x: Layers) -> DataFrame:
    """Scans that came after the watermark had passed them."""
    return replays.replay_feed(x.spark, x.folder).late.select("event_id", "event_received_at")


@query
def stream_with_batch_ids(x: Layers) -> DataFrame:
    """The mart from a stream into raw tables that were landed with batch ids."""
    return replays.replay(x.spark, x.folder, lambda models: models.gold, with_ids=True)


@query
def replayed_batches(x: Layers) -> DataFrame:
    """Rows of each table after every batch was applied twice."""
    with scratch(x.spark) as space, refresh.throwaway(x.spark) as models:
        labels, events = x.stored_raw(space, CUTOFF)
        refresh.start_empty(models, with_ids=True)
        for number, part in enumerate((~F.col("later"), F.col("later"))):
            batch = labels.where(part), events.where(part)
            for _ in range(2):
                refresh.apply_batch(models, *batch, batch_id=f"batch-{number}", are_stored=True)
        tables = {
            "raw_labels": models.stored(models.names.raw_labels),
            "raw_events": models.stored(models.names.raw_events),
            "silver_labels": models.silver_labels,
            "silver_events": models.silver_events,
            "gold": models.gold,
        }
        counts = [t.select(F.lit(n).alias("name"), F.count("*").alias("rows")) for n, t in tables.items()]
        return staged(reduce(DataFrame.unionByName, counts), "counts")


@query
def orphans_over_time(x: Layers) -> DataFrame:
    """Orphans found before and after the labels of one carrier came, with the first time of each."""
    with refresh.throwaway(x.spark) as models:
        refresh.start_empty(models)
        is_ups = F.col("carrier") == "UPS"
        refresh.apply_batch(models, x.raw_labels.where(~is_ups), x.raw_events.where(F.col("event_received_at") < CUTOFF))
        refresh.quarantine_orphans(models, RUN_TS)
        refresh.apply_batch(models, x.raw_labels.where(is_ups), x.raw_events.where(F.col("event_received_at") >= CUTOFF))
        later = refresh.quarantine_orphans(models, RUN_TS + dt.timedelta(days=1))
        return staged(later.select("event_id", "label_id", "detected_at"), "orphans")
