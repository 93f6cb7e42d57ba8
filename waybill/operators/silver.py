"""Silver layer: current labels and conformed scan events."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions import flags
from waybill.functions.timestamps import repair_times
from waybill.operators.latest import collapse_latest, dedup_events
from waybill.schemas import SILVER_EVENTS, SILVER_LABELS


def instant(moment: dt.datetime) -> Column:
    """A point in time as a literal; one without a zone is UTC, wherever the driver runs."""
    aware = moment if moment.tzinfo else moment.replace(tzinfo=dt.timezone.utc)
    return F.lit(aware).cast("timestamp")


def stamp(df: DataFrame, run_ts: dt.datetime | None = None, name: str = "inserted_at") -> DataFrame:
    """Load time of the row: the given run time, or the start of the query."""
    when = F.current_timestamp() if run_ts is None else instant(run_ts)
    return df.withColumn(name, when)


def flag_labels(labels: DataFrame) -> DataFrame:
    return labels.withColumns(
        {
            "can_be_weight_fraud": flags.flag_weight(F.col("weight_oz")),
            "can_be_void_fraud": flags.flag_void(F.col("voided_at"), F.col("label_created_at")),
            "can_be_insurance_anomaly": flags.flag_insurance(F.col("declared_value_cents")),
            "can_be_missing_zip": flags.flag_missing_zip(F.col("origin_zip"), F.col("dest_zip")),
        }
    )


def current_labels(raw_labels: DataFrame) -> DataFrame:
    return collapse_latest(raw_labels, ["label_id"], ["last_updated_at"])


def silver_labels(raw_labels: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    """Current state of each label with suspicion flags."""
    return stamp(flag_labels(current_labels(raw_labels)), run_ts).select(*SILVER_LABELS)


def conform_events(events: DataFrame, receipt_as_fallback: bool = False) -> DataFrame:
    """Common names, repaired times and flags for deduplicated raw events.

    Keeps the raw time as `event_at_raw`. By default a time that cannot be read becomes null; with
    `receipt_as_fallback` the arrival time stands in for it (the row stays flagged).
    """
    fallback = "event_received_at" if receipt_as_fallback else None
    code, kind = F.col("event_code"), F.col("event_type")
    return (
        repair_times(events, "event_at", fallback)
        .withColumns(
            {
                "event_name": flags.canonical_event_name(code, kind),
                "is_missing_event_type": flags.flag_missing_type(code, kind),
            }
        )
        .withColumnRenamed("event_at", "event_at_raw")
        .withColumnRenamed("parsed_at", "event_at")
        .drop("shape", "normalized_iso")
    )


def flag_on_voided(events: DataFrame, labels: DataFrame) -> DataFrame:
    """Flag events of voided labels.

    Joins only the voided labels, about a tenth of them, and only their key. An event without a
    label stays and is not flagged.
    """
    voided = labels.where(F.col("voided_at").isNotNull()).select(
        "label_id", F.lit(True).alias("__voided")
    )
    return (
        events.join(voided, "label_id", "left")
        .withColumn("is_event_on_voided_label", F.coalesce("__voided", F.lit(False)))
        .drop("__voided")
    )


def flag_by_id(events: DataFrame, raw_events: DataFrame, labels: DataFrame) -> DataFrame:
    """As `flag_on_voided`, for deduplicated events whose raw rows can be read again.

    Only event ids and label ids travel to the voided labels. What they flag comes back to the
    event id, by which the dedup has left the events: whole events need no second shuffle.
    """
    voided = labels.where(F.col("voided_at").isNotNull()).select("label_id")
    flagged = raw_events.select("event_id", "label_id").join(voided, "label_id", "left_semi").distinct()
    flagged = flagged.select(F.col("event_id").alias("__id"), F.col("label_id").alias("__label"))
    # Two bounds instead of an equality: as a join key, the label would need a shuffle by both.
    label = F.col("label_id")
    same = (F.col("event_id") == F.col("__id")) & (label >= F.col("__label")) & (label <= F.col("__label"))
    with_id = events.where(F.col("event_id").isNotNull()).join(flagged, same, "left")
    with_id = with_id.withColumn("is_event_on_voided_label", F.col("__id").isNotNull()).drop("__id", "__label")
    # A null id is one event at most.
    return with_id.unionByName(flag_on_voided(events.where(F.col("event_id").isNull()), labels))


def silver_events(
    raw_events: DataFrame,
    labels: DataFrame,
    run_ts: dt.datetime | None = None,
    receipt_as_fallback: bool = False,
) -> DataFrame:
    """Deduplicated, conformed events with times in UTC."""
    conformed = conform_events(dedup_events(raw_events), receipt_as_fallback)
    return stamp(flag_on_voided(conformed, labels), run_ts).select(*SILVER_EVENTS)


def orphaned_events(
    events: DataFrame, labels: DataFrame, run_ts: dt.datetime | None = None
) -> DataFrame:
    """Events whose label does not exist, with the time this was found."""
    lost = events.join(labels.select("label_id"), "label_id", "left_anti")
    return stamp(lost, run_ts, "detected_at")


def drop_orphans(events: DataFrame, labels: DataFrame) -> DataFrame:
    return events.join(labels.select("label_id"), "label_id", "left_semi")
