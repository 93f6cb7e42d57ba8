"""Profiles of the defects in the raw data."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.functions.timestamps import time_shape, zone_name
from waybill.operators.gold import percent
from waybill.operators.groups import with_neighbour, with_ranks
from waybill.schemas import (
    CARRIER_MIX,
    CARRIERS,
    SLA_DAYS,
    STAGES,
    WEIGHT_RANGE_OZ,
    ZONE_OFFSETS,
)
from waybill.sources.scratch import Scratch


def unpivot_counts(row: DataFrame, whole: str, prefix: str = "") -> DataFrame:
    """Turn a one-row aggregate into rows (metric, n, total, pct), shares of column `whole`."""
    metrics = [c for c in row.columns if c != whole]
    pairs = [F.struct(F.lit(prefix + c).alias("metric"), F.col(c).alias("n")) for c in metrics]
    return (
        row.select(F.col(whole).alias("total"), F.explode(F.array(*pairs)).alias("m"))
        .select("m.metric", "m.n", "total")
        .withColumn("pct", percent(F.col("n"), F.col("total")))
    )


def dq_profile(
    raw_labels: DataFrame,
    raw_events: DataFrame,
    labels: DataFrame,
    events: DataFrame,
    late_days: int = 2,
) -> DataFrame:
    """Realised rate of each defect: one wide aggregate per table."""
    label_log = raw_labels.groupBy("label_id").agg(F.count("*").alias("images"))
    log_row = label_log.agg(
        F.count("*").alias("labels"),
        F.count_if(F.col("images") > 1).alias("changed"),
    )
    label_row = labels.agg(
        F.count("*").alias("labels"),
        F.count("voided_at").alias("voided"),
        F.count("declared_value_cents").alias("insured"),
        F.count_if("can_be_weight_fraud").alias("weight_flag"),
        F.count_if("can_be_void_fraud").alias("void_flag"),
        F.count_if("can_be_insurance_anomaly").alias("insurance_flag"),
        F.count_if("can_be_missing_zip").alias("missing_zip"),
    )
    abbr = zone_name(F.col("event_at"))
    per_id = raw_events.groupBy("event_id").agg(
        F.count("*").alias("copies"),
        F.count_if((abbr != "") & ~abbr.isin(list(ZONE_OFFSETS))).alias("unknown_zone"),
        F.count_if(F.col("location_zip").isNull()).alias("no_location"),
    )
    raw_figures = {
        "events": F.col("copies"),
        "repeated_id": F.col("copies") - 1,
        "unknown_zone": F.col("unknown_zone"),
        "no_location": F.col("no_location"),
    }
    raw_row = per_id.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(name) for name, c in raw_figures.items()]
    )
    delivered = F.col("event_name") == "delivered"
    latency = F.col("event_received_at") - F.col("event_at")
    event_row = events.agg(
        F.count("*").alias("events"),
        F.count_if("is_missing_event_type").alias("missing_event_type"),
        F.count_if(F.col("event_name") == "unknown").alias("unknown_event_name"),
        F.count_if("is_malformed_timestamp").alias("malformed_timestamp"),
        F.count_if(F.col("event_at").isNull()).alias("unreadable_timestamp"),
        F.count_if(delivered & F.col("event_at").isNull()).alias("delivery_unreadable"),
        F.count_if("is_event_on_voided_label").alias("on_voided_label"),
        F.count_if(latency >= F.make_dt_interval(days=F.lit(late_days))).alias("late_arrival"),
    )
    # Scans are counted per label first, so that the join moves one row per label and task.
    per_label = events.groupBy("label_id").agg(F.count("*").alias("scans"))
    known = labels.select("label_id", F.lit(True).alias("__known"))
    orphan_row = per_label.join(known, "label_id", "left").agg(
        F.coalesce(F.sum("scans"), F.lit(0)).alias("events"),
        F.coalesce(F.sum(F.when(F.col("__known").isNull(), F.col("scans"))), F.lit(0)).alias(
            "orphan"
        ),
    )
    parts = [
        unpivot_counts(log_row, "labels", "raw_labels."),
        unpivot_counts(label_row, "labels", "silver_labels."),
        unpivot_counts(raw_row, "events", "raw_events."),
        unpivot_counts(event_row, "events", "silver_events."),
        unpivot_counts(orphan_row, "events", "silver_events."),
    ]
    profile = parts[0]
    for part in parts[1:]:
        profile = profile.unionByName(part)
    return profile


def time_shapes(raw_events: DataFrame) -> DataFrame:
    """How each carrier writes its times."""
    return (
        raw_events.select("carrier", time_shape(F.col("event_at")).alias("shape"))
        .groupBy("carrier", "shape")
        .agg(F.count("*").alias("events"))
    )


def out_of_order(events: DataFrame, space: Scratch | None = None) -> DataFrame:
    """Rank of each scan of a label by event time and by arrival, flagged where they differ.

    Scans without a readable time have no place in the event order and are left out.
    """
    timed = events.where(F.col("event_at").isNotNull()).select(
        "event_id", "label_id", "carrier", "event_at", "event_received_at"
    )
    ranked = with_ranks(
        timed,
        ["label_id"],
        {
            "event_rank": ["event_at", "event_received_at", "event_id"],
            "arrival_rank": ["event_received_at", "event_at", "event_id"],
        },
        space,
    )
    return ranked.withColumn("is_out_of_order", F.col("event_rank") != F.col("arrival_rank"))


def with_latency(events: DataFrame) -> DataFrame:
    """Whole seconds from the scan to its arrival; null without a readable time."""
    return events.withColumn(
        "latency_seconds", F.timestamp_diff("SECOND", F.col("event_at"), F.col("event_received_at"))
    )


def arrival_latency(events: DataFrame, late_days: int = 2) -> DataFrame:
    """Arrival latency per carrier, quantiles exact at any size.

    Scans are first counted per carrier and second, with a map-side step. A quantile is the least
    latency that at least that share of the scans does not exceed.
    """
    seconds, n = F.col("latency_seconds"), F.col("n")
    counts = (
        with_latency(events)
        .where(seconds.isNotNull())
        .groupBy("carrier", "latency_seconds")
        .agg(F.count("*").alias("n"))
    )
    whole = Window.partitionBy("carrier")
    upto = whole.orderBy("latency_seconds").rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.withColumns({"upto": F.sum("n").over(upto), "of": F.sum("n").over(whole)})
    late = F.coalesce(F.sum(F.when(seconds >= late_days * 86400, n)), F.lit(0))

    def quantile(share: float) -> Column:
        return F.min(F.when(F.col("upto") >= F.ceil(F.col("of") * share), seconds))

    return counts.groupBy("carrier").agg(
        F.sum("n").alias("events"),
        late.alias("late"),
        percent(late, F.sum("n")).alias("pct_late"),
        F.try_divide(F.sum(seconds * n).cast("double"), F.sum("n")).alias("avg_seconds"),
        quantile(0.5).alias("p50_seconds"),
        quantile(0.95).alias("p95_seconds"),
        F.max(seconds).alias("max_seconds"),
    )


def late_arrivals(events: DataFrame, labels: DataFrame, late_days: int = 3) -> DataFrame:
    """Flag scans that arrive `late_days` or more after the promised delivery.

    Every scan is kept; the flag of one whose label is unknown is null, as it has no promise.
    """
    promises = labels.select("label_id", "carrier_promised_delivery_at")
    grace = F.make_dt_interval(days=F.lit(late_days))
    return (
        with_latency(events)
        .join(promises, "label_id", "left")
        .withColumn(
            "is_late_arrival",
            F.col("event_received_at") >= F.col("carrier_promised_delivery_at") + grace,
        )
    )


def sequence_completeness(labels: DataFrame, events: DataFrame) -> DataFrame:
    """Which stages each label has reached, and whether it is stuck before delivery."""
    reached = [F.bool_or(F.col("event_name") == s).alias(s) for s in STAGES]
    per_label = events.groupBy("label_id").agg(*reached)
    joined = labels.select("label_id", "carrier", "voided_at").join(per_label, "label_id", "left")
    seen = {s: F.coalesce(s, F.lit(False)) for s in STAGES}
    furthest = F
    for stage in reversed(STAGES):
        furthest = furthest.when(F.col(stage), stage)
    count = sum((F.col(s).cast("int") for s in STAGES), F.lit(0))
    return (
        joined.withColumns(seen)
        .withColumns(
            {
                "stages_seen": count,
                "furthest_stage": furthest.otherwise("none"),
                "is_complete": count == len(STAGES),
                "is_stuck": F.col("voided_at").isNull() & ~F.col("delivered"),
            }
        )
        .drop("voided_at")
    )


def stage_summary(completeness: DataFrame) -> DataFrame:
    return completeness.groupBy("carrier", "furthest_stage").agg(
        F.count("*").alias("labels"),
        F.count_if("is_complete").alias("complete"),
        F.count_if("is_stuck").alias("stuck"),
    )


def promise_audit(labels: DataFrame, sla: Mapping[str, int] = SLA_DAYS) -> DataFrame:
    """Promise against creation plus the SLA days of the service class, per class.

    The SLA list comes with the call; its size decides how it is joined.
    """
    spark = labels.sparkSession
    known = spark.createDataFrame(list(sla.items()), "service_class string, sla_days int")
    promised = F.col("carrier_promised_delivery_at")
    expected = F.col("label_created_at") + F.make_dt_interval(days=F.col("sla_days"))
    return (
        labels.select("service_class", "label_created_at", "carrier_promised_delivery_at")
        .join(known, "service_class", "left")
        .groupBy("service_class", "sla_days")
        .agg(
            F.count("*").alias("labels"),
            F.count_if(promised == expected).alias("kept_to_sla"),
            F.count_if(promised < expected).alias("tighter"),
            F.count_if(promised > expected).alias("looser"),
        )
        .withColumn("has_sla", F.col("sla_days").isNotNull())
    )


TRACKED = ["carrier", "service_class", "voided_at"]


def change_history(raw_labels: DataFrame, space: Scratch | None = None) -> DataFrame:
    """Each image in the change log with what changed since the image before it.

    An image that landed more than once is one row with its number of copies: landing it again
    changes nothing.
    """
    columns = raw_labels.columns
    order = ["last_updated_at"]
    order += [c for c in columns if c not in ("label_id", "last_updated_at")]

    def fold_copies(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*columns).agg(F.count("*").alias("copies"))

    before = with_neighbour(raw_labels, ["label_id"], order, TRACKED, "prev", fold_copies, space)
    changed = {
        f"changed_{c}": F.col("has_prev") & ~F.col(c).eqNullSafe(F.col(f"prev_{c}"))
        for c in TRACKED
    }
    return (
        before.withColumns(changed)
        .withColumn("is_first", ~F.col("has_prev"))
        .select(
            "label_id",
            "last_updated_at",
            *TRACKED,
            *[f"prev_{c}" for c in TRACKED],
            *changed,
            "is_first",
            "copies",
        )
    )


def void_profile(labels: DataFrame, events: DataFrame, immediate_hours: int = 1) -> DataFrame:
    """Voided labels by how soon they were voided, and scans that came after the void."""
    soon = F.col("voided_at") <= F.col("label_created_at") + F.make_dt_interval(
        hours=F.lit(immediate_hours)
    )
    voided = labels.where(F.col("voided_at").isNotNull()).select(
        "label_id", "voided_at", F.when(soon, "immediate").otherwise("late").alias("void_kind")
    )
    after = F.col("event_at") > F.col("voided_at")
    scans = (
        events.select("label_id", "event_at")
        .join(voided, "label_id")
        .groupBy("label_id", "void_kind")
        .agg(F.count("*").alias("scans"), F.count_if(after).alias("after"))
    )
    every = voided.groupBy("void_kind").agg(F.count("*").alias("labels"))
    scanned = scans.groupBy("void_kind").agg(
        F.sum("scans").alias("scans"),
        F.sum("after").alias("scans_after_void"),
        F.count_if(F.col("after") > 0).alias("labels_scanned_after_void"),
    )
    counts = ["scans", "scans_after_void", "labels_scanned_after_void"]
    return every.join(scanned, "void_kind", "left").fillna(0, counts)


def mix_check(
    labels: DataFrame, target: Mapping[str, float] = CARRIER_MIX, tolerance_pct: float = 2.0
) -> DataFrame:
    """Share of labels per carrier against a target mix."""
    spark = labels.sparkSession
    wanted = spark.createDataFrame(
        [(k, 100.0 * v) for k, v in target.items()], "carrier string, target_pct double"
    )
    counts = labels.groupBy("carrier").agg(F.count("*").alias("labels"))
    total = F.sum("labels").over(Window.partitionBy())  # one row per carrier
    off = F.abs(F.col("pct") - F.col("target_pct"))
    return (
        counts.join(wanted, "carrier", "full")
        .fillna(0, ["labels"])
        .fillna(0.0, ["target_pct"])
        .withColumn("pct", percent(F.col("labels"), total))
        .withColumn("within_tolerance", off <= tolerance_pct)
    )


def format_contract(labels: DataFrame) -> DataFrame:
    """Rows that break each format rule of the label contract, in one aggregate."""
    low, high = WEIGHT_RANGE_OZ
    five_digits = "^[0-9]{5}$"
    broken = {
        "label_id": ~F.col("label_id").rlike("^lbl_[0-9a-f]{24}$"),
        "customer_id": ~F.col("customer_id").rlike("^cust_[0-9a-f]{12}$"),
        "carrier": ~F.col("carrier").isin(CARRIERS),
        "service_class": ~F.col("service_class").isin(list(SLA_DAYS)),
        "service_class_of_carrier": ~F.col("service_class").startswith(
            F.concat("carrier", F.lit("_"))
        ),
        "origin_zip": ~F.col("origin_zip").rlike(five_digits),
        "dest_zip": ~F.col("dest_zip").rlike(five_digits),
        "weight_oz": ~F.col("weight_oz").between(low, high),
        "declared_value_cents": F.col("declared_value_cents") < 0,
        "promise_after_creation": F.col("carrier_promised_delivery_at")
        <= F.col("label_created_at"),
        "update_after_creation": F.col("last_updated_at") < F.col("label_created_at"),
    }
    row = labels.agg(
        F.count("*").alias("__total"), *[F.count_if(rule).alias(k) for k, rule in broken.items()]
    )
    return unpivot_counts(row, "__total").withColumnsRenamed(
        {"metric": "rule", "n": "broken", "pct": "pct_broken"}
    )
