"""Gold layer: the delivery mart and the reports on it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.operators.silver import instant, stamp
from waybill.schemas import DELIVERY_PERFORMANCE, LABEL_FLAGS



def _delivery() -> Column:
    return F.col("event_name") == "delivered"


def percent(part: Column, whole: Column) -> Column:
    """Share in percent as a double; null where there is nothing to share."""
    return F.try_divide(F.lit(100.0) * part.cast("double"), whole.cast("double"))


def latest_delivery(events: DataFrame) -> DataFrame:
    """Time of the last delivery scan per label; null if none of them has a readable time.

    Only the time survives, so this is a plain hash aggregate with a partial step: no sort, and a
    label with very many scans shrinks to one row per task before the shuffle.
    """
    return (
        events.where(_delivery())
        .groupBy("label_id")
        .agg(F.max("event_at").alias("actual_delivery_at"))
    )


def _with_delivery_flags(df: DataFrame) -> DataFrame:
    actual, promised = F.col("actual_delivery_at"), F.col("carrier_promised_delivery_at")
    return df.withColumns(
        {
            "is_delivered": actual.isNotNull(),
            "is_delivered_on_time": F.coalesce(actual <= promised, F.lit(False)),
        }
    )


def delivery_performance(
    labels: DataFrame, events: DataFrame, run_ts: dt.datetime | None = None
) -> DataFrame:
    """One row per label: when it arrived and whether that was on time."""
    joined = labels.drop("inserted_at").join(latest_delivery(events), "label_id", "left")
    return stamp(_with_delivery_flags(joined), run_ts).select(*DELIVERY_PERFORMANCE)


def on_time_by(
    gold: DataFrame, by: Sequence[str] = (), counts: Sequence[Column] | None = None
) -> DataFrame:
    """Counts and on-time shares per group, of all labels and of the delivered ones.

    `counts` says how to count where a row is not a label, as in partial aggregates.
    """
    return _shares(gold.groupBy(*by).agg(*(counts or tallies())), *by)


def on_time_summary(gold: DataFrame) -> DataFrame:
    return on_time_by(gold)


def on_time_rollup(
    gold: DataFrame, by: Sequence[str], counts: Sequence[Column] | None = None
) -> DataFrame:
    """As `on_time_by`, with subtotals; 'ALL' stands for a dimension summed over.

    `level` is the number of dimensions not summed over, which tells 'ALL' from a value of that name.
    """
    counts = counts or tallies()
    summed = gold.rollup(*by).agg(*counts, *[F.grouping(c).alias(f"__all_{c}") for c in by])
    named = [
        F.when(F.col(f"__all_{c}") == 1, F.lit("ALL")).otherwise(F.col(c)).alias(c) for c in by
    ]
    over = sum((F.col(f"__all_{c}").cast("int") for c in by), F.lit(0))
    level = (F.lit(len(by)) - over).alias("level")
    return _shares(summed.select(*named, level, "labels", "delivered", "on_time"), *by, "level")


def tallies() -> list[Column]:
    return [
        F.count("*").alias("labels"),
        F.count_if("is_delivered").alias("delivered"),
        F.count_if("is_delivered_on_time").alias("on_time"),
    ]


def _shares(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(
        *keep,
        "labels",
        "delivered",
        "on_time",
        percent(F.col("on_time"), F.col("labels")).alias("pct_on_time"),
        percent(F.col("on_time"), F.col("delivered")).alias("pct_on_time_of_delivered"),
    )


def with_days_late(gold: DataFrame) -> DataFrame:
    """Calendar days from promise to delivery: negative if early, null if not delivered."""
    return gold.withColumn(
        "days_late", F.datediff("actual_delivery_at", "carrier_promised_delivery_at")
    )


def event_facts(events: DataFrame) -> DataFrame:
    """Per label: delivery, first scan, scan counts, whether any scan is flagged; in one pass.

    Copies of a scan under several ids are first folded on the full scan key, so that the same
    pass counts ids and real scans.
    """
    flagged = (
        F.col("is_malformed_timestamp")
        | F.col("is_missing_event_type")
        | F.col("is_event_on_voided_label")
    )
    # An unreadable time is no evidence that two scans are one: keep those apart by id.
    apart = F.when(F.col("event_at").isNull(), F.col("event_id"))
    scans = (
        events.withColumn("__apart", apart)
        .groupBy("label_id", "event_code", "event_type", "event_at", "__apart")
        .agg(
            F.count("*").alias("copies"),
            F.bool_or(flagged).alias("flagged"),
            F.max(F.when(_delivery(), F.col("event_at"))).alias("delivered_at"),
        )
    )
    return scans.groupBy("label_id").agg(
        F.max("delivered_at").alias("actual_delivery_at"),
        F.min("event_at").alias("first_event_at"),
        F.sum("copies").alias("event_count"),
        F.count("*").alias("logical_event_count"),
        F.bool_or("flagged").alias("__flagged"),
    )


def with_first_scan(df: DataFrame) -> DataFrame:
    """Calendar days from label creation to the first scan."""
    return df.withColumn("days_to_first_scan", F.datediff("first_event_at", "label_created_at"))


def with_event_count(df: DataFrame) -> DataFrame:
    counts = ["event_count", "logical_event_count"]
    return df.withColumns({c: F.coalesce(c, F.lit(0).cast("bigint")) for c in counts})


def with_dq_rollup(df: DataFrame) -> DataFrame:
    """True if the label or any of its scans carries a quality flag."""
    issue = F.coalesce("__flagged", F.lit(False))
    for name in LABEL_FLAGS:
        issue = issue | F.col(name)
    return df.withColumn("has_data_quality_issues", issue).drop("__flagged")


def delivery_details(
    labels: DataFrame, events: DataFrame, run_ts: dt.datetime | None = None
) -> DataFrame:
    """The mart with the second-phase metrics."""
    joined = labels.drop("inserted_at").join(event_facts(events), "label_id", "left")
    timed = with_first_scan(with_days_late(_with_delivery_flags(joined)))
    wide = with_dq_rollup(with_event_count(timed))
    return stamp(wide, run_ts).select(
        *DELIVERY_PERFORMANCE[:-1],
        "days_late",
        "days_to_first_scan",
        "event_count",
        "logical_event_count",
        "has_data_quality_issues",
        "inserted_at",
    )


def region(zip_code: str, digits: int = 3) -> Column:
    """Region of a ZIP: its leading digits."""
    return F.substring(zip_code, 1, digits)


def is_late() -> Column:
    return F.col("is_delivered") & ~F.col("is_delivered_on_time")


def _delay_tallies() -> list[Column]:
    return [
        F.count("*").alias("labels"),
        F.count_if("is_delivered").alias("delivered"),
        F.count_if(is_late()).alias("late"),
        F.sum(F.when(is_late(), F.col("days_late"))).alias("__days"),
    ]


def _delay_shares(df: DataFrame, *keep: str) -> DataFrame:
    late = F.col("late")
    return df.select(
        *keep,
        "labels",
        "delivered",
        "late",
        percent(late, F.col("delivered")).alias("pct_late_of_delivered"),
        F.try_divide(F.col("__days").cast("double"), late.cast("double")).alias("avg_days_late"),
    )


def delay_analysis(gold: DataFrame, digits: int = 3) -> DataFrame:
    """Delays by carrier, service class and origin region."""
    by = ["carrier", "service_class", "origin_region"]
    regional = with_days_late(gold).withColumn("origin_region", region("origin_zip", digits))
    return delay_by(regional, by, _delay_tallies())


def delay_by(df: DataFrame, by: Sequence[str], counts: Sequence[Column]) -> DataFrame:
    """Shares of late labels per group; `counts` gives labels, delivered, late and the days late."""
    return _delay_shares(df.groupBy(*by).agg(*counts), *by)


def delay_clusters(gold: DataFrame, digits: int = 3) -> DataFrame:
    """Where delays cluster: by origin region, lane, weekday of creation and service class.

    One aggregate over grouping sets, one cluster family each. Weekdays are 1 (Monday) to 7.
    """
    families = {
        "origin_region": region("origin_zip", digits),
        "lane": F.concat(region("origin_zip", digits), F.lit(">"), region("dest_zip", digits)),
        "weekday": (F.weekday("label_created_at") + 1).cast("string"),
        "service_class": F.col("service_class"),
    }
    metrics = ["is_delivered", "is_delivered_on_time", "days_late"]
    keyed = with_days_late(gold).select(*metrics, *[v.alias(k) for k, v in families.items()])
    grouped = keyed.groupingSets([[k] for k in families], *families).agg(
        *_delay_tallies(), *[F.grouping(k).alias(f"__off_{k}") for k in families]
    )
    kind, value = F, F
    for name in families:
        on = F.col(f"__off_{name}") == 0
        kind, value = kind.when(on, F.lit(name)), value.when(on, F.col(name))
    return _delay_shares(
        grouped.withColumns({"dimension": kind, "cluster": value}), "dimension", "cluster"
    )


def data_freshness(
    labels: DataFrame,
    events: DataFrame,
    as_of: dt.datetime | None = None,
    recent_hours: int = 72,
) -> DataFrame:
    """Per age of the label: how many have a scan in the last `recent_hours` before `as_of`.

    `as_of` defaults to the latest arrival in the events. Labels and scans after it are left out.
    """
    if as_of is None:
        now = events.select(F.max("event_received_at")).scalar()
    else:
        now = instant(as_of)
    last_scan = (
        events.where(F.col("event_received_at") <= now)
        .groupBy("label_id")
        .agg(F.max("event_at").alias("last_event_at"))
    )
    age = F.timestamp_diff("DAY", F.col("label_created_at"), now)
    bucket = (
        F.when(age < 1, "0: under 1 day")
        .when(age < 3, "1: 1-2 days")
        .when(age < 7, "2: 3-6 days")
        .when(age < 14, "3: 7-13 days")
        .when(age < 30, "4: 14-29 days")
        .otherwise("5: 30 days or more")
    )
    recent = F.col("last_event_at") >= now - F.make_dt_interval(hours=F.lit(recent_hours))
    aged = (
        labels.select("label_id", "label_created_at")
        .where(F.col("label_created_at") <= now)
        .join(last_scan, "label_id", "left")
        .select(bucket.alias("age_bucket"), "last_event_at", recent.alias("is_recent"))
    )
    counted = aged.groupBy("age_bucket").agg(
        F.count("*").alias("labels"),
        F.count("last_event_at").alias("tracked"),
        F.count_if("is_recent").alias("recent"),
    )
    return counted.select(
        "*",
        percent(F.col("tracked"), F.col("labels")).alias("pct_tracked"),
        percent(F.col("recent"), F.col("labels")).alias("pct_recent"),
    )
