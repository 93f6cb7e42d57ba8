"""One row per key out of many: collapse, dedup, merge, history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.operators.groups import with_neighbour
from waybill.sources.scratch import Scratch

_RANK = "__rank"


def _newest_first(name: str) -> Column:
    return F.col(name).desc_nulls_last()


def collapse_latest(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    tie_break: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Keep the newest row per key under a total order.

    `order` lists names (newest first) or ready sort columns. Rows equal there are told apart by
    `tie_break`, by default every other column, so that reruns and retries pick the same row.

    Spark limits each key to one row per task before the shuffle (`WindowGroupLimit`), so a key
    that holds a large part of all rows does not travel to one task whole.
    """
    if tie_break is None:
        used = set(keys) | {o for o in order if isinstance(o, str)}
        tie_break = [c for c in df.columns if c not in used]
    sort = [_newest_first(o) if isinstance(o, str) else o for o in [*order, *tie_break]]
    newest = Window.partitionBy(*keys).orderBy(*sort)
    return df.withColumn(_RANK, F.row_number().over(newest)).where(F.col(_RANK) == 1).drop(_RANK)


def event_ties(raw_time: str = "event_at") -> list[str | Column]:
    """What decides between copies of an event received at the same instant.

    `raw_time` is the column with the time as sent.
    """
    sent = F.coalesce("event_code", "event_type", F.lit(""))
    return [
        raw_time,
        sent.desc(),
        F.coalesce("location_zip", F.lit("")).desc(),
        "label_id",
        "carrier",
        "event_code",
        "event_type",
        "location_zip",
        "raw_payload",
    ]


def event_rank(raw_time: str = "event_at") -> Column:
    """What orders copies of an event as one value, greatest for the copy that `dedup_events` keeps.

    Nulls are least, as they come last in the descending order.
    """
    sent, zip_code = F.coalesce("event_code", "event_type", F.lit("")), F.coalesce("location_zip", F.lit(""))
    plain = ["label_id", "carrier", "event_code", "event_type", "location_zip", "raw_payload"]
    return rank_of(["event_received_at", raw_time, sent, zip_code, *plain])


def rank_of(order: Sequence[str | Column]) -> Column:
    """Values that order rows, newest greatest, as one value that can be compared."""
    values = [F.col(o) if isinstance(o, str) else o for o in order]
    return F.struct(*[v.alias(f"r{i}") for i, v in enumerate(values)])


def dedup_events(raw_events: DataFrame) -> DataFrame:
    """One row per event id: the copy received last."""
    return collapse_latest(raw_events, ["event_id"], ["event_received_at"], event_ties())


LOGICAL_KEY = ["label_id", "event_code", "event_type", "event_at"]


def dedup_logical(events: DataFrame) -> DataFrame:
    """One row per real scan: same label, code, type and time under any event id.

    Scans whose time could not be read are kept apart from each other; nothing shows that two of
    them are the same scan.
    """
    apart = F.when(F.col("event_at").isNull(), F.col("event_id"))
    return collapse_latest(
        events.withColumn("__apart", apart),
        [*LOGICAL_KEY, "__apart"],
        ["event_received_at", "event_id"],
    ).drop("__apart")


def logical_duplicates(events: DataFrame) -> DataFrame:
    """Scans that landed under more than one event id, with the number of copies."""
    return (
        events.where(F.col("event_at").isNotNull())
        .groupBy(*LOGICAL_KEY)
        .agg(F.count("*").alias("copies"))
        .where(F.col("copies") > 1)
    )


def merge_latest(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    tie_break: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Upsert: the newest row per key of target and batch together.

    Order-free and repeatable: any split of the input into batches, in any order and with any
    batch applied twice, ends in the same rows as one collapse of everything.
    """
    return collapse_latest(target.unionByName(batch), keys, order, tie_break)


def scd2(
    df: DataFrame, keys: Sequence[str], ts: str, space: Scratch | None = None
) -> DataFrame:
    """Validity intervals from a change log of full images.

    There is one version per key and instant (the winner among images of the same instant), valid
    until the next one. The versions are written to `space` on the way.
    """

    def one_per_instant(rows: DataFrame) -> DataFrame:
        return collapse_latest(rows, [*keys, ts], [])

    following = with_neighbour(df, keys, [ts], [ts], "next", one_per_instant, space)
    return following.select(
        "*",
        F.col(ts).alias("valid_from"),
        F.col(f"next_{ts}").alias("valid_to"),
        F.col(f"next_{ts}").isNull().alias("is_current"),
    ).drop(f"next_{ts}", "has_next")
