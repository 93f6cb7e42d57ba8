"""Partial aggregates: what one part of a table adds to the reports, to be merged over any parts.

Counts, sums and extremes merge exactly. Distinct labels and quantiles of latency are kept as
sketches of bounded size, with the error bounds below.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.operators.gold import (
    delay_by,
    is_late,
    on_time_by,
    on_time_rollup,
    percent,
    region,
    tallies,
    with_days_late,
)
from waybill.operators.profile import with_latency

DELIVERY_BY = ("carrier", "service_class", "origin_region")

#: HyperLogLog registers, as a power of two, and three standard errors of an estimate.
LOG_REGISTERS = 12
DISTINCT_ERROR = 3 * 1.04 / 2 ** (LOG_REGISTERS / 2)
#: Size of a quantile sketch, and the error of a rank that it should stay within.
QUANTILE_SIZE = 1000
RANK_ERROR = 0.01
QUANTILES = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def delivery_partials(gold: DataFrame, *keys: str, digits: int = 3) -> DataFrame:
    """Counts of the mart per `keys`, carrier, service class and origin region."""
    regional = with_days_late(gold).withColumn("origin_region", region("origin_zip", digits))
    late_days = F.when(is_late(), F.col("days_late"))
    return regional.groupBy(*keys, *DELIVERY_BY).agg(
        *tallies(),
        F.count_if(is_late()).alias("late"),
        F.sum(late_days).alias("days_late"),
        F.max(late_days).alias("most_days_late"),
    )


def _summed(*names: str) -> list[Column]:
    return [F.coalesce(F.sum(n), F.lit(0).cast("bigint")).alias(n) for n in names]


def on_time_of(partials: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """`gold.on_time_by` from delivery partials."""
    return on_time_by(partials, by, _summed("labels", "delivered", "on_time"))


def on_time_rollup_of(partials: DataFrame, by: Sequence[str]) -> DataFrame:
    """`gold.on_time_rollup` from delivery partials."""
    return on_time_rollup(partials, by, _summed("labels", "delivered", "on_time"))


def delay_analysis_of(partials: DataFrame) -> DataFrame:
    """`gold.delay_analysis` from delivery partials."""
    sums = [*_summed("labels", "delivered", "late"), F.sum("days_late").alias("__days")]
    return delay_by(partials, DELIVERY_BY, sums)


def scan_partials(events: DataFrame, *keys: str, late_days: int = 2) -> DataFrame:
    """Scans per `keys` and carrier: counts, a sketch of their labels and one of their latencies.

    Scans without a readable time count as scans and have no latency.
    """
    seconds = F.col("latency_seconds")
    return with_latency(events).groupBy(*keys, "carrier").agg(
        F.count("*").alias("scans"),
        F.count(seconds).alias("timed"),
        F.count_if(seconds >= late_days * 86400).alias("late"),
        F.sum(seconds).alias("seconds"),
        F.max(seconds).alias("max_seconds"),
        F.hll_sketch_agg("label_id", F.lit(LOG_REGISTERS)).alias("label_sketch"),
        F.kll_sketch_agg_bigint(seconds, F.lit(QUANTILE_SIZE)).alias("latency_sketch"),
    )


def scans_of(
    partials: DataFrame, by: Sequence[str] = ("carrier",), levels: Mapping[str, float] = QUANTILES
) -> DataFrame:
    """Scans, distinct labels and arrival latency from scan partials of any span.

    `labels` and the quantiles are estimates: the number of labels is off by more than DISTINCT_ERROR of
    it in about one case of 400, and the rank of a quantile by much less than RANK_ERROR. Without
    a readable time there are no quantiles.
    """
    merged = partials.groupBy(*by).agg(
        *_summed("scans", "timed", "late"),
        F.sum("seconds").alias("seconds"),
        F.max("max_seconds").alias("max_seconds"),
        F.hll_union_agg("label_sketch").alias("label_sketch"),
        F.kll_merge_agg_bigint("latency_sketch").alias("latency_sketch"),
    )
    timed = F.col("timed")

    def at(share: float) -> Column:
        return F.when(timed > 0, F.kll_sketch_get_quantile_bigint("latency_sketch", F.lit(share)))

    return merged.select(
        *by,
        "scans",
        "timed",
        "late",
        percent(F.col("late"), timed).alias("pct_late"),
        F.try_divide(F.col("seconds").cast("double"), timed).alias("avg_seconds"),
        "max_seconds",
        F.hll_sketch_estimate("label_sketch").alias("labels"),
        *[at(share).alias(f"{name}_seconds") for name, share in levels.items()],
    )


def estimates_hold(
    estimated: DataFrame, events: DataFrame, levels: Mapping[str, float] = QUANTILES
) -> DataFrame:
    """Exact figures per carrier beside whether the estimates of `scans_of` are within their bounds.

    Reads all the events: a check of the sketches, not a report.
    """
    marks = estimated.select(
        F.col("carrier").alias("__of"),
        F.col("labels").alias("__labels"),
        *[f"{name}_seconds" for name in levels],
    )
    seconds, timed = F.col("latency_seconds"), F.col("timed")
    marked = with_latency(events).join(marks, F.col("carrier").eqNullSafe(F.col("__of")))
    ranked = marked.groupBy("carrier", "label_id", "__labels").agg(
        F.count("*").alias("scans"),
        F.count(seconds).alias("timed"),
        *[F.count_if(seconds < F.col(f"{n}_seconds")).alias(f"__below_{n}") for n in levels],
        *[F.count_if(seconds <= F.col(f"{n}_seconds")).alias(f"__upto_{n}") for n in levels],
    )
    sums = ["scans", "timed", *[f"__{side}_{n}" for n in levels for side in ("below", "upto")]]
    exact = ranked.groupBy("carrier", "__labels").agg(
        F.count("label_id").alias("labels"), *[F.sum(c).alias(c) for c in sums]
    )
    off = F.abs(F.col("__labels") - F.col("labels"))
    holds = {
        f"{n}_holds": (F.col(f"__below_{n}") <= (share + RANK_ERROR) * timed)
        & (F.col(f"__upto_{n}") >= (share - RANK_ERROR) * timed)
        for n, share in levels.items()
    }
    return exact.select(
        "carrier",
        "scans",
        "timed",
        "labels",
        (off <= DISTINCT_ERROR * F.col("labels")).alias("labels_hold"),
        *[rule.alias(name) for name, rule in holds.items()],
    )
