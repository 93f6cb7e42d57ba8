"""Data-quality tests and the pipeline gate."""

from __future__ import annotations

import operator
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.operators.gold import percent
from waybill.schemas import STAGES, UNKNOWN_STAGE

EVENT_NAMES = [*STAGES, UNKNOWN_STAGE]


# ---- Column tests: each returns the failing values or rows ------------------------


def unique(df: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once, with their number of rows."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("rows"))
        .where(F.col("rows") > 1)
    )


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose non-null value has no parent."""
    known = parent.select(F.col(field).alias(column))
    return child.where(F.col(column).isNotNull()).join(known, column, "left_anti")


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Non-null values outside the list, with their number of rows."""
    return (
        df.where(~F.col(column).isin(list(values)))
        .groupBy(column)
        .agg(F.count("*").alias("rows"))
    )


def model_tests(labels: DataFrame, events: DataFrame, gold: DataFrame) -> DataFrame:
    """The declared tests of the three models with their number of failures.

    `unique` and `not_null` of a key come from one aggregate on that key.
    """

    def keyed(model: str, df: DataFrame, column: str) -> DataFrame:
        per_value = df.groupBy(column).agg(F.count("*").alias("rows"))
        null = F.col(column).isNull()
        return _failures(
            per_value.agg(
                F.count_if(~null & (F.col("rows") > 1)).alias("unique"),
                F.coalesce(F.sum(F.when(null, F.col("rows"))), F.lit(0)).alias("not_null"),
            ),
            model,
            column,
        )

    def counted(model: str, column: str, test: str, failing: DataFrame) -> DataFrame:
        return _failures(failing.agg(F.count("*").alias(test)), model, column)

    rogue = accepted_values(events, "event_name", EVENT_NAMES)
    parts = [
        keyed("silver_labels", labels, "label_id"),
        keyed("silver_events", events, "event_id"),
        keyed("gold", gold, "label_id"),
        counted(
            "silver_events",
            "label_id",
            "relationships",
            relationships(events, "label_id", labels, "label_id"),
        ),
        counted(
            "gold", "label_id", "relationships", relationships(gold, "label_id", labels, "label_id")
        ),
        counted("silver_events", "event_name", "accepted_values", rogue),
        counted(
            "gold", "is_delivered_on_time", "not_null", not_null(gold, "is_delivered_on_time")
        ),
    ]
    return _union(parts)


def _failures(row: DataFrame, model: str, column: str) -> DataFrame:
    tests = [
        F.struct(F.lit(c).alias("test"), F.col(c).cast("bigint").alias("failures"))
        for c in row.columns
    ]
    return (
        row.select(F.explode(F.array(*tests)).alias("t"))
        .select("t.test", "t.failures")
        .withColumns({"model": F.lit(model), "column_name": F.lit(column)})
        .withColumn("passed", F.col("failures") == 0)
    )


def _union(parts: Iterable[DataFrame]) -> DataFrame:
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first


# ---- Gate ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    """A named condition on gathered metrics: `observed` is shown, `passed` decides."""

    name: str
    observed: Column
    passed: Callable[[Column], Column]
    threshold: str


def _within(low: float, high: float, low_op=operator.ge, high_op=operator.le):
    return lambda x: low_op(x, F.lit(low)) & high_op(x, F.lit(high))


def _zero(x: Column) -> Column:
    return x == 0


def gate_metrics(labels: DataFrame, events: DataFrame, gold: DataFrame) -> DataFrame:
    """One row with every figure the gate needs.

    Figures per carrier and per key are aggregated first with a map-side partial step, then
    summed up. Each part is a single row; they are put side by side by way of (metric, value)
    rows.
    """
    # A carrier is short if it has fewer than four names other than unknown.
    per_name = events.groupBy("carrier", "event_name").agg(
        F.count("*").alias("events"),
        F.count("event_at").alias("parsed"),
        F.count_if("is_malformed_timestamp").alias("malformed"),
    )
    rogue = F.when(~F.col("event_name").isin(EVENT_NAMES), F.col("events"))
    per_carrier = per_name.groupBy("carrier").agg(
        F.sum("events").alias("events"),
        F.sum("parsed").alias("parsed"),
        F.sum("malformed").alias("malformed"),
        F.coalesce(F.sum(rogue), F.lit(0)).alias("rogue"),
        F.count_if(F.col("event_name") != UNKNOWN_STAGE).alias("names"),
    )
    short = F.col("names").between(1, len(STAGES) - 1)
    event_row = per_carrier.agg(
        F.sum("parsed").alias("parsed"),
        F.sum("malformed").alias("malformed"),
        F.sum("rogue").alias("rogue"),
        F.count_if(short).alias("carriers_short"),
    )
    # The rows of each id are counted too: with the tests of the models in one query, one shuffle serves both.
    per_id = events.groupBy("event_id").agg(F.count("*").alias("rows"))
    id_row = per_id.agg(F.count("event_id").alias("event_ids"), F.sum("rows").alias("events"))
    label_row = _distinct(labels, "label_id", "label_ids", "labels")
    gold_row = _distinct(gold, "label_id", "gold_ids", "gold_rows")
    # One pass over events and labels finds the orphans and the deliveries that came too early.
    known_labels = labels.select("label_id", "label_created_at", F.lit(True).alias("__known"))
    delivered_at = F.when(F.col("event_name") == "delivered", F.col("event_at")).alias("delivered_at")
    placed = events.select("label_id", delivered_at).join(known_labels, "label_id", "left")
    label_match_row = placed.agg(
        F.count_if(F.col("__known").isNull()).alias("orphans"),
        F.count_if(F.col("delivered_at") < F.col("label_created_at")).alias("early"),
    )
    done, in_time = F.col("is_delivered"), F.col("is_delivered_on_time")
    actual, promised = F.col("actual_delivery_at"), F.col("carrier_promised_delivery_at")
    per_gold_carrier = gold.groupBy("carrier").agg(
        F.count("*").alias("rows"),
        F.count_if(done).alias("delivered"),
        F.count_if(in_time).alias("on_time"),
        F.count_if(~done & actual.isNotNull()).alias("a"),
        F.count_if(~done & in_time).alias("b"),
        F.count_if(in_time & (actual > promised)).alias("c"),
    )
    share = percent(F.col("on_time"), F.col("rows"))
    metric_row = per_gold_carrier.agg(
        F.sum("delivered").alias("delivered"),
        F.sum("on_time").alias("on_time"),
        F.sum(F.col("a") + F.col("b") + F.col("c")).alias("impossible"),
        F.count_if((share <= 1.0) | (share >= 99.5)).alias("extreme_carriers"),
    )
    rows = [event_row, id_row, label_row, gold_row, label_match_row, metric_row]
    names = [c for row in rows for c in row.columns]
    long = _union(_as_pairs(row) for row in rows)
    return long.agg(*[F.max(F.when(F.col("metric") == n, F.col("value"))).alias(n) for n in names])


def _distinct(df: DataFrame, key: str, distinct: str, total: str) -> DataFrame:
    per_key = df.groupBy(key).agg(F.count("*").alias("rows"))
    return per_key.agg(F.count(key).alias(distinct), F.coalesce(F.sum("rows"), F.lit(0)).alias(total))


def _as_pairs(row: DataFrame) -> DataFrame:
    pairs = [
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("bigint").alias("value"))
        for c in row.columns
    ]
    return row.select(F.explode(F.array(*pairs)).alias("p")).select("p.metric", "p.value")


def gate_checks() -> list[Check]:
    def m(name: str) -> Column:
        return F.col(name)

    # Thresholds of the gate.
    return [
        Check("1a event names canonical", m("rogue"), _zero, "= 0"),
        Check("1b all stages per carrier", m("carriers_short"), _zero, "= 0"),
        Check("1c share parsed", percent(m("parsed"), m("events")), lambda x: x >= 99.0, ">= 99"),
        Check(
            "1d share malformed", percent(m("malformed"), m("events")), lambda x: x < 3.0, "< 3"
        ),
        Check("2a event id unique", m("events") - m("event_ids"), _zero, "= 0"),
        Check("2b no orphan events", m("orphans"), _zero, "= 0"),
        Check("2c one row per label", m("labels") - m("label_ids"), _zero, "= 0"),
        Check("3a no delivery before creation", m("early"), _zero, "= 0"),
        Check(
            "4a mart one row per label",
            F.abs(m("gold_rows") - m("gold_ids")) + F.abs(m("gold_ids") - m("label_ids")),
            _zero,
            "= 0",
        ),
        Check(
            "4b on time of all",
            percent(m("on_time"), m("gold_rows")),
            _within(80.0, 99.0),
            "in [80, 99]",
        ),
        Check(
            "4c on time of delivered",
            percent(m("on_time"), m("delivered")),
            _within(80.0, 99.9),
            "in [80, 99.9]",
        ),
        Check(
            "4d late of delivered",
            percent(m("delivered") - m("on_time"), m("delivered")),
            _within(0.0, 15.0, operator.gt, operator.lt),
            "in (0, 15)",
        ),
        Check("4e no impossible states", m("impossible"), _zero, "= 0"),
        Check("4f no carrier at an extreme", m("extreme_carriers"), _zero, "= 0"),
    ]


def run_checks(metrics: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Rows (check, passed, observed, threshold); a check that cannot be decided has failed."""
    rows = [
        F.struct(
            F.lit(c.name).alias("check_name"),
            F.coalesce(c.passed(c.observed), F.lit(False)).alias("passed"),
            c.observed.cast("double").alias("observed"),
            F.lit(c.threshold).alias("threshold"),
        )
        for c in checks
    ]
    return metrics.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def dq_gate(labels: DataFrame, events: DataFrame, gold: DataFrame) -> DataFrame:
    return run_checks(gate_metrics(labels, events, gold), gate_checks())


class GateFailed(AssertionError):
    """At least one check of the gate failed."""


def enforce(results: DataFrame) -> int:
    """Raise if any check failed; otherwise the number of checks. Runs every check first."""
    outcome = results.collect()  # one row per check
    failed = [r for r in outcome if not r.passed]
    if failed:
        shown = "; ".join(f"{r.check_name} ({r.observed}, wanted {r.threshold})" for r in failed)
        raise GateFailed(f"{len(failed)} of {len(outcome)} checks failed: {shown}")
    return len(outcome)


def idempotency_snapshot(gold: DataFrame) -> DataFrame:
    """Figures that must not change when the layers are rebuilt."""
    return gold.agg(
        F.count("*").alias("rows"), F.count_if("is_delivered_on_time").alias("on_time")
    )


def parity(
    left: DataFrame, right: DataFrame, ignore: Sequence[str] = ("inserted_at",)
) -> DataFrame:
    """Rows that differ between two builds, with how often each side has them.

    One aggregate over both sides instead of two set differences. Rows must have no map columns.
    """
    columns = [c for c in left.columns if c not in ignore]
    both = left.select(*columns, F.lit(1).alias("__side")).unionByName(
        right.select(*columns, F.lit(0).alias("__side"))
    )
    counted = both.groupBy(*columns).agg(
        F.sum("__side").alias("left_rows"), F.sum(1 - F.col("__side")).alias("right_rows")
    )
    return counted.where(F.col("left_rows") != F.col("right_rows"))


def parity_summary(
    left: DataFrame, right: DataFrame, ignore: Sequence[str] = ("inserted_at",)
) -> DataFrame:
    off = parity(left, right, ignore)
    return off.agg(
        F.count("*").alias("differing_rows"),
        F.coalesce(F.sum(F.abs(F.col("left_rows") - F.col("right_rows"))), F.lit(0)).alias(
            "differences"
        ),
    )


def land_contract(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Row count and nulls per required column, in one pass: (column_name, rows, nulls, passed)."""
    required = [f.name for f in schema.fields if not f.nullable]
    row = df.agg(
        F.count("*").alias("__rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in required]
    )
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in required]
    return (
        row.select(F.col("__rows").alias("rows"), F.explode(F.array(*pairs)).alias("p"))
        .select("p.column_name", "rows", "p.nulls")
        .withColumn("passed", (F.col("rows") > 0) & (F.col("nulls") == 0))
    )
