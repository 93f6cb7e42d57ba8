"""Full and incremental refresh of Silver and Gold. Both end in the same rows.

Tables are partitioned by `landed_in`, a period (by default a day) that a key keeps for good once
it is stored. An update therefore rewrites the periods in which a stored row changes, appends new keys
to the others, and never has to remove a row from a period it does not rewrite.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.operators.gold import data_freshness, delay_analysis, delivery_performance
from waybill.operators.latest import collapse_latest, dedup_events, event_rank, event_ties, rank_of
from waybill.operators.partials import delay_analysis_of, delivery_partials, scan_partials
from waybill.operators.quality import dq_gate, model_tests
from waybill.operators.silver import (
    conform_events,
    current_labels,
    flag_by_id,
    flag_labels,
    flag_on_voided,
    orphaned_events,
    stamp,
)
from waybill.schemas import (
    DELIVERY_PERFORMANCE,
    RAW_EVENTS,
    RAW_LABELS,
    SILVER_EVENTS,
    SILVER_LABELS,
)
from waybill.session import configure, freeing_shuffles, shared_folder
from waybill.sources.scratch import CODEC, Scratch, scratch
from waybill.sources.tables import (
    Names,
    conform,
    ensure_schema,
    has_batch_ids,
    land,
    materialize,
    with_ingestion,
)

PERIOD = "landed_in"
NO_TIME = dt.date(1900, 1, 1)
RAW_TIME = "event_at_raw"
_KNOWN = "__known"

#: Keys that a batch may share with a table and still be compared apart from the rest of the batch.
FEW_KEYS = 500_000

LABEL_TIES = [c for c in RAW_LABELS.names if c not in ("label_id", "last_updated_at")]


@dataclass(frozen=True)
class Models:
    """The published tables, read by contract columns only."""

    spark: SparkSession
    names: Names
    grain: str = "day"

    def period(self, time: str) -> Column:
        """Partition of a row that is new: the period (day, month, ...) of its time.

        Rows without one share a period, so that there is never a null to look for.
        """
        return F.coalesce(F.to_date(F.date_trunc(self.grain, time)), F.lit(NO_TIME))

    def gathered(self, rows: DataFrame) -> DataFrame:
        """Rows as they are written to periods: brought together first, so that a period has few files.

        Years are so few that every task writes to each of them, which saves the shuffle.
        """
        return rows if self.grain == "year" else rows.hint("rebalance", F.col(PERIOD))

    def materialize(self, rows: DataFrame, table: str) -> DataFrame:
        """Full refresh of a model that is partitioned by its period."""
        return materialize(self.gathered(rows), table, [PERIOD], gather=False)

    def stored(self, table: str) -> DataFrame:
        """A table as it is now: another session, such as that of a stream, may have written it."""
        self.spark.catalog.refreshTable(table)
        return self.spark.read.table(table)

    @property
    def silver_labels(self) -> DataFrame:
        return self.stored(self.names.silver_labels).select(*SILVER_LABELS)

    @property
    def silver_events(self) -> DataFrame:
        return self.stored(self.names.silver_events).select(*SILVER_EVENTS)

    @property
    def gold(self) -> DataFrame:
        return self.stored(self.names.gold).select(*DELIVERY_PERFORMANCE)

    @property
    def keeps_partials(self) -> bool:
        return self.spark.catalog.tableExists(self.names.periods_due)


def _event_rows(raw_events: DataFrame, labels: DataFrame, run_ts: dt.datetime | None) -> DataFrame:
    """Conformed events, flagged by Silver labels, with the raw time that later merges compare."""
    rows = stamp(conform_events(dedup_events(raw_events)), run_ts)
    return flag_by_id(rows, raw_events, labels).select(*SILVER_EVENTS, RAW_TIME)


def full_refresh(
    models: Models,
    run_ts: dt.datetime | None = None,
    raw: Names | None = None,
    reports: bool = False,
) -> Models:
    """Rebuild Silver and Gold from the raw tables. Each model is read back before the next.

    `raw` says where the raw tables are, if not beside the models; `reports` publishes the reports too.
    """
    spark, names = configure(models.spark), models.names
    raw = raw or names
    summed = _pause_partials(models)
    raw_labels = spark.read.table(raw.raw_labels).select(*RAW_LABELS.names)
    raw_events = spark.read.table(raw.raw_events).select(*RAW_EVENTS.names)

    labels = stamp(flag_labels(current_labels(raw_labels)), run_ts).select(*SILVER_LABELS)
    by_creation = models.period("label_created_at")
    models.materialize(labels.withColumn(PERIOD, by_creation), names.silver_labels)

    events = _event_rows(raw_events, models.silver_labels, run_ts)
    by_receipt = models.period("event_received_at").alias(PERIOD)
    placed = events.select(*SILVER_EVENTS, RAW_TIME, by_receipt)
    models.materialize(placed, names.silver_events)

    mart = delivery_performance(models.silver_labels, models.silver_events, run_ts)
    models.materialize(mart.withColumn(PERIOD, by_creation), names.gold)
    if spark.catalog.tableExists(names.due):
        spark.sql(f"TRUNCATE TABLE {names.due}")
    if summed:
        keep_partials(models)
    if reports:
        publish_reports(models)
    return models


def _partials(names: Names) -> dict[str, tuple[str, Callable[..., DataFrame]]]:
    """Table of partial aggregates -> the layer it sums up, and how."""
    return {
        names.delivery_partials: (names.gold, delivery_partials),
        names.scan_partials: (names.silver_events, scan_partials),
    }


def keep_partials(models: Models) -> None:
    """Build the partial aggregates of the stored layers; from now on batches and refreshes keep them.

    They are partitioned as their layers are. A batch notes the periods it is about to rewrite, and
    afterwards aggregates these anew from the layer, so nothing has to be taken back: extremes and sketches
    are as exact as counts. Its cost is that of the periods it rewrites. The notes outlive a batch that
    broke off, and the next one works them off.
    """
    for table, (layer, build) in _partials(models.names).items():
        materialize(build(models.stored(layer), PERIOD), table, [PERIOD])
    nothing = models.spark.createDataFrame([], f"layer string, {PERIOD} date")
    materialize(nothing, models.names.periods_due)


def _pause_partials(models: Models) -> bool:
    """Stop keeping partial aggregates while whole layers are replaced; whether they were kept.

    A rebuild that breaks off leaves them unkept, and reports then read the layers.
    """
    kept = models.keeps_partials
    models.spark.sql(f"DROP TABLE IF EXISTS {models.names.periods_due}")
    return kept


def _note_periods(models: Models, table: str, periods: set[dt.date]) -> None:
    if models.keeps_partials and table in {layer for layer, _ in _partials(models.names).values()}:
        rows = models.spark.createDataFrame([(table, p) for p in periods], f"layer string, {PERIOD} date")
        rows.coalesce(1).write.format("parquet").mode("append").saveAsTable(models.names.periods_due)


def _renew_partials(models: Models) -> None:
    """Aggregate the noted periods anew. A period of a layer never loses its last row."""
    if not models.keeps_partials:
        return
    noted = models.stored(models.names.periods_due).distinct().collect()  # two layers, days of the calendar
    for table, (layer, build) in _partials(models.names).items():
        periods = sorted(r[PERIOD] for r in noted if r.layer == layer)
        if not periods:
            continue
        rows = build(models.stored(layer).where(F.col(PERIOD).isin(periods)), PERIOD)
        rows = rows.select(*models.stored(table).columns).hint("rebalance", F.col(PERIOD))
        with _replacing_partitions(models.spark):
            rows.write.mode("overwrite").insertInto(table)
    models.spark.sql(f"TRUNCATE TABLE {models.names.periods_due}")


def publish_reports(models: Models) -> None:
    """The second-phase reports as tables, from the stored layers.

    The delay analysis comes from the partial aggregates where they are kept; everything else reads the
    columns it uses, whole.
    """
    if models.keeps_partials:
        delays = delay_analysis_of(models.stored(models.names.delivery_partials))
    else:
        delays = delay_analysis(models.gold)
    materialize(delays, models.names.delay_analysis)
    fresh = data_freshness(models.silver_labels, models.silver_events)
    materialize(fresh, models.names.data_freshness)


def gated_refresh(
    models: Models, run_ts: dt.datetime | None = None, warn_only: bool = False
) -> dict:
    """Build all models apart, test and gate them, and publish only what passes.

    The summary has a status, the number of checks and the names of those that failed. A build
    that fails leaves the published tables as they were, unless `warn_only` publishes it with warnings.
    """
    spark, names = configure(models.spark), models.names
    with freeing_shuffles(spark), throwaway(spark, models.grain) as trial:
        full_refresh(trial, run_ts, raw=names)
        built = trial.silver_labels, trial.silver_events, trial.gold
        tests = model_tests(*built).select(F.concat_ws(".", "model", "column_name", "test"), "passed")
        outcome = tests.union(dq_gate(*built).select("check_name", "passed")).collect()  # one row a check
        failed = sorted(name for name, passed in outcome if not passed)
        status = "success" if not failed else "success_with_warnings" if warn_only else "failed"
        if status != "failed":
            summed = _pause_partials(models)
            for layer, table in (
                (trial.names.silver_labels, names.silver_labels),
                (trial.names.silver_events, names.silver_events),
                (trial.names.gold, names.gold),
            ):
                # The trial's files hold a period each, and so do the copies.
                materialize(trial.stored(layer), table, [PERIOD], gather=False)
            if spark.catalog.tableExists(names.due):
                spark.sql(f"TRUNCATE TABLE {names.due}")
            if summed:
                keep_partials(models)
    return {"status": status, "checks": len(outcome), "failed": failed}


@contextmanager
def _replacing_partitions(spark: SparkSession) -> Iterator[None]:
    """Overwrite only the partitions that are written to, at the commit of the job."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _periods(df: DataFrame, figure: Column | None = None) -> dict[dt.date, object]:
    """The periods in `df` with a figure, by default the rows, of each: at most as many as the calendar has."""
    figure = F.count(F.lit(1)) if figure is None else figure
    return {r[0]: r[1] for r in df.groupBy(PERIOD).agg(figure).collect()}


def _stored_keys(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows of the keys in a batch. `target` should have few columns: all of it is read."""
    if target.isEmpty():
        return target.limit(0)
    return _of_keys(target, batch, keys)


def _of_keys(rows: DataFrame, of: DataFrame, keys: Sequence[str], how: str = "left_semi") -> DataFrame:
    """Rows whose key is in `of`, or, as an anti join, is not. Null keys are equal."""
    ids = of.select(*[F.col(k).alias(f"__{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return rows.join(ids, reduce(Column.__and__, same), how)


def changes(
    models: Models,
    space: Scratch,
    table: str,
    batch: DataFrame,
    keys: Sequence[str],
    home: Column,
    newest: tuple[Sequence, Sequence] | None = None,
    known: DataFrame | None = None,
) -> DataFrame:
    """Rows of a batch that a table lacks, with their period, and whether their key is stored.

    The batch has one row per key and is cheap to read again. Intermediate results go to `space`.
    `home` is the period of a key that is new. `newest` orders old and new rows of a key (order,
    tie-breakers) and tells all of them apart: rows that stored ones equal or beat change nothing and are
    left out. Without it the batch replaces. `known` holds the stored keys of the batch with their
    periods, if they have been looked up already.
    """
    target = models.stored(table)
    if known is None:
        found = _stored_keys(target.select(*keys, PERIOD), batch, keys)
        known = space.write(found.select(*keys, PERIOD), "known")
    periods = _periods(known)
    if not periods:
        return batch.withColumns({PERIOD: home, _KNOWN: F.lit(False)})
    few = sum(periods.values()) <= FEW_KEYS
    if newest is None:
        old = known.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(PERIOD).alias("__old"))
        same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
        placed = batch.join(old, reduce(Column.__and__, same), "left").drop(*[f"__{k}" for k in keys])
    else:
        # Literal values prune the partitions of the target at planning time.
        stored = target.where(F.col(PERIOD).isin(sorted(periods)))
        columns = [c for c in batch.columns if c in target.columns]
        rows = batch.select(*columns)
        if few:
            stored, rows = (_of_keys(r, known, keys) for r in (stored, rows))
        both = stored.select(*columns, F.col(PERIOD).alias("__old")).unionByName(
            rows, allowMissingColumns=True
        )
        # A stored row has a period, a new one has none yet.
        both = both.withColumn("__old_of_key", F.max("__old").over(Window.partitionBy(*keys)))
        order, ties = newest
        placed = collapse_latest(both, keys, order, [*ties, F.col("__old").desc_nulls_last()])
        placed = placed.where(F.col("__old").isNull()).drop("__old").withColumnRenamed("__old_of_key", "__old")
        if few:
            # All other rows have new keys: they meet no stored row and need no shuffle.
            fresh = _of_keys(batch.select(*columns), known, keys, "left_anti")
            placed = space.write(placed, "beating").unionByName(fresh, allowMissingColumns=True)
    marked = placed.withColumns({PERIOD: F.coalesce("__old", home), _KNOWN: F.col("__old").isNotNull()})
    marked = marked.drop("__old")
    return marked if few else space.write(marked, "changes")


def merge(
    models: Models,
    table: str,
    changed: DataFrame,
    keys: Sequence[str],
    finish: Callable[[DataFrame], DataFrame] | None = None,
    also: DataFrame | None = None,
) -> None:
    """Bring `changes` into their table: only periods in which a stored row changes are rewritten.

    Rows of other periods are appended, after that. `finish` brings all rows of the rewritten periods up to
    date before they are written; `also` lists further periods to rewrite.
    """
    spark, target = models.spark, models.stored(table)
    found = _periods(changed, F.bool_or(_KNOWN))
    rewritten = {p for p, has_known in found.items() if has_known}
    if also is not None:
        rewritten |= set(_periods(also))
    periods = set(found) | rewritten
    if not periods:
        return
    columns = [c for c in target.columns if c in changed.columns]
    _note_periods(models, table, periods)

    def write(rows: DataFrame, mode: str) -> None:
        models.gathered(rows.select(*target.columns)).write.mode(mode).insertInto(table)

    in_rewritten = F.col(PERIOD).isin(sorted(rewritten)) if rewritten else F.lit(False)
    if rewritten:
        kept = _of_keys(target.where(in_rewritten), changed.where(_KNOWN), keys, "left_anti")
        with _replacing_partitions(spark):
            rows = kept.select(*columns).unionByName(changed.where(in_rewritten).select(*columns))
            write(rows if finish is None else finish(rows), "overwrite")
    if periods - rewritten:
        write(changed.where(~in_rewritten).select(*columns), "append")


def upsert(
    models: Models,
    space: Scratch,
    table: str,
    batch: DataFrame,
    keys: Sequence[str],
    home: Column,
    newest: tuple[Sequence, Sequence] | None = None,
) -> None:
    """Merge a batch into a table by key; see `changes` and `merge`."""
    merge(models, table, changes(models, space, table, batch, keys, home, newest), keys)


def apply_batch(
    models: Models,
    label_rows: DataFrame | None = None,
    event_rows: DataFrame | None = None,
    run_ts: dt.datetime | None = None,
    late_days: int | None = None,
    batch_id: str | None = None,
    reports: bool = False,
    are_stored: bool = False,
) -> Models:
    """Add new raw rows to the raw tables and bring Silver and Gold up to date.

    A late scan reaches its label, however old: all labels touched by the batch are recomputed from
    Silver. Batches in another order end in the same Silver and Gold rows, and so does a batch
    applied again, wholly or after it broke off midway: labels whose mart row is due are kept in a
    table until it is written. Rows that the stored ones equal or beat are not written again and make no
    label due. There must be one writer at a time.

    With `late_days`, scans that took that long to arrive are also listed in a table of their own.
    Raw tables landed with batch ids need a `batch_id` here too; rows of a batch id that a raw table
    has are not added again, so that a batch applied twice leaves it right as well. `reports` publishes
    the reports anew, which reads their columns whole. Rows that `are_stored` are cheap to read
    several times and are not copied first.
    """
    configure(models.spark)
    with scratch(models.spark) as space:
        # The batch is read several times below; its source is read once.
        if label_rows is not None:
            label_rows = conform(label_rows, RAW_LABELS)
            label_rows = label_rows if are_stored else space.write(label_rows, "label_rows")
        if event_rows is not None:
            event_rows = conform(event_rows, RAW_EVENTS)
            event_rows = event_rows if are_stored else space.write(event_rows, "event_rows")
        has_labels = label_rows is not None and not label_rows.isEmpty()
        has_events = event_rows is not None and not event_rows.isEmpty()
        if not (has_labels or has_events):
            return models
        reflag = None
        if has_labels:
            landed = not _land_once(models, label_rows, models.names.raw_labels, RAW_LABELS, batch_id)
            reflag = _merge_labels(models, space, label_rows, run_ts, landed)
        known = None
        if has_events:
            landed = not _land_once(models, event_rows, models.names.raw_events, RAW_EVENTS, batch_id)
            if late_days is None:
                # A batch whose late scans are listed is needed whole.
                table, rank = models.names.silver_events, event_rank(RAW_TIME)
                event_rows, known = _unsettled(models, space, table, event_rows, "event_id", rank, landed, "label_id")
        else:
            event_rows = models.spark.createDataFrame([], RAW_EVENTS)
        batch = space.write(_event_rows(event_rows, models.silver_labels, run_ts), "events")
        _merge_events(models, space, batch, reflag, known)
        if late_days is not None:
            _list_late(models, space, batch, late_days)
        _recompute_mart(models, space, run_ts)
        _renew_partials(models)
    if reports:
        publish_reports(models)
    return models


def _land_once(
    models: Models, rows: DataFrame, table: str, schema: T.StructType, batch_id: str | None
) -> bool:
    """Append to a raw table, unless it has the batch. The append of one job is seen whole or not."""
    if batch_id is not None:
        stored = models.stored(table)
        if has_batch_ids(stored) and not stored.where(F.col("_ingestion_batch_id") == batch_id).isEmpty():
            return False
    land(rows, table, schema, "append", batch_id)
    return True


def _unsettled(
    models: Models,
    space: Scratch,
    table: str,
    rows: DataFrame,
    key: str,
    rank: Column,
    landed: bool,
    *kept: str,
) -> tuple[DataFrame, DataFrame]:
    """Raw rows of a batch that may change a table, and the stored keys among theirs with their periods.

    Where many keys are stored, raw rows that the stored one of their key equals or beats are left out before
    anything is done to them: `changes` would leave them out at last. `rank` orders the rows of a key.
    A large batch that had been `landed` before is taken to have many stored keys without a look-up.
    `kept` are further columns of the stored keys.
    """
    target = models.stored(table)
    stored = target.select(key, *kept, PERIOD)
    if not (landed and rows.count() > FEW_KEYS):
        stored = space.write(_stored_keys(stored, rows, [key]), "known")
        periods = _periods(stored)
        if sum(periods.values()) <= FEW_KEYS:
            return rows, stored
        # Literal values prune the partitions of the target at planning time.
        target = target.where(F.col(PERIOD).isin(sorted(periods)))
    newest = target.select(F.col(key).alias("__key"), rank.alias("__newest"))
    if RAW_TIME in target.columns:
        rows = rows.withColumn(RAW_TIME, F.col("event_at"))
    settled = F.col(key).eqNullSafe(F.col("__key")) & (F.col("__newest") >= rank)
    rest = space.write(rows.join(newest, settled, "left_anti").drop(RAW_TIME), "unsettled")
    if rest.isEmpty():
        return rest.limit(0), stored.limit(0)
    return rest, space.write(_stored_keys(stored, rest, [key]), "known")


def _merge_labels(
    models: Models, space: Scratch, label_rows: DataFrame, run_ts: dt.datetime | None, landed: bool
) -> DataFrame:
    """Bring Silver labels up to date; the periods of scans to flag anew."""
    table = models.names.silver_labels
    rank = rank_of(["last_updated_at", *LABEL_TIES])
    rows, known = _unsettled(models, space, table, label_rows, "label_id", rank, landed)
    latest = stamp(flag_labels(current_labels(rows)), run_ts).select(*SILVER_LABELS)
    batch = space.write(latest, "labels")
    home = models.period("label_created_at")
    newest = (["last_updated_at"], LABEL_TIES)
    changed = changes(models, space, table, batch, ["label_id"], home, newest, known)
    _mark_due(models, changed)
    merge(models, table, changed, ["label_id"])
    # All labels of the batch: an attempt that broke off may have left scans of theirs wrongly flagged.
    return _wrongly_flagged(models, label_rows.select("label_id"))


def _mark_due(models: Models, rows: DataFrame) -> None:
    """Note labels whose mart row has to be written, before anything of theirs changes."""
    due = rows.select("label_id")
    due.write.format("parquet").option("compression", CODEC).mode("append").saveAsTable(models.names.due)


def _wrongly_flagged(models: Models, ids: DataFrame) -> DataFrame:
    """Periods with stored scans of these labels whose void flag no longer holds."""
    state = models.silver_labels.join(ids, "label_id", "left_semi").select(
        "label_id", F.col("voided_at").isNotNull().alias("__voided")
    )
    scans = models.stored(models.names.silver_events)
    return (
        scans.select("label_id", "is_event_on_voided_label", PERIOD)
        .join(state, "label_id")
        .where(F.col("is_event_on_voided_label") != F.col("__voided"))
        .select(PERIOD)
    )


def _merge_events(
    models: Models, space: Scratch, batch: DataFrame, reflag: DataFrame | None, known: DataFrame | None
) -> None:
    table, keys = models.names.silver_events, ["event_id"]
    if known is None:
        stored = models.stored(table).select("event_id", "label_id", PERIOD)
        known = space.write(_stored_keys(stored, batch, keys), "known")
    home = models.period("event_received_at")
    newest = (["event_received_at"], event_ties(RAW_TIME))
    changed = changes(models, space, table, batch, keys, home, newest, known)
    # A later copy of an event may name another label; the one it leaves is due as well.
    left = _stored_keys(known, changed.where(_KNOWN), keys)
    _mark_due(models, changed.select("label_id").unionByName(left.select("label_id")).distinct())
    merge(
        models,
        table,
        changed,
        keys,
        finish=lambda rows: flag_on_voided(rows, models.silver_labels),
        also=reflag,
    )


def _list_late(models: Models, space: Scratch, batch: DataFrame, late_days: int) -> None:
    table = models.names.late_events
    age = F.col("event_received_at") - F.col("event_at")
    late = batch.where(age >= F.make_dt_interval(days=F.lit(late_days))).drop("is_event_on_voided_label")
    home = models.period("event_received_at")
    if not models.spark.catalog.tableExists(table):
        materialize(late.limit(0).withColumn(PERIOD, home), table, [PERIOD])
    newest = (["event_received_at"], event_ties(RAW_TIME))
    upsert(models, space, table, late, ["event_id"], home, newest)


def _recompute_mart(models: Models, space: Scratch, run_ts: dt.datetime | None) -> None:
    due = space.write(models.stored(models.names.due).distinct(), "due")
    if due.isEmpty():
        return
    labels = models.silver_labels.join(due, "label_id", "left_semi")
    events = models.silver_events.join(due, "label_id", "left_semi")
    mart = space.write(delivery_performance(labels, events, run_ts), "mart")
    home = models.period("label_created_at")
    upsert(models, space, models.names.gold, mart, ["label_id"], home)
    models.spark.sql(f"TRUNCATE TABLE {models.names.due}")


def quarantine_orphans(models: Models, run_ts: dt.datetime | None = None) -> DataFrame:
    """Publish the events without a label as a table, with the time each was first found.

    An event that was in the table keeps its time; one whose label has come leaves.
    """
    table = models.names.orphaned_events
    lost = orphaned_events(models.silver_events, models.silver_labels, run_ts)
    with scratch(models.spark) as space:
        if models.spark.catalog.tableExists(table):
            before = models.stored(table).select("event_id", F.col("detected_at").alias("__since"))
            lost = lost.join(before, "event_id", "left").withColumn(
                "detected_at", F.coalesce("__since", "detected_at")
            )
            lost = lost.drop("__since")
        return materialize(space.write(lost, "orphans"), table)


@contextmanager
def throwaway(spark: SparkSession, grain: str = "year") -> Iterator[Models]:
    """Tables of their own in the shared folder, dropped when the block ends."""
    run = f"run_{uuid.uuid4().hex[:12]}"
    models = Models(spark, Names(prefix=f"{run}_"), grain)
    schemas = [models.names.schema(layer) for layer in ("raw", "silver", "gold")]
    for schema in schemas:
        ensure_schema(spark, schema, f"{shared_folder(spark)}/waybill/{run}/{schema}")
    try:
        yield models
    finally:
        for schema in schemas:
            spark.sql(f"DROP SCHEMA IF EXISTS {schema} CASCADE")


def start_empty(models: Models, with_ids: bool = False) -> Models:
    """Create all tables with no rows, for a run that is incremental from the start.

    With ids, the raw tables have the columns of landing with a batch id.
    """
    spark, names = models.spark, models.names
    for layer in ("raw", "silver", "gold"):
        ensure_schema(spark, names.schema(layer))
    for table, schema in ((names.raw_labels, RAW_LABELS), (names.raw_events, RAW_EVENTS)):
        rows = spark.createDataFrame([], schema)
        rows = with_ingestion(rows, "") if with_ids else rows
        rows.write.format("parquet").option("compression", CODEC).mode("ignore").saveAsTable(table)
    return full_refresh(models)
