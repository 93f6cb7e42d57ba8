"""Reports put together from partial aggregates equal those of a rebuild."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import at, event, label, same_rows
from tests.test_refresh import fresh, small_log
from waybill.operators import gold, partials
from waybill.operators.profile import arrival_latency
from waybill.plans import refresh
from waybill.plans.refresh import apply_batch, full_refresh, keep_partials, publish_reports, start_empty


def started(spark, grain="day"):
    models = start_empty(fresh(spark, grain))
    keep_partials(models)
    return models


def assert_reports(models):
    """All reports from the stored partial aggregates against the layers read whole."""
    sums = models.stored(models.names.delivery_partials)
    by = ["carrier", "service_class"]
    assert same_rows(partials.on_time_of(sums, by), gold.on_time_by(models.gold, by))
    assert same_rows(partials.on_time_of(sums), gold.on_time_summary(models.gold))
    assert same_rows(partials.on_time_rollup_of(sums, by), gold.on_time_rollup(models.gold, by))
    assert same_rows(partials.delay_analysis_of(sums), gold.delay_analysis(models.gold))
    most = sums.agg(F.max("most_days_late")).first()[0]
    late = gold.with_days_late(models.gold).where(gold.is_late())
    assert most == late.agg(F.max("days_late")).first()[0]
    scans = models.stored(models.names.scan_partials)
    # So few scans are all in the sketches: labels and quantiles are exact.
    levels = {"p50": 0.5, "p95": 0.95}
    found = partials.scans_of(scans, levels=levels).where("timed > 0")
    exact = arrival_latency(models.silver_events)
    assert same_rows(
        found.select(F.col("timed").alias("events"), *[c for c in exact.columns if c != "events"]), exact
    )
    labels = models.silver_events.groupBy("carrier").agg(F.count_distinct("label_id").alias("labels"))
    assert same_rows(partials.scans_of(scans).select("carrier", "labels"), labels)


def test_reports_after_each_batch(spark, labels_of, events_of):
    labels, events = small_log()
    models = started(spark)
    for part in range(3):
        apply_batch(models, labels_of(*labels[part::3]), events_of(*events[part::3]))
        assert_reports(models)
    publish_reports(models)
    assert same_rows(models.stored(models.names.delay_analysis), gold.delay_analysis(models.gold))


def test_the_next_batch_works_off_one_that_broke_off(spark, labels_of, events_of, monkeypatch):
    models = started(spark)
    day = "2026-06-{:02d} 00:00:00".format
    first = [label(f"l{i}", label_created_at=at(day(i))) for i in range(1, 5)]
    scans = [event(f"e{i}", f"l{i}", event_received_at=at(day(10 + i))) for i in range(1, 5)]
    apply_batch(models, labels_of(*first[:3]), events_of(*scans[:3]))

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as broken:
        broken.setattr(refresh, "_renew_partials", lost)
        with pytest.raises(RuntimeError):
            late = event("e9", "l1", event_at="2026-06-20T10:30:00Z", event_received_at=at(day(21)))
            apply_batch(models, event_rows=events_of(late))
    apply_batch(models, labels_of(first[3]), events_of(scans[3]))
    assert models.stored(models.names.periods_due).isEmpty()
    assert_reports(models)


def test_only_touched_periods_are_aggregated_again(spark, labels_of, events_of):
    models = started(spark)
    day = "2026-06-{:02d} 00:00:00".format
    rows = [label(f"l{i}", label_created_at=at(day(i))) for i in range(1, 6)]
    scans = [event(f"e{i}", f"l{i}", event_received_at=at(day(10 + i))) for i in range(1, 6)]
    apply_batch(models, labels_of(*rows), events_of(*scans))
    tables = models.names.delivery_partials, models.names.scan_partials

    def files():
        return [set(models.stored(t).inputFiles()) for t in tables]

    before = files()
    apply_batch(models, event_rows=events_of(event("e9", "l2", event_received_at=at(day(13)))))
    for old, new, period in zip(before, files(), ("2026-06-02", "2026-06-13")):
        assert len(old) == len(new) == 5
        assert {f.split("landed_in=")[1][:10] for f in old - new} == {period}
    assert_reports(models)


def test_a_rebuild_renews_and_one_that_breaks_off_stops(spark, labels_of, events_of, monkeypatch):
    models = started(spark)
    apply_batch(models, labels_of(label()), events_of(event()))
    full_refresh(models)
    assert models.keeps_partials
    assert_reports(models)

    def lost(*_):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(refresh, "keep_partials", lost)
    with pytest.raises(RuntimeError):
        full_refresh(models)
    assert not models.keeps_partials
    publish_reports(models)
    assert same_rows(models.stored(models.names.delay_analysis), gold.delay_analysis(models.gold))


def test_any_span_null_carriers_and_no_rows(spark, events_of):
    rows = [
        {"event_id": f"e{i}", "label_id": f"l{i % 7}", "carrier": carrier, "day": i % 3,
         "event_at": at("2026-06-06 10:00:00") if i % 5 else None,
         "event_received_at": at(f"2026-06-06 10:{i % 60:02d}:00")}
        for i in range(120) for carrier in ("UPS", None)
    ]
    schema = "event_id string, label_id string, carrier string, day int, event_at timestamp, event_received_at timestamp"
    events = spark.createDataFrame([tuple(r.values()) for r in rows], schema)
    stored = partials.scan_partials(events, "day")
    for span in ([0], [0, 2], [0, 1, 2]):
        inside = events.where(F.col("day").isin(span))
        found = partials.scans_of(stored.where(F.col("day").isin(span)), levels={"p50": 0.5, "p95": 0.95})
        exact = arrival_latency(inside)
        same = [c for c in exact.columns if c != "events"]
        assert same_rows(found.select(*same), exact.select(*same))
        verdict = partials.estimates_hold(found, inside, {"p50": 0.5, "p95": 0.95}).collect()
        assert len(verdict) == 2 and all(r.labels_hold and r.p50_holds and r.p95_holds for r in verdict)
    assert partials.scans_of(stored.limit(0)).collect() == []
    unread = events.withColumn("event_at", F.lit(None).cast("timestamp"))
    for r in partials.scans_of(partials.scan_partials(unread, "day")).collect():
        assert (r.scans, r.timed, r.p50_seconds, r.avg_seconds) == (120, 0, None, None)


def test_sketches_of_many_rows_stay_within_their_bounds(spark):
    events = spark.range(200_000).select(
        F.concat(F.lit("e"), "id").alias("event_id"),
        (F.col("id") % 50_000).cast("string").alias("label_id"),
        F.when(F.col("id") % 3 == 0, "UPS").otherwise("USPS").alias("carrier"),
        (F.col("id") % 20).cast("int").alias("day"),
        F.timestamp_seconds(F.lit(0)).alias("event_at"),
        F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(10**7))).alias("event_received_at"),
    )
    found = partials.scans_of(partials.scan_partials(events, "day"))
    for r in partials.estimates_hold(found, events).collect():
        assert r.labels_hold and r.p50_holds and r.p95_holds and r.p99_holds
    # The check can fail: a wrong estimate is out of bounds.
    wrong = found.withColumns({"labels": F.col("labels") * 2, "p50_seconds": F.col("p50_seconds") * 2})
    for r in partials.estimates_hold(wrong, events).collect():
        assert not r.labels_hold and not r.p50_holds and r.p95_holds
