import pytest
from pyspark.sql import functions as F

from tests.conftest import at, event, label, same_rows
from waybill.operators import gold, quality, silver
from waybill.schemas import RAW_LABELS
from waybill.sources.parcels import raw_events, raw_labels, table

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def layers(spark):
    orders, items = table(spark, FOLDER, "orders"), table(spark, FOLDER, "lineitem")
    labels = silver.silver_labels(raw_labels(orders)).cache()
    events = silver.silver_events(raw_events(orders, items), labels)
    events = silver.drop_orphans(events, labels).cache()
    kept = labels, events, gold.delivery_performance(labels, events).cache()
    yield kept
    for df in kept:
        df.unpersist()


def verdicts(df) -> dict:
    return {r.check_name[:2]: r.passed for r in df.collect()}


def test_column_tests(spark):
    rows = [(1, "a"), (1, "b"), (None, "c"), (None, None), (2, "z")]
    df = spark.createDataFrame(rows, "k int, v string")
    assert [tuple(r) for r in quality.unique(df, "k").collect()] == [(1, 2)]
    assert quality.not_null(df, "k").count() == 2
    parents = spark.createDataFrame([(1,)], "id int")
    assert [r.k for r in quality.relationships(df, "k", parents, "id").collect()] == [2]
    rogue = quality.accepted_values(df, "v", ["a", "b", "c"])
    assert [tuple(r) for r in rogue.collect()] == [("z", 1)]


def test_gate_passes_on_sound_layers(layers):
    results = quality.dq_gate(*layers)
    assert results.count() == 14
    failed = {k for k, ok in verdicts(results).items() if not ok}
    # At this size one carrier has too few scans to show all shapes; nothing may fail on integrity.
    assert not failed & {"1a", "2a", "2b", "2c", "3a", "4a", "4e"}


BREAKS = {
    "1a": ("events", lambda df: df.withColumn("event_name", F.lit("0300"))),
    "1b": ("events", lambda df: df.where("event_name <> 'in_transit' or carrier <> 'UPS'")),
    "1c": ("events", lambda df: df.withColumn("event_at", F.lit(None).cast("timestamp"))),
    "1d": ("events", lambda df: df.withColumn("is_malformed_timestamp", F.lit(True))),
    "2a": ("events", lambda df: df.union(df.limit(1))),
    "2b": ("events", lambda df: df.withColumn("label_id", F.lit("nowhere"))),
    "2c": ("labels", lambda df: df.union(df.limit(1))),
    "3a": (
        "events",
        lambda df: df.withColumn("event_at", F.lit("1970-01-01 00:00:00").cast("timestamp")),
    ),
    "4a": ("gold", lambda df: df.union(df.limit(1))),
    "4b": ("gold", lambda df: df.withColumn("is_delivered_on_time", F.lit(False))),
    "4c": ("gold", lambda df: df.withColumn("is_delivered_on_time", F.lit(False))),
    "4d": ("gold", lambda df: df.withColumn("is_delivered_on_time", F.col("is_delivered"))),
    "4e": ("gold", lambda df: df.withColumn("is_delivered", F.lit(False))),
    "4f": ("gold", lambda df: df.withColumn("is_delivered_on_time", F.lit(True))),
}


@pytest.mark.parametrize("check", BREAKS)
def test_each_check_can_fail(layers, check):
    parts = dict(zip(("labels", "events", "gold"), layers))
    which, spoil = BREAKS[check]
    parts[which] = spoil(parts[which])
    results = quality.dq_gate(parts["labels"], parts["events"], parts["gold"])
    assert verdicts(results)[check] is False
    with pytest.raises(quality.GateFailed, match=check):
        quality.enforce(results)


def test_gate_on_empty_tables_fails_but_does_not_crash(layers):
    empty = [df.limit(0) for df in layers]
    found = verdicts(quality.dq_gate(*empty))
    assert len(found) == 14 and not found["1c"] and not found["4b"] and found["2b"]


def test_enforce_counts_checks(layers):
    passing = quality.dq_gate(*layers).withColumn("passed", F.lit(True))
    assert quality.enforce(passing) == 14


def test_model_tests(layers):
    rows = quality.model_tests(*layers).collect()
    assert len(rows) == 10 and all(r.passed for r in rows)
    labels, events, mart = layers
    spoiled = quality.model_tests(labels, events.union(events.limit(1)), mart).collect()
    assert {(r.model, r.test) for r in spoiled if not r.passed} == {("silver_events", "unique")}


def test_parity(layers):
    mart = layers[2]
    assert same_rows(mart, mart.repartition(3))
    changed = mart.withColumn(
        "is_delivered", F.col("is_delivered") & (F.col("carrier") != "DHL_ECOM")
    )
    moved = mart.where("is_delivered and carrier = 'DHL_ECOM'").count()
    summary = quality.parity_summary(mart, changed).first()
    assert (summary.differing_rows, summary.differences) == (2 * moved, 2 * moved)
    twice = mart.union(mart.limit(1))
    assert quality.parity_summary(mart, twice).first().differences == 1


def test_snapshot_is_stable(layers):
    again = gold.delivery_performance(*layers[:2])
    first, second = (quality.idempotency_snapshot(g).first() for g in (layers[2], again))
    assert first == second and first.rows == 1500


def test_land_contract(labels_of):
    raw = labels_of(label("a"), label("b"))
    assert all(r.passed for r in quality.land_contract(raw, RAW_LABELS).collect())
    holed = raw.withColumn("carrier", F.when(F.col("label_id") == "a", F.col("carrier")))
    found = quality.land_contract(holed, RAW_LABELS)
    assert [r.column_name for r in found.where("not passed").collect()] == ["carrier"]
    empty = quality.land_contract(raw.limit(0), RAW_LABELS).collect()
    assert len(empty) == 10 and not any(r.passed for r in empty)


def test_early_delivery_is_counted_once(labels_of, events_of):
    labels = silver.silver_labels(labels_of(label("l1")))
    raw = events_of(
        event("e1", event_at="2026-05-31T00:00:00Z"),
        event("e2", event_at="2026-06-02T00:00:00Z", event_received_at=at("2026-06-02 00:00:00")),
        event("e3", "nowhere"),
    )
    events = silver.silver_events(raw, labels)
    row = quality.gate_metrics(labels, events, gold.delivery_performance(labels, events)).first()
    assert (row.early, row.orphans, row.events, row.event_ids) == (1, 1, 3, 3)
