import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import as_dicts, at, event, label, same_rows
from waybill.functions.flags import canonical_event_name
from waybill.functions.payload import parse_payload
from waybill.operators import latest, silver
from waybill.schemas import RAW_EVENTS, SILVER_EVENTS, SILVER_LABELS

CREATED = at("2026-06-01 00:00:00")


@pytest.mark.parametrize(
    "changed, flag, expected",
    [
        ({"weight_oz": 999}, "can_be_weight_fraud", False),
        ({"weight_oz": 1000}, "can_be_weight_fraud", True),
        ({"weight_oz": 1120}, "can_be_weight_fraud", True),
        ({"weight_oz": 1121}, "can_be_weight_fraud", False),
        ({"voided_at": None}, "can_be_void_fraud", False),
        ({"voided_at": CREATED + dt.timedelta(days=1)}, "can_be_void_fraud", False),
        ({"voided_at": CREATED + dt.timedelta(days=1, seconds=1)}, "can_be_void_fraud", True),
        ({"declared_value_cents": 0}, "can_be_insurance_anomaly", True),
        ({"declared_value_cents": 1}, "can_be_insurance_anomaly", False),
        ({"declared_value_cents": None}, "can_be_insurance_anomaly", False),
    ],
)
def test_label_flags(labels_of, changed, flag, expected):
    row = silver.silver_labels(labels_of(label(**changed))).first()
    assert row[flag] is expected


def test_missing_zip(labels_of):
    raw = labels_of(label("a"), label("b"), label("c"))
    holed = raw.withColumn("origin_zip", F.when(F.col("label_id") != "a", F.col("origin_zip")))
    holed = holed.withColumn("dest_zip", F.when(F.col("label_id") != "b", F.col("dest_zip")))
    rows = silver.silver_labels(holed).collect()
    assert {r.label_id: r.can_be_missing_zip for r in rows} == {"a": True, "b": True, "c": False}


def test_current_label_is_the_latest_image(labels_of):
    raw = labels_of(
        label("l1", carrier="UPS"),
        label("l1", carrier="USPS", last_updated_at=at("2026-06-03 00:00:00")),
        label("l1", carrier="FEDEX", last_updated_at=at("2026-06-02 00:00:00")),
        label("l2"),
    )
    out = silver.silver_labels(raw, dt.datetime(2026, 7, 1))
    assert out.columns == SILVER_LABELS
    assert {r.label_id: r.carrier for r in out.collect()} == {"l1": "USPS", "l2": "UPS"}
    assert {r.inserted_at for r in out.collect()} == {dt.datetime(2026, 7, 1)}


def test_ties_are_settled_the_same_way_whatever_the_order(labels_of):
    rows = [label("l1", customer_id=f"c{i}", weight_oz=i) for i in range(20)]
    forward = silver.current_labels(labels_of(*rows))
    backward = silver.current_labels(labels_of(*reversed(rows)).repartition(7))
    assert same_rows(forward, backward)
    assert forward.first().customer_id == "c9"


def test_collapse_is_idempotent(labels_of):
    newer = label("l1", last_updated_at=at("2026-06-02 00:00:00"))
    raw = labels_of(label("l1"), newer, label("l2"))
    once = silver.current_labels(raw)
    assert same_rows(once, silver.current_labels(once))


def test_dedup_keeps_the_copy_received_last(events_of):
    raw = events_of(
        event("e1", event_type="PICKUP"),
        event("e1", event_type="IN_TRANSIT", event_received_at=at("2026-06-09 00:00:00")),
        event("e2"),
    )
    kept = {r.event_id: r.event_type for r in latest.dedup_events(raw).collect()}
    assert kept == {"e1": "IN_TRANSIT", "e2": "DELIVERED"}


def test_dedup_tie(events_of):
    raw = events_of(
        event("e1", event_at="2026-06-06T10:30:00Z", location_zip=None),
        event("e1", event_at="2026-06-06T10:30:00Z", location_zip="00001"),
        event("e1", event_at="2026-06-06T09:30:00Z", location_zip="99999"),
    )
    assert latest.dedup_events(raw).first().location_zip == "00001"


def test_event_names(spark):
    rows = [
        ("0300", None, "picked_up"),
        (None, "PICKUP", "picked_up"),
        ("PU", None, "picked_up"),
        ("0301", None, "in_transit"),
        (None, "IN_TRANSIT", "in_transit"),
        ("IT", None, "in_transit"),
        ("0310", None, "out_for_delivery"),
        (None, "OUT_FOR_DELIVERY", "out_for_delivery"),
        ("OFD", None, "out_for_delivery"),
        ("0320", None, "delivered"),
        (None, "DELIVERED", "delivered"),
        ("DL", None, "delivered"),
        (None, "PU", "picked_up"),
        ("PICKUP", "DELIVERED", "picked_up"),
        ("RETURNED", "DELIVERED", "unknown"),
        (None, "delivered", "unknown"),
        (None, None, "unknown"),
    ]
    df = spark.createDataFrame(rows, "code string, kind string, wanted string")
    name = canonical_event_name(F.col("code"), F.col("kind"))
    assert df.where(name != F.col("wanted")).isEmpty()


def test_silver_events(labels_of, events_of):
    labels = silver.silver_labels(
        labels_of(label("l1"), label("l2", voided_at=at("2026-06-02 00:00:00")))
    )
    raw = events_of(
        event("e1", "l1"),
        event("e2", "l2", event_type=None, event_at="2026-06-06"),
        event("e3", "nowhere", event_at="garbage"),
    )
    out = silver.silver_events(raw, labels)
    assert out.columns == SILVER_EVENTS
    rows = {r.event_id: r for r in out.collect()}
    assert len(rows) == 3
    flags = ["is_malformed_timestamp", "is_missing_event_type", "is_event_on_voided_label"]
    assert [rows["e1"][f] for f in flags] == [False, False, False]
    assert [rows["e2"][f] for f in flags] == [True, True, True]
    assert [rows["e3"][f] for f in flags] == [True, False, False]
    assert rows["e3"].event_at is None and rows["e2"].event_name == "unknown"


def test_orphans_are_split_off(labels_of, events_of):
    labels = silver.silver_labels(labels_of(label("l1")))
    events = silver.silver_events(events_of(event("e1"), event("e2", "nowhere")), labels)
    lost = silver.orphaned_events(events, labels, dt.datetime(2026, 7, 1))
    assert as_dicts(lost, "event_id", "detected_at") == [
        {"event_id": "e2", "detected_at": dt.datetime(2026, 7, 1)}
    ]
    assert [r.event_id for r in silver.drop_orphans(events, labels).collect()] == ["e1"]


def test_logical_duplicates(labels_of, events_of):
    labels = silver.silver_labels(labels_of(label("l1")))
    raw = events_of(
        event("e1"),
        event("e2", event_received_at=at("2026-06-07 00:00:00")),
        event("e3", event_type="PICKUP"),
        event("e4", event_at="junk"),
        event("e5", event_at="junk"),
    )
    events = silver.silver_events(raw, labels)
    kept = {r.event_id for r in latest.dedup_logical(events).collect()}
    assert kept == {"e2", "e3", "e4", "e5"}
    assert [r.copies for r in latest.logical_duplicates(events).collect()] == [2]


def test_payload(spark):
    df = spark.createDataFrame([('{"k": 1}',), ("{oops",), ("{}",), (None,)], "p string")
    rows = parse_payload(df, "p", spark.createDataFrame([], "k bigint").schema)
    found = {r.p: (r.payload.k, r.is_unparsable_payload) for r in rows.collect()}
    assert found == {
        '{"k": 1}': (1, False),
        "{oops": (None, True),
        "{}": (None, False),
        None: (None, False),
    }


def test_flags_by_id_need_no_second_shuffle_of_events(spark, labels_of, events_of):
    """same flags as from the join by label, also of null ids and labels and of ids with several labels."""
    noon = at("2026-06-03 12:00:00")
    labels = silver.silver_labels(labels_of(label("l1", voided_at=noon), label("l2"), label("l3", voided_at=noon)))
    scans = [event("e1"), event("e1", "l2", event_received_at=noon), event("e2", "l3"), event("e2", "l3"), event("e3", "nowhere"), event("e4", None)]
    scans += [event(None, "l3"), event(None, "l2", event_received_at=noon)]
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in RAW_EVENTS])
    raw = spark.createDataFrame([tuple(r[n] for n in RAW_EVENTS.names) for r in scans], nullable)
    events = latest.dedup_events(raw)
    by_id = silver.flag_by_id(events, raw, labels)
    assert same_rows(by_id, silver.flag_on_voided(events, labels))
    assert {r.event_id: r.is_event_on_voided_label for r in by_id.collect()}["e2"]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = silver.flag_by_id(events, raw, labels)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    with_id = plan[: plan.rindex("isnull(event_id")]
    joined = next(line for line in with_id.splitlines() if "LeftOuter" in line)
    assert "[event_id" in joined and "[label_id" not in joined
