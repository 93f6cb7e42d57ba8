import datetime as dt

import pytest

from tests.conftest import at, event, label
from waybill.operators import profile, silver


@pytest.fixture(scope="module")
def raw(labels_of, events_of):
    labels = labels_of(
        label("l1"),
        label("l1", carrier="USPS", last_updated_at=at("2026-06-01 05:00:00")),
        label("l1", carrier="USPS", service_class="X", last_updated_at=at("2026-06-01 09:00:00")),
        label(
            "l2",
            voided_at=at("2026-06-01 00:30:00"),
            last_updated_at=at("2026-06-01 00:30:00"),
            service_class="UPS_2ND_DAY",
        ),
        label(
            "l3", voided_at=at("2026-06-04 00:00:00"), last_updated_at=at("2026-06-04 00:00:00")
        ),
        label("l4", carrier="FEDEX"),
    )
    def scan(event_id, label_id, kind, day, received):
        return event(
            event_id,
            label_id,
            event_type=kind,
            event_at=f"2026-06-{day:02d}T00:00:00Z",
            event_received_at=at(f"2026-06-{received}"),
        )

    events = events_of(
        scan("a", "l1", "PICKUP", 2, "02 00:00:05"),
        scan("b", "l1", "IN_TRANSIT", 3, "09 00:00:00"),
        scan("c", "l1", "OUT_FOR_DELIVERY", 4, "04 00:00:10"),
        scan("d", "l1", "DELIVERED", 5, "05 00:00:00"),
        scan("e", "l3", "PICKUP", 3, "03 00:00:00"),
        scan("f", "l3", None, 5, "11 00:00:00"),
        event("g", "nowhere", event_at="2026-06-05T00:00:00 HST", location_zip=None),
        event("h", "l4", event_at="junk"),
        event("h", "l4", event_at="junk", event_received_at=at("2026-06-01 00:00:00")),
    )
    return labels, events


@pytest.fixture(scope="module")
def layers(raw):
    labels = silver.silver_labels(raw[0])
    return labels, silver.silver_events(raw[1], labels)


def test_rates(raw, layers):
    found = {r.metric: (r.n, r.total) for r in profile.dq_profile(*raw, *layers).collect()}
    assert found["raw_labels.changed"] == (1, 4)
    assert found["silver_labels.voided"] == (2, 4)
    assert found["silver_labels.void_flag"] == (1, 4)
    assert found["raw_events.repeated_id"] == (1, 9)
    assert found["raw_events.unknown_zone"] == (1, 9)
    assert found["raw_events.no_location"] == (1, 9)
    assert found["silver_events.missing_event_type"] == (1, 8)
    assert found["silver_events.unreadable_timestamp"] == (1, 8)
    assert found["silver_events.delivery_unreadable"] == (1, 8)
    assert found["silver_events.on_voided_label"] == (2, 8)
    assert found["silver_events.late_arrival"] == (2, 8)
    assert found["silver_events.orphan"] == (1, 8)


def test_order_of_arrival(layers):
    ranked = {r.event_id: r for r in profile.out_of_order(layers[1]).collect()}
    assert "h" not in ranked
    assert {k for k, r in ranked.items() if r.is_out_of_order} == {"b", "c", "d"}
    assert (ranked["b"].event_rank, ranked["b"].arrival_rank) == (2, 4)


def test_latency(layers):
    rows = {r.carrier: r for r in profile.arrival_latency(layers[1]).collect()}
    assert rows["UPS"].events == 7 and rows["UPS"].late == 2
    assert rows["UPS"].max_seconds == 6 * 86400


def test_late_arrivals(layers):
    labels, events = layers
    late = profile.late_arrivals(events, labels)
    assert [r.event_id for r in late.where("is_late_arrival").collect()] == ["f"]


def test_sequence(layers):
    rows = {r.label_id: r for r in profile.sequence_completeness(*layers).collect()}
    assert rows["l1"].is_complete and not rows["l1"].is_stuck
    assert rows["l2"].furthest_stage == "none" and not rows["l2"].is_stuck
    assert (rows["l3"].furthest_stage, rows["l3"].stages_seen) == ("picked_up", 1)
    assert rows["l4"].delivered and not rows["l4"].is_complete


def test_promises(layers):
    rows = {r.service_class: r for r in profile.promise_audit(layers[0]).collect()}
    assert rows["UPS_GROUND"].kept_to_sla == 2
    assert rows["UPS_2ND_DAY"].looser == 1
    assert not rows["X"].has_sla and rows["X"].labels == 1


def test_changes(raw):
    rows = profile.change_history(raw[0]).where("label_id = 'l1'").orderBy("last_updated_at")
    flags = [
        (r.is_first, r.changed_carrier, r.changed_service_class, r.changed_voided_at)
        for r in rows.collect()
    ]
    assert flags == [
        (True, False, False, False),
        (False, True, False, False),
        (False, False, True, False),
    ]


def test_voids(layers):
    rows = {r.void_kind: r for r in profile.void_profile(*layers).collect()}
    assert (rows["immediate"].labels, rows["immediate"].scans) == (1, 0)
    late = rows["late"]
    assert (late.labels, late.scans, late.scans_after_void) == (1, 2, 1)
    assert late.labels_scanned_after_void == 1


def test_mix(layers):
    rows = {r.carrier: r for r in profile.mix_check(layers[0], {"UPS": 0.5, "TNT": 0.5}).collect()}
    assert rows["UPS"].within_tolerance
    assert (rows["TNT"].labels, rows["TNT"].within_tolerance) == (0, False)
    assert rows["FEDEX"].target_pct == 0.0 and not rows["FEDEX"].within_tolerance


def test_formats(labels_of):
    good = label(
        "lbl_" + "0" * 24, customer_id="cust_" + "a" * 12, origin_zip="01234", weight_oz=1120
    )
    bad = label(
        "lbl_x",
        customer_id="cust_",
        carrier="TNT",
        service_class="UPS_AIR",
        origin_zip="1234",
        dest_zip="12345-6789",
        weight_oz=0,
        declared_value_cents=-1,
        carrier_promised_delivery_at=at("2026-06-01 00:00:00"),
        last_updated_at=at("2026-05-01 00:00:00"),
    )
    rows = profile.format_contract(labels_of(good, bad)).collect()
    assert {r.rule: (r.broken, r.total) for r in rows} == {r.rule: (1, 2) for r in rows}
    assert len(rows) == 11 and all(r.pct_broken == 50.0 for r in rows)


def test_stamp_is_utc(layers):
    stamped = silver.stamp(layers[0], dt.datetime(2026, 7, 1, 12))
    shown = stamped.selectExpr("cast(inserted_at as string) as t").first().t
    assert shown == "2026-07-01 12:00:00"
