import datetime as dt

import pytest

from tests.conftest import at, event, label, same_rows
from waybill.operators import gold, silver
from waybill.schemas import DELIVERY_PERFORMANCE

PROMISE = "2026-06-08T00:00:00Z"


@pytest.fixture(scope="module")
def layers(labels_of, events_of):
    labels = silver.silver_labels(
        labels_of(
            label("on_time"),
            label("late"),
            label("never", carrier="USPS", service_class="USPS_STANDARD"),
            label("unreadable"),
            label("twice", origin_zip="94105", dest_zip="10001"),
            label("in_transit", weight_oz=1100),
        )
    )
    events = silver.silver_events(
        events_of(
            event("1", "on_time", event_at=PROMISE),
            event("2", "late", event_at="2026-06-08T00:00:01Z"),
            event("3", "unreadable", event_at="junk"),
            event("4", "twice", event_at="2026-06-05T00:00:00Z"),
            event("5", "twice", event_at="2026-06-10T12:00:00Z"),
            event("6", "twice", event_at="2026-06-10T12:00:00Z"),
            event("7", "in_transit", event_type="IN_TRANSIT", event_at="2026-06-03T00:00:00Z"),
            event("8", "orphan"),
        ),
        labels,
    )
    return labels, events


def test_mart(layers):
    mart = gold.delivery_performance(*layers)
    assert mart.columns == DELIVERY_PERFORMANCE
    rows = {r.label_id: (r.is_delivered, r.is_delivered_on_time) for r in mart.collect()}
    assert rows == {
        "on_time": (True, True),
        "late": (True, False),
        "never": (False, False),
        "unreadable": (False, False),
        "twice": (True, False),
        "in_transit": (False, False),
    }


def test_latest_delivery_counts(layers):
    times = {r.label_id: r.actual_delivery_at for r in gold.latest_delivery(layers[1]).collect()}
    assert times["twice"] == dt.datetime(2026, 6, 10, 12)
    assert times["unreadable"] is None
    assert "in_transit" not in times


def test_on_time_shares(layers):
    mart = gold.delivery_performance(*layers)
    row = gold.on_time_summary(mart).first()
    assert (row.labels, row.delivered, row.on_time) == (6, 3, 1)
    assert row.pct_on_time == pytest.approx(100 / 6)
    assert row.pct_on_time_of_delivered == pytest.approx(100 / 3)
    by = {r.carrier: r for r in gold.on_time_by(mart, ["carrier"]).collect()}
    assert by["UPS"].labels == 5 and by["USPS"].pct_on_time_of_delivered is None
    rolled = gold.on_time_rollup(mart, ["carrier", "service_class"]).collect()
    assert {(r.carrier, r.service_class): r.labels for r in rolled} == {
        ("ALL", "ALL"): 6,
        ("UPS", "ALL"): 5,
        ("USPS", "ALL"): 1,
        ("UPS", "UPS_GROUND"): 5,
        ("USPS", "USPS_STANDARD"): 1,
    }


def test_empty_mart_gives_null_shares(layers):
    row = gold.on_time_summary(gold.delivery_performance(*layers).limit(0)).first()
    assert row.labels == 0 and row.pct_on_time is None


def test_details(layers):
    details = gold.delivery_details(*layers)
    rows = {r.label_id: r for r in details.collect()}
    assert {k: r.days_late for k, r in rows.items()} == {
        "on_time": 0,
        "late": 0,
        "never": None,
        "unreadable": None,
        "twice": 2,
        "in_transit": None,
    }
    assert rows["twice"].event_count == 3 and rows["twice"].logical_event_count == 2
    assert rows["never"].event_count == 0 and rows["never"].days_to_first_scan is None
    assert rows["twice"].days_to_first_scan == 4
    issues = {k for k, r in rows.items() if r.has_data_quality_issues}
    assert issues == {"unreadable", "in_transit"}
    shared = [c for c in DELIVERY_PERFORMANCE if c != "inserted_at"]
    assert same_rows(details.select(*shared), gold.delivery_performance(*layers).select(*shared))


def test_delay_reports(layers):
    mart = gold.delivery_performance(*layers)
    rows = {
        (r.carrier, r.origin_region): (r.labels, r.late, r.avg_days_late)
        for r in gold.delay_analysis(mart).collect()
    }
    assert rows == {
        ("UPS", "100"): (4, 1, 0.0),
        ("UPS", "941"): (1, 1, 2.0),
        ("USPS", "100"): (1, 0, None),
    }
    clusters = gold.delay_clusters(mart).collect()
    totals: dict[str, int] = {}
    for r in clusters:
        totals[r.dimension] = totals.get(r.dimension, 0) + r.labels
    assert totals == {"origin_region": 6, "lane": 6, "weekday": 6, "service_class": 6}
    assert {r.cluster for r in clusters if r.dimension == "lane"} == {"100>941", "941>100"}
    # 1 June 2026 is a Monday.
    assert {r.cluster for r in clusters if r.dimension == "weekday"} == {"1"}


def test_freshness(layers):
    as_of = dt.datetime(2026, 6, 11, 0, 0, 1)
    fresh = gold.data_freshness(*layers, as_of=as_of).collect()
    assert [(r.age_bucket, r.labels, r.tracked, r.recent) for r in fresh] == [
        ("3: 7-13 days", 6, 4, 2)
    ]
    early = gold.data_freshness(*layers, as_of=dt.datetime(2026, 5, 1))
    assert early.isEmpty()
