from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from waybill.schemas import RAW_EVENTS, RAW_LABELS  # noqa: E402
from waybill.session import local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = local_session(
        8,
        "tests",
        **{
            "spark.sql.warehouse.dir": str(warehouse),
            "spark.sql.shuffle.partitions": "3",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    yield session
    session.stop()


def at(text: str) -> dt.datetime:
    """A UTC instant."""
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


def label(label_id: str = "l1", **changed) -> dict:
    row = {
        "label_id": label_id,
        "customer_id": "c1",
        "carrier": "UPS",
        "service_class": "UPS_GROUND",
        "origin_zip": "10001",
        "dest_zip": "94105",
        "weight_oz": 16,
        "declared_value_cents": None,
        "label_created_at": at("2026-06-01 00:00:00"),
        "carrier_promised_delivery_at": at("2026-06-08 00:00:00"),
        "voided_at": None,
    }
    row |= changed
    row.setdefault("last_updated_at", row["label_created_at"])
    return row


def event(event_id: str = "e1", label_id: str = "l1", **changed) -> dict:
    row = {
        "event_id": event_id,
        "label_id": label_id,
        "carrier": "UPS",
        "event_code": None,
        "event_type": "DELIVERED",
        "event_at": "2026-06-06T10:30:00Z",
        "event_received_at": at("2026-06-06 10:31:00"),
        "location_zip": "94105",
        "raw_payload": None,
    }
    return row | changed


@pytest.fixture(scope="session")
def labels_of(spark):
    return lambda *rows: spark.createDataFrame(
        [tuple(r[n] for n in RAW_LABELS.names) for r in rows], RAW_LABELS
    )


@pytest.fixture(scope="session")
def events_of(spark):
    return lambda *rows: spark.createDataFrame(
        [tuple(r[n] for n in RAW_EVENTS.names) for r in rows], RAW_EVENTS
    )


def as_dicts(df, *columns) -> list[dict]:
    return [r.asDict() for r in df.select(*columns).collect()]


def same_rows(left, right) -> bool:
    from waybill.operators.quality import parity

    return parity(left, right).isEmpty()
