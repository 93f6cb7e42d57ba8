import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import event, label, same_rows
from waybill.schemas import RAW_EVENTS, RAW_LABELS
from waybill.sources.scratch import scratch, staged
from waybill.sources.tables import (
    Names,
    conform,
    land,
    land_all,
    land_and_report,
    materialize,
    preview,
    validate_landed,
)


@pytest.fixture
def names():
    return Names(prefix=f"t{uuid.uuid4().hex[:8]}_")


def test_contracts():
    assert RAW_LABELS.names == [
        "label_id", "customer_id", "carrier", "service_class", "origin_zip", "dest_zip",
        "weight_oz", "declared_value_cents", "label_created_at", "carrier_promised_delivery_at",
        "voided_at", "last_updated_at",
    ]
    assert RAW_EVENTS.names == [
        "event_id", "label_id", "carrier", "event_code", "event_type", "event_at",
        "event_received_at", "location_zip", "raw_payload",
    ]
    nullable = {f.name for f in [*RAW_LABELS, *RAW_EVENTS] if f.nullable}
    assert nullable == {
        "declared_value_cents", "voided_at", "event_code", "event_type", "location_zip",
        "raw_payload",
    }
    assert RAW_EVENTS["event_at"].dataType == T.StringType()


def test_names():
    assert Names().gold == "gold.delivery_performance"
    assert Names("cat", "dev_").silver_events == "cat.dev_silver.tracking_events"


def test_land_modes(spark, names, labels_of, events_of):
    labels, events = labels_of(label("a"), label("b")), events_of(event())
    counts = land_all(labels, events, names)
    assert counts == {
        "labels_count": 2,
        "events_count": 1,
        "labels_table": names.raw_labels,
        "events_table": names.raw_events,
    }
    assert same_rows(spark.read.table(names.raw_labels), labels)
    assert land(labels, names.raw_labels, RAW_LABELS, "append") == 2
    assert spark.read.table(names.raw_labels).count() == 4
    assert land(labels, names.raw_labels, RAW_LABELS, "ignore") == 0
    assert spark.read.table(names.raw_labels).count() == 4
    assert land(labels, names.raw_labels, RAW_LABELS) == 2
    assert spark.read.table(names.raw_labels).count() == 2
    with pytest.raises(ValueError, match="mode"):
        land(labels, names.raw_labels, RAW_LABELS, "upsert")


def test_empty_input_is_refused_and_leaves_the_table(spark, names, labels_of, events_of):
    labels = labels_of(label())
    land_all(labels, events_of(event()), names)
    with pytest.raises(ValueError, match="no rows"):
        land(labels.limit(0), names.raw_labels, RAW_LABELS)
    assert spark.read.table(names.raw_labels).count() == 1


def test_conform_fixes_types_and_order(spark, labels_of):
    loose = labels_of(label()).select(
        *[F.col(c).cast("string") for c in reversed(RAW_LABELS.names)], F.lit(1).alias("extra")
    )
    assert [(f.name, f.dataType) for f in conform(loose, RAW_LABELS).schema] == [
        (f.name, f.dataType) for f in RAW_LABELS
    ]
    with pytest.raises(ValueError, match="missing columns: carrier"):
        conform(loose.drop("carrier"), RAW_LABELS)


def test_ingestion_columns(spark, names, labels_of, events_of):
    land_all(labels_of(label()), events_of(event()), names, batch_id="b7")
    row = spark.read.table(names.raw_events).first()
    assert row._ingestion_batch_id == "b7" and row._ingestion_timestamp is not None


def test_report(spark, names, labels_of, events_of):
    done = land_and_report(labels_of(label("a"), label("b")), events_of(event()), names)
    assert (done["status"], done["labels_count"], done["events_count"]) == ("success", 2, 1)
    failed = land_and_report(labels_of(label()).limit(0), events_of(event()), names)
    assert (failed["status"], failed["error_type"]) == ("error", "ValueError")
    missing = land_and_report(labels_of(label()).drop("carrier"), events_of(event()), names)
    assert missing["status"] == "error" and "carrier" in missing["message"]


def test_report_warns_of_nulls(spark, names, labels_of, events_of):
    holed = labels_of(label()).withColumn("carrier", F.lit(None).cast("string"))
    assert land_and_report(holed, events_of(event()), names)["status"] == "success_with_warnings"
    found = validate_landed(spark, names)
    assert found == {
        "labels_valid": False,
        "labels_count": 1,
        "events_valid": True,
        "events_count": 1,
        "all_valid": False,
    }


def test_missing_tables_are_invalid(spark, names):
    assert validate_landed(spark, names)["all_valid"] is False


def test_materialize_replaces(spark, names, labels_of):
    table = names.table("gold", "x")
    materialize(labels_of(label("a"), label("b")), table)
    again = materialize(labels_of(label("c")), table, ["carrier"])
    assert [r.label_id for r in again.collect()] == ["c"]


def test_staged_and_preview(spark, labels_of):
    rows = labels_of(label("a"), label("b"))
    back = staged(rows, "x")
    assert same_rows(back, rows) and "FileScan" in back._jdf.queryExecution().toString()
    assert preview(rows, 1).count() == 1


def test_scratch_is_gone_afterwards(spark, labels_of):
    with scratch(spark) as space:
        assert space.write(labels_of(label()), "x").count() == 1
        assert Path(space.path).exists()
    assert not Path(space.path).exists()


def test_filters_and_columns_reach_the_scan(spark, names, labels_of):
    table = materialize(labels_of(label("a"), label("b")), names.table("gold", "y"))
    plan = table.where("carrier = 'UPS'").select("label_id")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(carrier), EqualTo(carrier,UPS)]" in plan
    assert "ReadSchema: struct<label_id:string,carrier:string>" in plan
