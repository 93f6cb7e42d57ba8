"""Table contracts and the fixed vocabularies of the parcel data."""

from __future__ import annotations

from pyspark.sql import types as T

_STR, _INT, _TS, _BOOL = T.StringType(), T.IntegerType(), T.TimestampType(), T.BooleanType()


def _required(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind, False)


def _optional(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind, True)


# Columns, types and required columns of the raw tables.
RAW_LABELS = T.StructType(
    [
        _required("label_id", _STR),
        _required("customer_id", _STR),
        _required("carrier", _STR),
        _required("service_class", _STR),
        _required("origin_zip", _STR),
        _required("dest_zip", _STR),
        _required("weight_oz", _INT),
        _optional("declared_value_cents", _INT),
        _required("label_created_at", _TS),
        _required("carrier_promised_delivery_at", _TS),
        _optional("voided_at", _TS),
        _required("last_updated_at", _TS),
    ]
)

# event_at stays a string: raw carrier time is kept as sent and repaired later.
RAW_EVENTS = T.StructType(
    [
        _required("event_id", _STR),
        _required("label_id", _STR),
        _required("carrier", _STR),
        _optional("event_code", _STR),
        _optional("event_type", _STR),
        _required("event_at", _STR),
        _required("event_received_at", _TS),
        _optional("location_zip", _STR),
        _optional("raw_payload", _STR),
    ]
)

LABEL_FLAGS = [
    "can_be_weight_fraud",
    "can_be_void_fraud",
    "can_be_insurance_anomaly",
    "can_be_missing_zip",
]

SILVER_LABELS = RAW_LABELS.names + LABEL_FLAGS + ["inserted_at"]

SILVER_EVENTS = [
    "event_id",
    "label_id",
    "carrier",
    "event_code",
    "event_type",
    "event_name",
    "event_at",
    "event_received_at",
    "location_zip",
    "raw_payload",
    "is_malformed_timestamp",
    "is_missing_event_type",
    "inserted_at",
    "is_event_on_voided_label",
]

DELIVERY_PERFORMANCE = [
    "label_id",
    "customer_id",
    "carrier",
    "service_class",
    "origin_zip",
    "dest_zip",
    "label_created_at",
    "carrier_promised_delivery_at",
    "actual_delivery_at",
    "is_delivered",
    "is_delivered_on_time",
    "inserted_at",
]

# ---- Fixed values: must equal the published data contract ----------------------

CARRIERS = ["USPS", "UPS", "FEDEX", "DHL_ECOM"]

STAGES = ["picked_up", "in_transit", "out_for_delivery", "delivered"]

UNKNOWN_STAGE = "unknown"

STAGE_CODES = {
    "picked_up": ["0300", "PICKUP", "PU"],
    "in_transit": ["0301", "IN_TRANSIT", "IT"],
    "out_for_delivery": ["0310", "OUT_FOR_DELIVERY", "OFD"],
    "delivered": ["0320", "DELIVERED", "DL"],
}

ZONE_OFFSETS = {
    "EST": "-05:00",
    "EDT": "-04:00",
    "CST": "-06:00",
    "CDT": "-05:00",
    "MST": "-07:00",
    "MDT": "-06:00",
    "PST": "-08:00",
    "PDT": "-07:00",
}

SLA_DAYS = {
    "USPS_PRIORITY": 3,
    "USPS_STANDARD": 5,
    "UPS_2ND_DAY": 2,
    "UPS_GROUND": 7,
    "FEDEX_2_DAY": 2,
    "FEDEX_NORMAL": 7,
    "DHL_ECOM_EXPRESS": 3,
    "DHL_ECOM_FLEX": 5,
}

CARRIER_MIX = {"USPS": 0.50, "UPS": 0.30, "FEDEX": 0.15, "DHL_ECOM": 0.05}

SUSPICIOUS_WEIGHT_OZ = (1000, 1120)
WEIGHT_RANGE_OZ = (1, 1120)

# ---- End of fixed values ---------------------------------------------------------
