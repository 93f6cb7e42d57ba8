"""Parcel tables derived from order and line-item tables.

A fixed integer recipe (see FIXTURES.md) that turns each order into a label with a change log and
each line item into a carrier scan, with every defect the pipeline handles. It runs on Spark as
projections plus one join, so it grows with its inputs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.schemas import RAW_EVENTS, RAW_LABELS


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _digit(key: Column, unit: int) -> Column:
    """One decimal-like digit of the order key: (key div unit) mod 10."""
    return F.floor(key / unit).cast("bigint") % 10


def _padded(value: Column, width: int) -> Column:
    return F.lpad(value.cast("string"), width, "0")


def _hours(n: Column) -> Column:
    return F.make_dt_interval(hours=n.cast("int"))


def _days(n: Column) -> Column:
    return F.make_dt_interval(days=n.cast("int"))


def _orders(orders: DataFrame) -> DataFrame:
    """Order key, creation time, carrier and SLA days."""
    key = F.col("o_orderkey")
    share = key % 20
    express = _digit(key, 200) == 0
    carrier = (
        F.when(share < 10, "USPS").when(share < 16, "UPS").when(share < 19, "FEDEX")
    ).otherwise("DHL_ECOM")
    fast, slow = F.when(share.between(10, 18), 2).otherwise(3), F.when(
        share.between(10, 18), 7
    ).otherwise(5)
    return orders.select(
        key.alias("k"),
        F.col("o_custkey").alias("ck"),
        F.col("o_orderdate").cast("timestamp").alias("created"),
        carrier.alias("carrier"),
        express.alias("express"),
        F.when(express, fast).otherwise(slow).alias("sla"),
    )


def raw_labels(orders: DataFrame) -> DataFrame:
    """Change log: one to three full images per label."""
    k, created = F.col("k"), F.col("created")
    classes = {
        "USPS": ("USPS_PRIORITY", "USPS_STANDARD"),
        "UPS": ("UPS_2ND_DAY", "UPS_GROUND"),
        "FEDEX": ("FEDEX_2_DAY", "FEDEX_NORMAL"),
        "DHL_ECOM": ("DHL_ECOM_EXPRESS", "DHL_ECOM_FLEX"),
    }
    service = F
    for carrier, (fast, slow) in classes.items():
        choice = F.when(F.col("express"), fast).otherwise(slow)
        service = service.when(F.col("carrier") == carrier, choice)
    change, fraud = F.col("change"), F.col("fraud")
    base = _orders(orders).withColumns(
        {
            "service": service,
            "change": _digit(k, 20),
            "fraud": _digit(k, 2000),
            "image": F.lit(0),
        }
    )
    images = (
        F.when(change == 2, F.array(F.lit(0), F.lit(1), F.lit(2)))
        .when(change < 2, F.array(F.lit(0), F.lit(1)))
        .otherwise(F.array(F.lit(0)))
    )
    image = F.col("image")
    voided = F.when(fraud == 0, created + _days(F.lit(3))).otherwise(
        created + F.make_dt_interval(mins=(k % 60 + 1).cast("int"))
    )
    weight = k * 37 % 1180 + 1
    return (
        base.withColumn("image", F.explode(images))
        .select(
            F.concat(F.lit("lbl_"), _padded(k, 24)).alias("label_id"),
            F.concat(F.lit("cust_"), _padded(F.col("ck"), 12)).alias("customer_id"),
            "carrier",
            F.when((image == 1) & change.isin(1, 2), F.concat("carrier", F.lit("_EXTRA")))
            .otherwise(F.col("service"))
            .alias("service_class"),
            _padded(F.col("ck") * 61 % 99999 + 1, 5).alias("origin_zip"),
            F.when(k % 211 != 0, _padded(k * 7 % 99999 + 1, 5)).alias("dest_zip"),
            F.when(weight > 1120, 1000 + k % 121).otherwise(weight).alias("weight_oz"),
            F.when(k % 7 == 0, F.when(k % 133 == 0, 0).otherwise(5000 + k * 11 % 45001)).alias(
                "declared_value_cents"
            ),
            created.alias("label_created_at"),
            (created + _days(F.col("sla"))).alias("carrier_promised_delivery_at"),
            F.when((image == 1) & (change == 0), voided).alias("voided_at"),
            F.when(image == 0, created)
            .when(change == 0, voided)
            .otherwise(created + _hours(5 * image + k % 7))
            .alias("last_updated_at"),
        )
        .select(*[F.col(f.name).cast(f.dataType) for f in RAW_LABELS])
    )


def raw_events(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Scans with repeated ids, late arrivals and every time shape."""
    items = lineitem.select(
        F.col("l_orderkey").alias("k"),
        F.col("l_linenumber").alias("ln"),
        F.col("l_partkey").alias("pk"),
        F.col("l_suppkey").alias("sk"),
        F.col("l_quantity").cast("bigint").alias("q"),
    )
    k, pk, q, ln = (F.col(c) for c in ("k", "pk", "q", "ln"))
    carrier, stage, sla = F.col("carrier"), F.col("stage"), F.col("sla")
    percent_of_sla = (
        F.when(stage == 1, 15).when(stage == 2, 40).when(stage == 3, 75).otherwise(95)
    )
    late = (stage == 4) & ((pk + F.col("sk")) % 33 == 0)
    hours = F.when(late, sla * 24 + 6 + q % 43).otherwise(
        F.floor(sla * 24 * percent_of_sla / 100) + q % 5 - 2
    )
    zones = ["EST", "EDT", "CST", "CDT", "MST", "MDT", "PST", "PDT", "AKST"]
    zone_hours = [-5, -4, -6, -5, -7, -6, -8, -7, 0]
    pick = (q % 9).cast("int")
    zone = F.get(F.array(*map(F.lit, zones)), pick)
    offset = (
        F.when(carrier == "USPS", -5)
        .when(carrier == "DHL_ECOM", F.get(F.array(*map(F.lit, zone_hours)), pick))
        .otherwise(0)
    )
    happened = F.col("happened")
    local = F.col("local")
    corrupted = (
        F.when(q % 3 == 0, F.translate(local, "-:", ""))
        .when(q % 3 == 1, F.substring(local, 1, 10))
        .otherwise(F.translate(local, "-", "/"))
    )
    written = (
        F.when(pk % 500 == 13, "not-a-time")
        .when(pk % 100 == 7, corrupted)
        .when(carrier == "USPS", F.concat(local, F.lit("-05:00")))
        .when(carrier == "UPS", F.concat(local, F.lit("Z")))
        .when(carrier == "FEDEX", local)
        .otherwise(F.concat(local, F.lit(" "), zone))
    )

    def by_stage(*names: str | Column) -> Column:
        return F.get(F.array(*[n if isinstance(n, Column) else F.lit(n) for n in names]), stage - 1)

    named = pk % 97 != 0
    code = F.when(carrier == "USPS", by_stage("0300", "0301", "0310", "0320")).when(
        carrier == "DHL_ECOM", by_stage("PU", "IT", "OFD", "DL")
    )
    last = F.when(pk % 89 == 0, "RETURNED").otherwise("DELIVERED")
    kind = F.when(
        carrier.isin("UPS", "FEDEX"), by_stage("PICKUP", "IN_TRANSIT", "OUT_FOR_DELIVERY", last)
    )
    label_key = k + F.when(pk % 499 == 0, 100000000).otherwise(0)
    return (
        items.join(_orders(orders).select("k", "created", "carrier", "sla"), "k")
        .withColumn("stage", F.least(ln, F.lit(4)))
        .withColumn("happened", F.col("created") + _hours(hours))
        .withColumn("local", F.date_format(happened + _hours(offset), "yyyy-MM-dd'T'HH:mm:ss"))
        .select(
            F.concat_ws("_", F.lit("ev"), k, ln).alias("event_id"),
            F.concat(F.lit("lbl_"), _padded(label_key, 24)).alias("label_id"),
            "carrier",
            F.when(named, code).alias("event_code"),
            F.when(named, kind).alias("event_type"),
            written.alias("event_at"),
            F.when(pk % 13 == 0, happened + _days(2 + q % 7))
            .otherwise(happened)
            .alias("event_received_at"),
            F.when(F.col("sk") % 5 != 0, _padded(pk % 99999 + 1, 5)).alias("location_zip"),
            F.lit(None).alias("raw_payload"),
        )
        .select(*[F.col(f.name).cast(f.dataType) for f in RAW_EVENTS])
    )
