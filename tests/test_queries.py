"""Every registered query against its SQL, and the known figures of the derived tables."""

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tests.conftest import DATA
from waybill.operators import gold, latest, silver
from waybill.plans.queries import REGISTRY, Layers

QUERIES, ORACLES = REGISTRY, contract.oracle_sql()


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


TABLES = ["customer", "orders", "lineitem", "events"]
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{DATA}/{name}.parquet')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLES) and len(QUERIES) > 60
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    found = QUERIES[name](spark, DATA)
    plan = plan_of(found)
    for foreign in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert foreign not in plan
    columns = sorted(found.columns)
    wanted = duck.execute(ORACLES[name])
    described = {d[0]: str(d[1]) for d in wanted.description}
    assert sorted(described) == columns
    types = {f.name: f.dataType.simpleString() for f in found.schema}
    if name != "raw_events":
        assert {c: TYPES.get(t, "VARCHAR") for c, t in types.items()} == described
    where = [d[0] for d in wanted.description]
    expected = Counter(tuple(r[where.index(c)] for c in columns) for r in wanted.fetchall())
    assert Counter(tuple(r[c] for c in columns) for r in found.collect()) == expected


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert {r.carrier for r in rows} == {"USPS", "UPS", "FEDEX", "DHL_ECOM"}


def test_known_figures_at_the_next_scale(spark):
    x = Layers(spark, "/root/testdata/sf0.01")
    labels, events, mart = x.stored()
    raw = x.raw_labels.agg(F.count("*"), F.countDistinct("label_id")).first()
    assert tuple(raw) == (21000, 15000)
    flags = labels.agg(
        F.count("voided_at"),
        *[
            F.count_if(c)
            for c in (
                "can_be_weight_fraud",
                "can_be_void_fraud",
                "can_be_insurance_anomaly",
                "can_be_missing_zip",
            )
        ],
    ).first()
    assert tuple(flags) == (1500, 2300, 200, 113, 72)
    assert tuple(events.agg(F.count("*"), F.count("event_at")).first()) == (45832, 45731)
    names = {r.event_name: r["count"] for r in events.groupBy("event_name").count().collect()}
    assert names == {
        "delivered": 25818,
        "in_transit": 6480,
        "out_for_delivery": 6432,
        "picked_up": 6493,
        "unknown": 609,
    }
    shares = {
        r.carrier: (r.labels, r.delivered, r.on_time)
        for r in gold.on_time_by(mart, ["carrier"]).collect()
    }
    assert shares == {
        "DHL_ECOM": (750, 667, 624),
        "FEDEX": (2250, 1998, 1863),
        "UPS": (4500, 4031, 3729),
        "USPS": (7500, 6701, 6219),
    }


# ---- Plans ---------------------------------------------------------------------------------


def test_top_row_per_key_is_limited_before_the_shuffle(spark):
    plan = plan_of(latest.dedup_events(Layers(spark, DATA).raw_events))
    assert "row_number(), 1, Partial" in plan and "row_number(), 1, Final" in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_deliveries_are_a_hash_aggregate_with_a_partial_step(spark):
    _, events, _ = Layers(spark, DATA).stored()
    plan = plan_of(gold.latest_delivery(events))
    assert "partial_max" in plan and "SortAggregate" not in plan
    assert "EqualTo(event_name,delivered)" in plan
    assert "ReadSchema: struct<label_id:string,event_name:string,event_at:timestamp>" in plan


def test_labels_are_never_forced_into_a_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        x = Layers(spark, DATA)
        for df in (x.events, x.gold, silver.drop_orphans(x.events, x.labels)):
            assert "Broadcast" not in plan_of(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
