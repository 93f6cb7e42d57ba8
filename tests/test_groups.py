"""Sliced groups give the same rows as the plain window, and large ones are spread."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import at, label, same_rows
from waybill.operators import groups, latest, profile, silver
from waybill.operators.groups import _sliced, with_neighbour, with_ranks

START = dt.datetime(2026, 1, 1, tzinfo=dt.timezone.utc)


@pytest.fixture(scope="module")
def scans(spark):
    """A third of all rows under one key, another part without a key, times that repeat."""
    rng = random.Random(7)
    rows = []
    for i in range(900):
        key = "hot" if i % 3 == 0 else (None if i % 10 == 1 else f"k{rng.randrange(200)}")
        time = None if i % 29 == 0 else START + dt.timedelta(minutes=rng.randrange(5000))
        rows.append((key, time, i, rng.choice(["a", "b", None])))
    return spark.createDataFrame(rows, "k string, t timestamp, n int, v string").repartition(6)


SLICES = [1, 3, 40]


@pytest.fixture
def slices(spark):
    """Set the number of slices."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield lambda n: spark.conf.set(key, n)
    spark.conf.set(key, before)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("n", SLICES)
def test_ranks(scans, slices, n):
    slices(n)
    plain = Window.partitionBy("k").orderBy("t", "n")
    wanted = scans.withColumn("r", F.row_number().over(plain).cast("bigint"))
    found = with_ranks(scans, ["k"], {"r": ["t", "n"]})
    assert found.columns == wanted.columns
    assert same_rows(wanted, found)


@pytest.mark.parametrize("large", [0, 200])
def test_only_large_keys_are_sliced_to_be_ranked(scans, slices, monkeypatch, large):
    slices(5)
    monkeypatch.setattr(groups, "LARGE", large)
    sizes, sliced = [], groups._sliced

    def counted(df, *more):
        sizes.append(df.count())
        return sliced(df, *more)

    monkeypatch.setattr(groups, "_sliced", counted)
    orders = {"r": ["t", "n"], "s": ["n", "t"]}
    wanted = scans
    for name, order in orders.items():
        rank = F.row_number().over(Window.partitionBy("k").orderBy(*order))
        wanted = wanted.withColumn(name, rank.cast("bigint"))
    found = with_ranks(scans, ["k"], orders)
    assert found.dtypes == wanted.dtypes
    assert same_rows(wanted, found)
    assert sizes == [300 if large else 900] * 2


def test_ranks_without_rows(scans):
    found = with_ranks(scans.where("n < 0"), ["k"], {"r": ["t", "n"]})
    assert found.columns == [*scans.columns, "r"] and found.isEmpty()


@pytest.mark.parametrize("which", ["prev", "next"])
@pytest.mark.parametrize("n", SLICES)
def test_neighbours(scans, which, slices, n):
    slices(n)
    plain = Window.partitionBy("k").orderBy("t", "n")
    step = F.lag if which == "prev" else F.lead
    near = step(F.struct("t", "v")).over(plain)
    wanted = scans.withColumn("s", near).select(
        *scans.columns,
        F.col("s.t").alias(f"{which}_t"),
        F.col("s.v").alias(f"{which}_v"),
        F.col("s").isNotNull().alias(f"has_{which}"),
    )
    found = with_neighbour(scans, ["k"], ["t", "n"], ["t", "v"], which)
    assert same_rows(wanted, found)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_windows_run_per_key_and_slice(scans):
    plan = plan_of(with_ranks(scans, ["k"], {"r": ["t", "n"]}))
    assert "hashpartitioning(__key" in plan and "__slice" in plan


def test_a_key_with_half_of_the_rows_is_split(spark, slices):
    """Slices follow the whole order, so that even rows of the same time are spread."""
    slices(8)
    rows = spark.range(8000).select(
        F.when(F.col("id") < 4000, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.lit(START).alias("t"),
        F.col("id").alias("n"),
    )
    sliced = _sliced(rows, ["k"], ["t", "n"], None)
    hot = sliced.where("k = 'hot'").groupBy("__slice").count().collect()
    assert len(hot) >= 4 and max(r["count"] for r in hot) < 1500
    ranked = with_ranks(rows, ["k"], {"r": ["t", "n"]}).where("k = 'hot'")
    assert ranked.where("r <> n + 1").isEmpty() and ranked.count() == 4000


@pytest.fixture(scope="module")
def change_log(labels_of):
    rng = random.Random(3)
    rows = []
    for i in range(300):
        name = "hot" if i % 3 == 0 else f"l{rng.randrange(40)}"
        moved = START + dt.timedelta(minutes=rng.randrange(2000))
        rows.append(
            label(
                name,
                weight_oz=i,
                carrier=rng.choice(["UPS", "USPS"]),
                voided_at=rng.choice([None, at("2026-06-02 00:00:00")]),
                last_updated_at=moved,
            )
        )
        if i % 7 == 0:
            rows.append(rows[-1] | {"customer_id": "c2"})
    return labels_of(*rows)


@pytest.mark.parametrize("n", SLICES)
def test_history_is_the_same_in_any_number_of_slices(change_log, slices, n):
    one = latest.scd2(change_log, ["label_id"], "last_updated_at")
    changes = profile.change_history(change_log)
    slices(n)
    assert same_rows(one, latest.scd2(change_log, ["label_id"], "last_updated_at"))
    assert same_rows(changes, profile.change_history(change_log))


def test_copies_of_an_image_are_counted(change_log):
    doubled = change_log.union(change_log)
    once, twice = profile.change_history(change_log), profile.change_history(doubled)
    assert same_rows(once.withColumn("copies", F.col("copies") * 2), twice)


def test_intervals_meet_and_end_open(change_log):
    versions = latest.scd2(change_log, ["label_id"], "last_updated_at")
    by_label: dict[str, list] = {}
    for r in versions.collect():
        by_label.setdefault(r.label_id, []).append((r.valid_from, r.valid_to, r.is_current))
    for spans in by_label.values():
        spans.sort()
        assert [s[1] for s in spans[:-1]] == [s[0] for s in spans[1:]]
        assert spans[-1][1] is None
        assert [s[2] for s in spans] == [False] * (len(spans) - 1) + [True]
    current = versions.where("is_current").select(*change_log.columns)
    assert same_rows(current, silver.current_labels(change_log))
