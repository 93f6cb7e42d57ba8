import pytest
from pyspark.sql import functions as F

from waybill.functions.timestamps import abbr_to_offset, repair_times

HALF_PAST_TEN = "2026-06-06 10:30:00"

# raw text, UTC result, malformed
GOLDEN = [
    ("2026-06-06T05:30:00-05:00", HALF_PAST_TEN, False),
    ("2026-06-06T12:00:00+01:30", HALF_PAST_TEN, False),
    ("2026-06-06T10:30:00Z", HALF_PAST_TEN, False),
    ("2026-06-06T10:30:00", HALF_PAST_TEN, False),
    ("2026-06-06T05:30:00 EST", HALF_PAST_TEN, False),
    ("2026-06-06T06:30:00 EDT", HALF_PAST_TEN, False),
    ("2026-06-06T04:30:00 CST", HALF_PAST_TEN, False),
    ("2026-06-06T05:30:00 CDT", HALF_PAST_TEN, False),
    ("2026-06-06T03:30:00 MST", HALF_PAST_TEN, False),
    ("2026-06-06T04:30:00 MDT", HALF_PAST_TEN, False),
    ("2026-06-06T02:30:00 PST", HALF_PAST_TEN, False),
    ("2026-06-06T03:30:00 PDT", HALF_PAST_TEN, False),
    ("2026-06-06T10:30:00 AKST", HALF_PAST_TEN, False),
    ("20260606T103000", HALF_PAST_TEN, True),
    ("2026/06/06T10:30:00", HALF_PAST_TEN, True),
    ("2026-06-06", "2026-06-06 00:00:00", True),
    ("2026/06/06", None, True),
    ("2026/06/06T10:30:00Z", None, True),
    ("2026-06-06T10:30:00.123", "2026-06-06 10:30:00.123", False),
    ("2026-06-06T25:30:00Z", None, True),
    ("2026-06-06T10:30:00 EASTERN", None, True),
    ("garbage", None, True),
    ("", None, True),
    (None, None, True),
]


@pytest.fixture(scope="module")
def repaired(spark):
    df = spark.createDataFrame([(t,) for t, *_ in GOLDEN], "event_at string")
    shown = repair_times(df).withColumn("text", F.col("parsed_at").cast("string"))
    return {r.event_at: r for r in shown.collect()}


@pytest.mark.parametrize("raw, utc, malformed", GOLDEN)
def test_golden(repaired, raw, utc, malformed):
    assert repaired[raw].text == utc
    assert repaired[raw].is_malformed_timestamp is malformed


def test_normalized_text(repaired):
    assert repaired["2026-06-06T05:30:00 EST"].normalized_iso == "2026-06-06T05:30:00-05:00"
    assert repaired["20260606T103000"].normalized_iso == "2026-06-06T10:30:00Z"
    assert repaired["2026/06/06"].normalized_iso == "2026-06-06Z"
    assert repaired["2026-06-06"].normalized_iso == "2026-06-06T00:00:00Z"
    assert repaired["garbage"].normalized_iso == "garbage"
    assert repaired["2026-06-06T10:30:00Z"].shape == "offset"
    assert repaired[None].shape == "other"


def test_unknown_zone_is_utc(spark):
    df = spark.createDataFrame([("PST",), ("HST",), (None,)], "z string")
    rows = {r.z: r.o for r in df.select("z", abbr_to_offset(F.col("z")).alias("o")).collect()}
    assert rows == {"PST": "-08:00", "HST": "Z", None: "Z"}


def test_fallback_keeps_the_flag(spark):
    df = spark.createDataFrame(
        [("garbage", "2026-06-07 00:00:00"), ("2026-06-06T10:30:00Z", "2026-06-07 00:00:00")],
        "event_at string, received string",
    ).withColumn("received", F.col("received").cast("timestamp"))
    rows = repair_times(df, fallback="received").select(
        F.col("parsed_at").cast("string").alias("t"), "is_malformed_timestamp"
    )
    assert sorted(map(tuple, rows.collect())) == [
        ("2026-06-06 10:30:00", False),
        ("2026-06-07 00:00:00", True),
    ]


def test_round_trip_of_local_times(spark):
    """Local time plus abbreviation leads back to the instant, for every hour of a day."""
    names = ["EST", "EDT", "CST", "CDT", "MST", "MDT", "PST", "PDT"]
    offsets = list(zip(names, [-5, -4, -6, -5, -7, -6, -8, -7]))
    zones = spark.createDataFrame(offsets, "zone string, hours int")
    hour = F.make_dt_interval(hours=F.col("id").cast("int"))
    times = spark.range(24).select(
        (F.lit("2026-03-08 00:00:00").cast("timestamp") + hour).alias("utc")
    )
    local = F.date_format(
        F.col("utc") + F.make_dt_interval(hours=F.col("hours")), "yyyy-MM-dd'T'HH:mm:ss"
    )
    df = times.join(zones, F.col("hours") < 24).withColumn(
        "event_at", F.concat(local, F.lit(" "), "zone")
    )
    checked = repair_times(df)
    assert checked.count() == 24 * 8
    assert checked.where(~F.col("parsed_at").eqNullSafe(F.col("utc"))).isEmpty()
