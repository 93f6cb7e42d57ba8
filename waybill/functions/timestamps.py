"""Repair of raw carrier times.

Carriers send times as text in several shapes. The text is first sorted into a *shape* (one
cheap classification, computed once per row), then rewritten by shape to ISO-8601 with an
explicit offset, then parsed once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.schemas import ZONE_OFFSETS

# The recognised shapes, in order of precedence. A text gets the first that fits.
SHAPES = {
    "zone_name": r" [A-Z]{2,4}$",
    "offset": r"T[0-9]{2}:[0-9]{2}:[0-9]{2}([+-][0-9]{2}:[0-9]{2}|Z)$",
    "compact": r"^[0-9]{8}T[0-9]{6}$",
    "slashed": r"^[0-9]{4}/[0-9]{2}/[0-9]{2}",
    "date_only": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "no_zone": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}$",
}

# Shapes that only arise from corruption: repaired, but flagged.
CORRUPT_SHAPES = ["compact", "slashed", "date_only"]


def time_shape(raw: Column) -> Column:
    """Name of the shape of a raw time text; 'other' for anything else, including null."""
    chain = F
    for name, pattern in SHAPES.items():
        chain = chain.when(raw.rlike(pattern), name)
    return chain.otherwise("other")


def zone_name(raw: Column) -> Column:
    """The trailing zone abbreviation, '' if there is none."""
    return F.ltrim(F.regexp_extract(raw, SHAPES["zone_name"], 0))


def abbr_to_offset(abbr: Column) -> Column:
    """Numeric offset of a US zone abbreviation; an unknown one counts as UTC.

    A lookup in a constant map: the abbreviation is extracted once, not once per zone.
    """
    offsets = F.create_map(*[F.lit(v) for pair in ZONE_OFFSETS.items() for v in pair])
    return F.coalesce(F.try_element_at(offsets, abbr), F.lit("Z"))


def _from_zone_name(raw: Column) -> Column:
    return F.concat(F.regexp_replace(raw, SHAPES["zone_name"], ""), abbr_to_offset(zone_name(raw)))


def _from_compact(raw: Column) -> Column:
    return F.regexp_replace(
        raw,
        "^(....)(..)(..)T(..)(..)(..)",
        "$1-$2-$3T$4:$5:$6Z",
    )


def normalize_event_at(raw: Column, shape: Column | None = None) -> Column:
    """Rewrite a raw time text to ISO-8601 with an explicit offset, by its shape."""
    shape = time_shape(raw) if shape is None else shape
    return (
        F.when(shape == "zone_name", _from_zone_name(raw))
        .when(shape == "compact", _from_compact(raw))
        .when(shape == "slashed", F.concat(F.translate(raw, "/", "-"), F.lit("Z")))
        .when(shape == "date_only", F.concat(raw, F.lit("T00:00:00Z")))
        .when(shape == "no_zone", F.concat(raw, F.lit("Z")))
        .otherwise(raw)
    )


def parse_event_at(normalized: Column, fallback: Column | None = None) -> Column:
    """The instant, null if the text is no time; optionally another time in that case."""
    parsed = F.try_to_timestamp(normalized)
    return parsed if fallback is None else F.coalesce(parsed, fallback)


def flag_malformed(shape: Column, parsed: Column) -> Column:
    return shape.isin(CORRUPT_SHAPES) | parsed.isNull()


def repair_times(df: DataFrame, raw: str = "event_at", fallback: str | None = None) -> DataFrame:
    """Add `shape`, `normalized_iso`, `parsed_at` and `is_malformed_timestamp` for a raw column.

    Each step sits in its own projection, so that a row is classified once and parsed once.
    """
    source = F.col(raw)
    shaped = df.withColumn("shape", time_shape(source))
    rewritten = shaped.withColumn("normalized_iso", normalize_event_at(source, F.col("shape")))
    parsed = rewritten.withColumn("parsed_at", parse_event_at(F.col("normalized_iso")))
    flagged = parsed.withColumn(
        "is_malformed_timestamp", flag_malformed(F.col("shape"), F.col("parsed_at"))
    )
    if fallback is None:
        return flagged
    return flagged.withColumn("parsed_at", F.coalesce("parsed_at", fallback))
