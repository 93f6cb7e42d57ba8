"""Row-level flags and conformance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waybill.schemas import STAGE_CODES, SUSPICIOUS_WEIGHT_OZ, UNKNOWN_STAGE


def _definite(condition: Column) -> Column:
    """A condition as a flag that is never null."""
    return F.coalesce(condition, F.lit(False))


def flag_weight(weight: Column) -> Column:
    low, high = SUSPICIOUS_WEIGHT_OZ
    return _definite(weight.between(low, high))


def flag_void(voided_at: Column, created_at: Column) -> Column:
    """Voided more than one day after creation."""
    return _definite(voided_at > created_at + F.expr("INTERVAL '1' DAY"))


def flag_insurance(declared_value: Column) -> Column:
    """Insured for nothing; no declared value at all means not insured."""
    return _definite(declared_value == 0)


def flag_missing_zip(origin: Column, dest: Column) -> Column:
    return origin.isNull() | dest.isNull()


def flag_missing_type(code: Column, kind: Column) -> Column:
    return code.isNull() & kind.isNull()


def canonical_event_name(code: Column, kind: Column) -> Column:
    """Common stage name of a scan; the code wins over the type, the carrier plays no part."""
    sent = F.coalesce(code, kind)
    chain = F
    for stage, codes in STAGE_CODES.items():
        chain = chain.when(sent.isin(codes), stage)
    return chain.otherwise(UNKNOWN_STAGE)
