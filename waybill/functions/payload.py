"""Carrier payloads: JSON text of varying shape."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BAD = "_corrupt"


def parse_payload(df: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """Add `payload` and `is_unparsable_payload`; text that is no JSON gives nulls and the flag."""
    tolerant = T.StructType([*schema.fields, T.StructField(_BAD, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    read = df.withColumn("__read", F.from_json(column, tolerant, options))
    fields = [F.col("__read")[f.name].alias(f.name) for f in schema]
    return read.withColumns(
        {
            "payload": F.struct(*fields),
            "is_unparsable_payload": F.col("__read")[_BAD].isNotNull(),
        }
    ).drop("__read")
