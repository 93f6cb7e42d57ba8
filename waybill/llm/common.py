"""Row keys, size-checked broadcasts and Arrow helpers shared by the operators."""

from __future__ import annotations

import atexit
import os
from collections.abc import Iterable
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.sources.scratch import Scratch

#: A table is broadcast only if it was counted and has no more rows; every use has at most 64 bytes a row.
BROADCAST_ROWS = 500_000

#: Bytes of a batch that goes to a Python worker; Spark's own bound is 64 MB, held twice by each task.
BATCH_BYTES = 8 << 20

#: What a Python worker frees goes back to the system: up to four idle workers of earlier steps stay on an executor.
WORKER_MEMORY = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_TRIM_THRESHOLD_": str(1 << 20)}

#: Runs of these are one separator; words are what lies between.
WHITESPACE = r"[\x20\x09-\x0D]+"


def session_space(spark: SparkSession) -> Scratch:
    """Intermediate results of a lazy result, in the shared folder until the program ends."""
    importable(spark)
    space = Scratch(spark)

    def drop() -> None:
        if spark.sparkContext._jsc is not None:
            space.drop()

    atexit.register(drop)
    return space


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it; bound their batches and what they hold.

    That serves a driver and executors with the same files; elsewhere install the package on the
    executors or pass it with --py-files.
    """
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    for name, value in WORKER_MEMORY.items():
        spark.sparkContext.environment.setdefault(name, value)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def fresh(taken: Iterable[str], name: str) -> str:
    """A column name that none of the taken ones equals, in whatever case."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name += "_"
    return name


def keyed(docs: DataFrame, id_col: str, space: Scratch) -> tuple[DataFrame, str]:
    """The rows with a column that tells any two of them apart, and that column's name.

    Where ids are unique and not null the id itself serves, and nothing is written. Otherwise the
    rows are written once with a number of their own: a number made on the fly would change when
    a lost task runs again.
    """
    name = fresh(docs.columns, "row_key")
    ids = docs.groupBy(F.col(f"`{id_col}`").alias("id")).agg(F.count("*").alias("n"))
    if ids.where("n > 1 or id is null").isEmpty():
        return docs.withColumn(name, F.col(f"`{id_col}`")), name
    return space.write(docs.withColumn(name, F.monotonically_increasing_id()), "keyed"), name


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marked for broadcast if a count shows it to be small, else as it is. For stored tables."""
    return F.broadcast(df) if df.count() <= rows else df


def without(docs: DataFrame, key: str, dropped: DataFrame) -> DataFrame:
    """The rows whose key is not in the stored one-column table of dropped keys."""
    gone = small(dropped.toDF(key))
    return docs.join(gone, key, "left_anti")


def plus(df: DataFrame, **more: str) -> T.StructType:
    """The schema of the rows with more columns, whose types are given in SQL."""
    added = T.StructType.fromDDL(", ".join(f"`{n}` {kind}" for n, kind in more.items()))
    return T.StructType([*df.schema.fields, *added.fields])


def text_of(text_col: str) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))


def ordered(id_col: Column, row: Column) -> Column:
    """What the smallest id is the minimum of: nulls last, ties by the row's key."""
    return F.struct(id_col.isNull().alias("none"), id_col.alias("id"), row.alias("row"))


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of an Arrow string or binary column without nulls."""
    wide = isinstance(column, (pa.LargeStringArray, pa.LargeBinaryArray))
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    return offsets, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def blocks(text: str, size: int = 1 << 20) -> Iterable[str]:
    """Pieces of about that many characters that each start with a space after a non-space.

    No word and no pre-token crosses such a place. A text without one comes whole.
    """
    start = 0
    while len(text) - start > size:
        at = start + size
        while True:
            at = text.find(" ", at)
            if at < 0 or not text[at - 1].isspace():
                break
            at += 1
        if at < 0:
            break
        yield text[start:at]
        start = at
    yield text[start:]
