"""Session settings the operators rely on."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings that decide results; leave sizing to the cluster.

    A time string that reaches the parser without a zone is read in the session zone, so the
    zone is part of the semantics. Adaptive execution is what splits skewed joins and sizes
    shuffles to the data. A skewed join is split even if the next aggregate on its key then needs a shuffle of its own.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark


@contextmanager
def freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of each query as it ends, instead of when the driver next collects garbage.

    For jobs that store what several steps read and never run a query twice.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def local_session(cores: int | str = 8, app: str = "waybill", **extra: str) -> SparkSession:
    """A local session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="waybill-")


def shared_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only where there is no cluster."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder()
