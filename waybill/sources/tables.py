"""Landing raw data and publishing tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.operators.quality import land_contract
from waybill.schemas import RAW_EVENTS, RAW_LABELS
from waybill.session import configure
from waybill.sources.scratch import CODEC

SAVE_MODES = ("overwrite", "append", "ignore")


@dataclass(frozen=True)
class Names:
    """Where the tables live: layer -> schema, with absolute names.

    `prefix` goes before each layer's schema, `catalog` before that, where there is one.
    """

    catalog: str | None = None
    prefix: str = ""

    def schema(self, layer: str) -> str:
        parts = [self.catalog, f"{self.prefix}{layer}"]
        return ".".join(p for p in parts if p)

    def table(self, layer: str, name: str) -> str:
        return f"{self.schema(layer)}.{name}"

    @property
    def raw_labels(self) -> str:
        return self.table("raw", "labels")

    @property
    def raw_events(self) -> str:
        return self.table("raw", "tracking_events")

    @property
    def silver_labels(self) -> str:
        return self.table("silver", "labels")

    @property
    def silver_events(self) -> str:
        return self.table("silver", "tracking_events")

    @property
    def late_events(self) -> str:
        return self.table("silver", "tracking_events_late")

    @property
    def due(self) -> str:
        """Labels whose mart row has yet to be written."""
        return self.table("silver", "labels_due")

    @property
    def orphaned_events(self) -> str:
        return self.table("silver", "tracking_events_orphaned")

    @property
    def gold(self) -> str:
        return self.table("gold", "delivery_performance")

    @property
    def delivery_partials(self) -> str:
        return self.table("gold", "delivery_partials")

    @property
    def scan_partials(self) -> str:
        return self.table("gold", "scan_partials")

    @property
    def periods_due(self) -> str:
        """Periods of the layers whose partial aggregates have yet to be written."""
        return self.table("gold", "periods_due")

    @property
    def delay_analysis(self) -> str:
        return self.table("gold", "delay_analysis")

    @property
    def data_freshness(self) -> str:
        return self.table("gold", "data_freshness")


def ensure_schema(spark: SparkSession, schema: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}{where}")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of the contract, in its order and types."""
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def with_ingestion(df: DataFrame, batch_id: str) -> DataFrame:
    return df.withColumns(
        {
            "_ingestion_timestamp": F.current_timestamp(),
            "_ingestion_batch_id": F.lit(batch_id),
        }
    )


def has_batch_ids(df: DataFrame) -> bool:
    return "_ingestion_batch_id" in df.columns


def _writer(df: DataFrame, provider: str) -> DataFrameWriter:
    """Later inserts use the codec that a table was created with."""
    writer = df.write.format(provider)
    return writer.option("compression", CODEC) if provider == "parquet" else writer


def land(
    df: DataFrame,
    table: str,
    schema: T.StructType,
    mode: str = "overwrite",
    batch_id: str | None = None,
    provider: str = "parquet",
) -> int:
    """Write rows under a fixed schema; the row count comes out of the same job.

    Refuses an empty input before it touches the target. With a batch id, rows carry it and the
    time of landing.
    """
    if mode not in SAVE_MODES:
        raise ValueError(f"mode must be one of {', '.join(SAVE_MODES)}")
    spark = configure(df.sparkSession)
    fixed = conform(df, schema)
    if fixed.isEmpty():
        raise ValueError(f"no rows to land in {table}")
    if batch_id is not None:
        fixed = with_ingestion(fixed, batch_id)
    if mode == "ignore" and spark.catalog.tableExists(table):
        return 0
    counted = Observation()
    rows = fixed.observe(counted, F.count(F.lit(1)).alias("rows"))
    _writer(rows, provider).mode(mode).saveAsTable(table)
    return counted.get["rows"]


def land_all(
    labels: DataFrame, events: DataFrame, names: Names, mode: str = "overwrite", **options
) -> dict:
    spark = labels.sparkSession
    ensure_schema(spark, names.schema("raw"))
    return {
        "labels_count": land(labels, names.raw_labels, RAW_LABELS, mode, **options),
        "events_count": land(events, names.raw_events, RAW_EVENTS, mode, **options),
        "labels_table": names.raw_labels,
        "events_table": names.raw_events,
    }


def validate_landed(spark: SparkSession, names: Names) -> dict:
    """Contract of both raw tables after the write: rows present, required columns filled.

    One aggregate per table.
    """
    result: dict = {}
    contracts = {
        "labels": (names.raw_labels, RAW_LABELS),
        "events": (names.raw_events, RAW_EVENTS),
    }
    for name, (table, schema) in contracts.items():
        if not spark.catalog.tableExists(table):
            result |= {f"{name}_valid": False, f"{name}_count": 0}
            continue
        columns = land_contract(spark.read.table(table), schema)
        verdict = columns.agg(F.bool_and("passed").alias("ok"), F.max("rows").alias("rows")).first()
        result |= {f"{name}_valid": verdict.ok, f"{name}_count": verdict.rows}
    result["all_valid"] = result["labels_valid"] and result["events_valid"]
    return result


def land_and_report(labels: DataFrame, events: DataFrame, names: Names, **options) -> dict:
    """Land and validate both tables. Failures are reported, not raised."""
    try:
        counts = land_all(labels, events, names, **options)
        valid = validate_landed(labels.sparkSession, names)["all_valid"]
    except Exception as problem:
        return {"status": "error", "message": str(problem), "error_type": type(problem).__name__}
    return {
        "status": "success" if valid else "success_with_warnings",
        **counts,
        "message": f"landed {counts['labels_count']} label rows, {counts['events_count']} events",
    }


def materialize(
    df: DataFrame,
    table: str,
    partition_by: Sequence[str] = (),
    provider: str = "parquet",
    gather: bool = True,
) -> DataFrame:
    """Full refresh of a model: replace the table, return it as read back.

    Without `gather` each task writes a file to every partition it has rows of.
    """
    spark = df.sparkSession
    ensure_schema(spark, table.rpartition(".")[0])
    if partition_by and gather:
        # One writer per partition value, except that adaptive execution splits large ones.
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    _writer(df, provider).mode("overwrite").partitionBy(*partition_by).saveAsTable(table)
    return spark.read.table(table)


def preview(df: DataFrame, rows: int = 10, order: Sequence[str] = ()) -> DataFrame:
    """A few rows: the first under a stated order, or any."""
    return (df.orderBy(*order) if order else df).limit(rows)
