"""Time the pipeline and the reports on its tables; print one JSON line.

BENCH_SF_DIR is the data folder, BENCH_CPUS the number of local cores. The raw tables are derived
from the folder and landed, Silver and Gold are built from them as published tables, and the
reports, profiles and checks run on those, as they do in use; their figure is the median of three runs.
"""

from __future__ import annotations

import json
import os
import re
import time
from statistics import median

from pyspark.sql import DataFrame

from waybill.operators import gold, latest, profile, quality, silver
from waybill.plans.queries import Layers
from waybill.plans.refresh import apply_batch, full_refresh, throwaway
from waybill.sources.tables import land_all
from waybill.session import local_session


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    source = Layers(spark, folder)
    seconds: dict[str, float] = {}

    def timed(name: str, work, runs: int = 1) -> None:
        """Seconds of the work, the median where it can be run again."""
        took = []
        for _ in range(runs):
            start = time.perf_counter()
            result = work()
            if isinstance(result, DataFrame):
                result.write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - start)
        seconds[name] = round(median(took), 3)

    source.raw_events.write.format("noop").mode("overwrite").save()  # warm-up
    with throwaway(spark) as models:
        timed("land", lambda: land_all(source.raw_labels, source.raw_events, models.names) and None)
        timed("full_refresh", lambda: full_refresh(models) and None)

        raw_labels = spark.read.table(models.names.raw_labels)
        raw_events = spark.read.table(models.names.raw_events)
        labels, events, mart = models.silver_labels, models.silver_events, models.gold
        queries = {
            "silver_labels": lambda: silver.silver_labels(raw_labels),
            "silver_events": lambda: silver.silver_events(raw_events, labels),
            "delivery_performance": lambda: gold.delivery_performance(labels, events),
            "on_time_by_carrier": lambda: gold.on_time_by(mart, ["carrier"]),
            "on_time_rollup": lambda: gold.on_time_rollup(mart, ["carrier", "service_class"]),
            "delivery_details": lambda: gold.delivery_details(labels, events),
            "delay_analysis": lambda: gold.delay_analysis(mart),
            "delay_clusters": lambda: gold.delay_clusters(mart),
            "data_freshness": lambda: gold.data_freshness(labels, events),
            "dq_gate": lambda: quality.dq_gate(labels, events, mart),
            "model_tests": lambda: quality.model_tests(labels, events, mart),
            "dq_profile": lambda: profile.dq_profile(raw_labels, raw_events, labels, events),
            "out_of_order": lambda: profile.out_of_order(events),
            "arrival_latency": lambda: profile.arrival_latency(events),
            "sequence_completeness": lambda: profile.sequence_completeness(labels, events),
            "void_profile": lambda: profile.void_profile(labels, events),
            "change_history": lambda: profile.change_history(raw_labels),
            "scd2": lambda: latest.scd2(raw_labels, ["label_id"], "last_updated_at"),
            "dedup_logical": lambda: latest.dedup_logical(events),
        }
        for name, build in queries.items():
            timed(name, build, runs=3)
        # A batch of scans that are stored already: every key is looked up and rewritten.
        batch = raw_events.where("event_received_at >= '2001-01-01'")
        timed("apply_batch", lambda: apply_batch(models, event_rows=batch) and None)

    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "pipeline_and_reports_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else folder,
            }
        )
    )


if __name__ == "__main__":
    main()
