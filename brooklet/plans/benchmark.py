"""Benchmarks of the engine itself: the layered pipeline with its queries, and batch against micro-batches."""

from __future__ import annotations

import csv
import json
import statistics
import time
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame

from brooklet.operators.silver import deduplicate, normalize
from brooklet.plans.lakehouse import Lakehouse, build_marts
from brooklet.plans.operations import file_stats, number_slices
from brooklet.plans.reports import REPORTS
from brooklet.schemas import MARTS


def timed(work: Callable[[], Any]) -> tuple[Any, float]:
    began = time.perf_counter()
    return work(), time.perf_counter() - began


def system_benchmark(house: Lakehouse, bronze: DataFrame) -> dict:
    """Seconds to land, to transform and to query, rows a second, and storage by table."""
    _, ingestion = timed(lambda: house.table("bronze_events").append(bronze))
    rows = house.read("bronze_events").count()

    def transform() -> None:
        house.table("silver_events").replace(deduplicate(normalize(house.read("bronze_events"))))
        house.refresh([], "rebuild", fail_on_quality=False)

    _, transformation = timed(transform)
    house.register_views()
    latency = {n.removeprefix("bench_"): timed(house.spark.sql(REPORTS[n]).collect)[1] for n in REPORTS if n.startswith("bench_")}
    storage = {n: file_stats(house.table(n).file_sizes()).first().asDict() for n in house.tables()}
    total = ingestion + transformation + sum(latency.values())
    return {
        "rows": rows, "ingestion_seconds": ingestion, "transformation_seconds": transformation, "query_latency_seconds": latency, "average_query_latency_seconds": statistics.mean(latency.values()),
        "total_runtime_seconds": total, "throughput_rows_per_second": rows / total, "storage": storage, "storage_bytes": sum(s["total_bytes"] for s in storage.values()),
    }


def processing_benchmark(batch_house: Lakehouse, stream_house: Lakehouse, bronze: DataFrame, rows_per_batch: int) -> dict:
    """One pass against slices in order: seconds, and seconds of each slice."""
    _, whole = timed(lambda: batch_house.process(bronze, "batch", "full", fail_on_quality=False))
    sliced = number_slices(bronze, "record_hash", rows_per_batch).persist()
    slices = sorted(r[0] for r in sliced.select("slice").distinct().collect())
    each = [timed(lambda k=k: stream_house.process(sliced.where(f"slice = {k}").drop("slice"), f"slice-{k}", fail_on_quality=False))[1] for k in slices]
    sliced.unpersist()
    return {"batch_seconds": whole, "microbatches": len(each), "streaming_seconds": sum(each), "average_latency_seconds": statistics.mean(each or [0.0]), "max_latency_seconds": max(each, default=0.0)}


def write_result(result: dict, folder: str, name: str) -> tuple[str, str]:
    """A result as JSON and, flattened to one row, as CSV; returns both paths."""
    Path(folder).mkdir(parents=True, exist_ok=True)
    paths = Path(folder) / f"{name}.json", Path(folder) / f"{name}.csv"
    paths[0].write_text(json.dumps(result, indent=2, default=str))
    row = dict(flattened(result))
    with open(paths[1], "w", newline="") as f:
        w = csv.DictWriter(f, list(row))
        w.writeheader()
        w.writerow(row)
    return str(paths[0]), str(paths[1])


def flattened(value: Any, name: str = "") -> Iterator[tuple[str, Any]]:
    """(dotted name, value) of the leaves of nested dicts and lists."""
    if isinstance(value, (dict, list)):
        for k, v in value.items() if isinstance(value, dict) else enumerate(value):
            yield from flattened(v, f"{name}.{k}" if name else str(k))
    else:
        yield name, value


def same_marts(a: Lakehouse, b: Lakehouse) -> bool:
    """Whether two lakehouses hold the same marts."""
    for n in MARTS:
        x, y = a.read(n), b.read(n)
        if not x.exceptAll(y).isEmpty() or not y.exceptAll(x).isEmpty():
            return False
    return True


def mart_views(events: DataFrame) -> None:
    """Views of all marts over some events, without writing them."""
    for name, df in build_marts(events, events).items():
        df.createOrReplaceTempView(name)
