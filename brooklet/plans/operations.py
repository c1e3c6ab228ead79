"""Run manifests, timed actions, file statistics, small-file compaction and cached input samples."""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable
from datetime import datetime, timezone
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.functions.expressions import unused
from brooklet.sources import sinks
from brooklet.sources.tables import GRACE, VERSIONS, Table


def now() -> str:
    return datetime.now(timezone.utc).isoformat().replace("+00:00", "Z")


def write_manifest(folder: str, stage: str, run_id: str, status: str, started: str, **more: Any) -> str:
    """One JSON file per stage and run: inputs, outputs, metrics, details."""
    path = Path(folder) / f"{stage}-{run_id}.json"
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps({"stage": stage, "run_id": run_id, "status": status, "started_at": started, "finished_at": now(), **more}, default=str))
    return str(path)


def append_event(path: str, **event: Any) -> None:
    """One JSON line."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with open(path, "a") as f:
        f.write(json.dumps(event, default=str) + "\n")


def run_stage(folder: str, stage: str, run_id: str, work: Callable[[], dict], metrics_log: str | None = None) -> dict:
    """Run a stage; its manifest says succeeded, or failed with the error, which is raised again."""
    started = now()
    try:
        metrics = work()
    except Exception as error:
        write_manifest(folder, stage, run_id, "failed", started, details={"error": str(error)})
        raise
    write_manifest(folder, stage, run_id, "succeeded", started, metrics=metrics)
    if metrics_log:
        append_event(metrics_log, type="stage", stage=stage, run_id=run_id, metrics=metrics)
    return metrics


def read_manifests(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.json(f"{folder}/*.json")


def timed_action(spark: SparkSession, name: str, work: Callable[[], Any]) -> tuple[Any, dict]:
    """(result, metrics) of an action: seconds, jobs, stages, tasks.

    It runs under the caller's job group where there is one, so whoever can cancel that still
    can, else under one of its own.
    """
    context, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    outer = context.getLocalProperty("spark.jobGroup.id")
    group = outer or f"{name}-{uuid.uuid4().hex[:8]}"
    if outer is None:
        context.setJobGroup(group, name)
    earlier = set(tracker.getJobIdsForGroup(group))
    began, status, result = time.perf_counter(), "succeeded", None
    try:
        result = work()
    except Exception:
        status = "failed"
        raise
    finally:
        jobs = sorted(set(tracker.getJobIdsForGroup(group)) - earlier)
        stages = [s for j in jobs if (info := tracker.getJobInfo(j)) for s in info.stageIds]
        tasks = sum(info.numTasks for s in stages if (info := tracker.getStageInfo(s)))
        metrics = {"action": name, "status": status, "seconds": time.perf_counter() - began, "jobs": jobs, "stages": stages, "tasks": tasks}
        if outer is None:
            context.setLocalProperty("spark.jobGroup.id", None)
            context.setLocalProperty("spark.job.description", None)
    return result, metrics


def file_stats(sizes: DataFrame, small_bytes: int = 32 << 20) -> DataFrame:
    """One row over (path, bytes) of data files."""
    return sizes.agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("total_bytes"), F.coalesce(F.avg("bytes"), F.lit(0.0)).alias("average_bytes"), F.count_if(F.col("bytes") < small_bytes).alias("small_files")
    )


def maintain(table: Table, small_bytes: int = 32 << 20, execute: bool = False, keep: int = VERSIONS, older_than: float = GRACE) -> dict:
    """The file report of a table, and what could go; with ``execute``, compaction where there are several small files, and expiry."""
    report = lambda: file_stats(table.file_sizes(), small_bytes).first().asDict()
    before = report()
    if execute and before["small_files"] > 1:
        table.compact()
        return {"before": before, "after": report(), "expired": table.expire(keep, older_than, True)}
    return {"before": before, "expired" if execute else "expirable": table.expire(keep, older_than, execute)}


def cached_sample(df: DataFrame, folder: str, descriptor: dict, fraction: float, seed: int = 42) -> tuple[DataFrame, bool]:
    """(sample, whether it was there): a Bernoulli sample kept under the hash of its descriptor."""
    spark = df.sparkSession
    key = hashlib.sha256(json.dumps({**descriptor, "fraction": fraction, "seed": seed}, sort_keys=True, default=str).encode()).hexdigest()
    path = f"{folder.rstrip('/')}/{key}"
    there = sinks.exists(spark, f"{path}/_SUCCESS")
    if not there:
        sinks.replace_table(bernoulli_sample(df, fraction, seed), path)
    return spark.read.parquet(path), there


def bernoulli_sample(df: DataFrame, fraction: float, seed: int = 42, key: list[str] | None = None) -> DataFrame:
    """Each row with a probability, drawn from the hash of its values (of ``key``, or of all columns).

    The same rows come whatever the layout of the files, and again after a lost
    task; rows with equal values come or go together.
    """
    values = [F.col(f"`{c}`").cast("string") for c in key or df.columns]
    return df.where(hash_share(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(v, F.lit("")) for v in values])) < fraction)


def hash_share(text: Column) -> Column:
    """A number from 0 to 1 by the first 32 bits of the SHA-256 of a text."""
    return F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double") / float(1 << 32)


def number_slices(df: DataFrame, key: str, rows_per_slice: int) -> DataFrame:
    """Adds slice, the micro-batch of each row, by exact position in key order."""
    from brooklet.operators.ranking import global_positions

    (position,) = unused(df.columns, "position")
    placed, _ = global_positions(df, {position: [F.col(key)]})
    return placed.withColumn("slice", F.floor((F.col(position) - 1) / rows_per_slice)).drop(position)
