"""Bronze: raw rows with lineage and hash, each landed once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brooklet.functions.expressions import record_hash
from brooklet.schemas import EVENT_COLUMNS


def project_bronze(raw: DataFrame, run_id: str, source_type: str, source_file: Column, source_month: Column) -> DataFrame:
    """Adds lineage and the record hash; rows without a yyyy-MM month are left out."""
    return raw.select(
        F.lit(run_id).alias("batch_run_id"),
        F.current_timestamp().alias("ingested_at"),
        F.lit(source_type).alias("source_type"),
        source_file.alias("source_file"),
        source_month.alias("source_month"),
        record_hash(source_file).alias("record_hash"),
        *[F.col(c).cast("string").alias(c) for c in EVENT_COLUMNS],
    ).where(F.col("source_month").rlike(r"^\d{4}-\d{2}$"))


def small_enough(df: DataFrame, most: int) -> DataFrame:
    """The frame, marked for broadcast if it has at most ``most`` rows, which are counted no further than that (0: never)."""
    return F.broadcast(df) if most > 0 and df.limit(most + 1).count() <= most else df


def absent(candidates: DataFrame, present: DataFrame, key: str, prune: Column | None = None, broadcast_rows: int = 0) -> DataFrame:
    """Candidates whose key the target lacks.

    ``prune`` limits the target to the partitions that can hold the keys. Its keys
    are broadcast if they are counted to be at most ``broadcast_rows``; else the
    anti join is left to Catalyst and its size threshold.
    """
    target = (present if prune is None else present.where(prune)).select(key)
    return candidates.join(small_enough(target, broadcast_rows), key, "left_anti")


def new_rows(candidates: DataFrame, present: DataFrame, key: str, prune: Column | None = None, broadcast_rows: int = 0) -> DataFrame:
    """Candidates whose key the target lacks, one row per key."""
    return absent(candidates.dropDuplicates([key]), present, key, prune, broadcast_rows)


def new_bronze(candidates: DataFrame, present: DataFrame, broadcast_rows: int = 0) -> DataFrame:
    """New raw rows: the target is pruned to the batch's months (one entry each) and files (a semi join, for any number of them)."""
    months = [r[0] for r in candidates.select("source_month").distinct().collect()]
    files = candidates.select("source_file").distinct()
    near = present.where(F.col("source_month").isin(*months) if months else F.lit(False))
    return new_rows(candidates, near.join(files, "source_file", "left_semi"), "record_hash", broadcast_rows=broadcast_rows)
