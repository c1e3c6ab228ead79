"""Silver: typed, clean, deduplicated events; what can't be cleaned goes to quarantine with a reason."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brooklet.functions.expressions import clean_price, clean_text, dedupe_key, parsed_time
from brooklet.operators.bronze import absent
from brooklet.schemas import REQUIRED_COLUMNS, SILVER


def normalize(bronze: DataFrame) -> DataFrame:
    """Trimmed, lower-cased and typed values; the raw time and type stay for quality checks. Nothing is rejected here."""
    whole = lambda c: clean_text(c).try_cast("bigint")
    # Two steps: an expression that the second reads twice is computed once.
    timed = bronze.withColumn("parsed_time", parsed_time("event_time"))
    return timed.select(
        F.col("record_hash").alias("event_id"),
        "batch_run_id",
        "ingested_at",
        "source_file",
        "source_month",
        "record_hash",
        clean_text("event_time").alias("raw_event_time"),
        clean_text("event_type").alias("raw_event_type"),
        F.col("parsed_time").alias("event_time"),
        F.to_date("parsed_time").alias("event_date"),
        F.lower(clean_text("event_type")).alias("event_type"),
        whole("product_id").alias("product_id"),
        whole("category_id").alias("category_id"),
        F.lower(clean_text("category_code")).alias("category_code"),
        clean_text("brand").alias("brand"),
        clean_price("price").alias("price"),
        whole("user_id").alias("user_id"),
        clean_text("user_session").alias("user_session"),
    )


def valid(normalized: DataFrame) -> DataFrame:
    return normalized.where("event_time IS NOT NULL AND event_type IS NOT NULL")


def keyed(normalized: DataFrame) -> DataFrame:
    """The valid rows with their dedupe_key."""
    return valid(normalized).withColumn("dedupe_key", dedupe_key())


def deduplicate(normalized: DataFrame) -> DataFrame:
    """One row per event: of the valid rows with one dedupe key, the first by time and record hash.

    An aggregate with a map-side part, so an event repeated in a large share of
    all rows meets the shuffle once per task.
    """
    lead = ["event_time", "record_hash"]
    row = F.struct(*lead, *[c for c in SILVER.names if c not in (*lead, "dedupe_key")])
    return keyed(normalized).groupBy("dedupe_key").agg(F.min(row).alias("row")).select("dedupe_key", "row.*").select(*SILVER.names)


def affected_dates(normalized: DataFrame) -> list:
    """The distinct dates of a batch's valid rows: a bounded list, one entry per day. Reads time and type alone."""
    candidates = valid(normalized)
    return sorted(r[0] for r in candidates.select("event_date").distinct().collect())


def new_silver(candidates: DataFrame, present: DataFrame, dates: list | None = None, broadcast_rows: int = 0) -> DataFrame:
    """Deduplicated candidates not yet in the target, which is pruned to their dates (compared as dates, so partitions are skipped)."""
    days = affected_dates(candidates) if dates is None else dates
    return absent(candidates, present, "dedupe_key", F.col("event_date").isin(*days) if days else F.lit(False), broadcast_rows)


def with_reject_reason(bronze: DataFrame) -> DataFrame:
    """Adds missing_columns and reason: missing_required_columns, invalid_timestamp, or null for a good row."""
    missing = F.filter(F.array(*[F.when(clean_text(c).isNull(), F.lit(c)) for c in REQUIRED_COLUMNS]), lambda c: c.isNotNull())
    reason = F.when(F.size(missing) > 0, "missing_required_columns").when(parsed_time("event_time").isNull(), "invalid_timestamp")
    return bronze.withColumn("missing_columns", F.array_join(missing, ",")).withColumn("reason", reason)


def rejects(bronze: DataFrame) -> DataFrame:
    """The quarantine rows: hash, month, reason, missing columns and the raw row."""
    from brooklet.schemas import EVENT_COLUMNS

    return with_reject_reason(bronze).where("reason IS NOT NULL").select("record_hash", "source_month", "reason", "missing_columns", F.struct(*EVENT_COLUMNS).alias("payload"))
