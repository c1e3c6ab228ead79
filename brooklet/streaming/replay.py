"""Streaming: replayed event messages through the same batch function, micro-batch by micro-batch."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import islice, takewhile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from brooklet.functions.expressions import month_of, parsed_time, unused
from brooklet.operators.bronze import project_bronze
from brooklet.plans.lakehouse import Lakehouse
from brooklet.plans.operations import append_event, now
from brooklet.schemas import ENVELOPE, EVENT_COLUMNS
from brooklet.sources import sinks
from brooklet.sources.tables import put_file


def parse_envelope(messages: DataFrame) -> DataFrame:
    """(value, timestamp) messages as columns; malformed messages have parsed = false and null columns."""
    parsed = messages.withColumn("m", F.from_json("value", ENVELOPE))
    return parsed.select(
        "value",
        F.col("timestamp").alias("arrived_at"),
        F.col("m.payload").isNotNull().alias("parsed"),
        "m.replayed_at",
        "m.source_file",
        "m.source_month",
        *[F.col(f"m.payload.{c}").alias(c) for c in EVENT_COLUMNS],
    )


def stream_bronze(parsed: DataFrame, run_id: str) -> DataFrame:
    """Bronze rows of parsed messages; the month falls back to that of the event."""
    month = F.coalesce("source_month", month_of(parsed_time("event_time")))
    file = F.coalesce("source_file", F.lit("stream_replay"))
    return project_bronze(parsed.where("parsed"), run_id, "stream", file, month)


def freshness(parsed: DataFrame) -> DataFrame:
    """Average and greatest seconds between replay and arrival."""
    lag = F.unix_timestamp("arrived_at") - F.unix_timestamp(parsed_time("replayed_at"))
    return parsed.where("parsed").agg(F.avg(lag).alias("avg_freshness_seconds"), F.max(lag).alias("max_freshness_seconds"))


@dataclass
class StreamRun:
    """Counts of a run's micro-batches."""

    processed: int = 0
    skipped: int = 0
    failed: int = 0
    rows: int = 0
    malformed: int = 0
    stop_reason: str = "completed"
    progress: list[dict] = field(default_factory=list)


class _Progress(StreamingQueryListener):
    """Collects the progress of one query's micro-batches, every one of them."""

    def __init__(self) -> None:
        self.seen: list[tuple[str, dict]] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.seen.append((str(p.id), {"batch_id": p.batchId, "rows": p.numInputRows}))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def of(self, query: str) -> list[dict]:
        """A batch's last progress is the one that counts."""
        return list({p["batch_id"]: p for q, p in self.seen if q == query}.values())


class Ledger:
    """The micro-batches that are done, by query and number; a record is written after everything else."""

    def __init__(self, lakehouse: Lakehouse, query: str) -> None:
        self._spark, self._folder = lakehouse.spark, f"{lakehouse.root}/_ledger/{query}"

    def _path(self, batch_id: int) -> str:
        return f"{self._folder}/{batch_id:012d}.json"

    def holds(self, batch_id: int) -> bool:
        return sinks.exists(self._spark, self._path(batch_id))

    def add(self, batch_id: int, **facts: object) -> None:
        put_file(self._spark, self._path(batch_id), json.dumps({"batch_id": batch_id, "at": now(), **facts}))


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the query that a checkpoint belongs to: the same after every restart, another one for a new checkpoint."""
    return spark.read.schema("id string").json(f"{checkpoint.rstrip('/')}/metadata").first().id


def run_stream(
    messages: DataFrame,
    lakehouse: Lakehouse,
    checkpoint: str,
    *,
    gold: str = "affected_dates",
    trigger_seconds: int | None = None,
    timeout_seconds: float | None = None,
    stop_after_seconds: float | None = None,
    poll_seconds: float = 0.5,
    query_name: str | None = None,
    progress_log: str | None = None,
) -> StreamRun:
    """Run a stream (value, timestamp) until it has caught up, or with a trigger until a deadline.

    ``timeout_seconds`` stops the query where it is; ``stop_after_seconds`` lets a
    micro-batch that is under way end first, so it is committed. A micro-batch that
    the ledger holds is skipped whole; one that stopped halfway is repeated and
    lands nothing twice. Runs are named by query and batch, so streams over one
    lakehouse keep apart. A late event reopens its date. Malformed messages go to quarantine.
    """
    run, spark = StreamRun(), lakehouse.spark

    def each(batch: DataFrame, batch_id: int) -> None:
        query = query_id(spark, checkpoint)
        ledger, run_id = Ledger(lakehouse, query), f"stream-{query}-{batch_id}"
        if ledger.holds(batch_id):
            run.skipped += 1
            return
        parsed = parse_envelope(batch).persist()
        try:
            rows, malformed = parsed.agg(F.count(F.lit(1)), F.count_if(~F.col("parsed"))).first()
            if not rows:
                run.skipped += 1
                ledger.add(batch_id, rows=0)
                return
            if malformed:
                bad = parsed.where("NOT parsed").select(F.sha2("value", 256).alias("record_hash"), F.lit("malformed_message").alias("reason"), "value")
                # A folder of this query's batch alone: a repeat writes the same rows there.
                bad.withColumn("rejected_at", F.current_timestamp()).write.mode("overwrite").json(f"{lakehouse.root}/_quarantine/run_id={run_id}-malformed")
            done = lakehouse.process(stream_bronze(parsed, run_id), run_id, gold, fail_on_quality=False)
            run.processed += 1
            run.rows += rows
            run.malformed += malformed
            if progress_log:
                append_event(progress_log, type="microbatch", batch_id=batch_id, rows=rows, malformed=malformed, bronze_rows=done.bronze_rows, silver_rows=done.silver_rows, at=now(), **freshness(parsed).first().asDict())
            ledger.add(batch_id, run_id=run_id, rows=rows, malformed=malformed, bronze_rows=done.bronze_rows, silver_rows=done.silver_rows)
        except Exception:
            run.failed += 1
            raise
        finally:
            parsed.unpersist()

    writer = messages.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    writer = writer.trigger(processingTime=f"{trigger_seconds} seconds") if trigger_seconds else writer.trigger(availableNow=True)
    listener = _Progress()
    spark.streams.addListener(listener)
    try:
        query, began = writer.start(), time.monotonic()
        try:
            while not query.awaitTermination(poll_seconds):
                if timeout_seconds is not None and time.monotonic() - began >= timeout_seconds:
                    run.stop_reason = "timeout"
                    break
                if stop_after_seconds is not None and time.monotonic() - began >= stop_after_seconds and not query.status["isTriggerActive"]:
                    run.stop_reason = "stop_after"
                    break
        finally:
            if query.isActive:
                query.stop()
            spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()  # events still on their way
            run.progress = listener.of(str(query.id))
    finally:
        spark.streams.removeListener(listener)
    return run


def envelopes(raw: DataFrame, source_file: str | None = None) -> DataFrame:
    """Raw rows as messages (value), stamped with the time of the run."""
    file = F.lit(source_file) if source_file else F.col("source_file")
    month = F.nullif(F.substring(F.coalesce("event_time", F.lit("")), 1, 7), F.lit(""))
    replayed = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    fields = F.struct(replayed.alias("replayed_at"), file.alias("source_file"), month.alias("source_month"), F.struct(*EVENT_COLUMNS).alias("payload"))
    return raw.select(F.to_json(fields, {"ignoreNullFields": "false"}).alias("value"))


def replayed(raw: DataFrame, source_file: str | None = None, max_rows: int | None = None, repeat: bool = False) -> DataFrame:
    """Messages of raw rows, by Spark; with ``repeat`` as many rounds as ``max_rows`` asks for. Exactly ``max_rows`` where there are so many."""
    if repeat and max_rows is not None:
        rounds = -(-max_rows // max(1, raw.count()))
        (turn,) = unused(raw.columns, "turn")
        raw = raw.withColumn(turn, F.explode(F.sequence(F.lit(1), F.lit(max(1, rounds))))).drop(turn)
    messages = envelopes(raw, source_file)
    return messages if max_rows is None else messages.limit(max_rows)


def write_messages(messages: DataFrame, folder: str, rows_per_file: int = 500) -> None:
    """Messages as files of a stream folder, written by the tasks that hold them; a file appears whole when the job commits."""
    messages.select("value").write.mode("append").option("maxRecordsPerFile", rows_per_file).text(folder)


def replay_messages(rows: list[dict], source_file: str, max_rows: int | None = None, repeat: bool = False, runtime_seconds: float | None = None) -> Iterator[str]:
    """Envelope messages of raw rows, up to ``max_rows`` or for ``runtime_seconds``, over and over if asked."""
    began = time.monotonic()

    def once() -> Iterator[str]:
        for r in rows:
            time_ = r.get("event_time") or ""
            yield json.dumps({"replayed_at": now(), "source_file": source_file, "source_month": time_[:7] or None, "payload": {c: r.get(c) for c in EVENT_COLUMNS}})

    def endless() -> Iterator[str]:
        while rows:
            yield from once()

    bounded = max_rows is not None or runtime_seconds is not None
    messages = islice(endless() if repeat and bounded else once(), max_rows)
    return messages if runtime_seconds is None else takewhile(lambda _: time.monotonic() - began < runtime_seconds, messages)


def drop_messages(messages: Iterator[str], folder: str, rows_per_file: int = 500, sleep_seconds: float = 0.0, report: Callable[[int], None] | None = None) -> int:
    """Write messages as files of a stream folder; returns how many. A file appears whole, by renaming.

    ``sleep_seconds`` pass between files; ``report`` hears the number of messages after each.
    """
    Path(folder).mkdir(parents=True, exist_ok=True)
    n = 0
    while part := list(islice(messages, rows_per_file)):
        path = Path(folder) / f"messages-{n:09d}.jsonl"
        hidden = path.with_name(f".{path.name}")
        hidden.write_text("\n".join(part) + "\n")
        hidden.rename(path)
        n += len(part)
        if report:
            report(n)
        time.sleep(sleep_seconds)
    return n


def stream_to_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    """Send (value) rows to a topic, where the Kafka connector is installed."""
    messages.select("value").write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def marts_of_stream(spark: SparkSession, messages: DataFrame, root: str, checkpoint: str) -> DataFrame:
    """daily_revenue after a whole stream has run."""
    house = Lakehouse(spark, root)
    run_stream(messages, house, checkpoint)
    return house.read("daily_revenue")
