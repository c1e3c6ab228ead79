"""The lakehouse: Bronze, Silver and Gold as tables of generations, and the one batch function that batch and streaming runs share.

Each table is written in one atomic and idempotent step, Bronze first: a run that stops in
between is repaired by running it again, since new rows are found by anti joins
and Gold dates come from the batch's candidates, not from what was inserted.
Quality rules are counted in the job that writes; rows become part of a table only
if the rules hold. History marts are made of states that a batch updates for its
dates alone.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from brooklet.operators import marts, quality, states
from brooklet.operators.bronze import new_bronze, new_rows
from brooklet.operators.sessions import sessionize
from brooklet.operators.silver import affected_dates, deduplicate, new_silver, normalize, rejects
from brooklet.plans import catalog
from brooklet.plans.keys import BUCKETS, KeyIndex
from brooklet.plans.operations import timed_action
from brooklet.schemas import BRONZE, MARTS, SILVER
from brooklet.sources import sinks
from brooklet.sources.tables import GRACE, VERSIONS, Table

MODES = ("none", "affected_dates", "full", "rebuild")
PARTITIONS = {"bronze_events": "source_month", "silver_events": "event_date"}
_FROM_SESSIONS = {"session_funnel", "user_conversion_path", "time_to_conversion_distribution"}


def build_run_id(prefix: str = "run", at: datetime | None = None) -> str:
    return f"{prefix}-{(at or datetime.now(timezone.utc)).strftime('%Y%m%dT%H%M%S%fZ')}"


@dataclass
class Batch:
    """What a batch did."""

    run_id: str
    bronze_rows: int = 0
    silver_rows: int = 0
    rejected_rows: int = 0
    dates: list = field(default_factory=list)
    #: Rows that the batch brought in vain: times that can't be read, and copies of its own or of earlier rows.
    warnings: dict[str, int] = field(default_factory=dict)
    #: Seconds, jobs and tasks of each layer.
    metrics: dict[str, dict] = field(default_factory=dict)
    gold: dict[str, str] = field(default_factory=dict)


class Lakehouse:
    """Tables below one root folder, which all executors reach."""

    def __init__(self, spark: SparkSession, root: str, files: dict[str, int] | None = None, broadcast_rows: int = 0, key_database: str | None = None, buckets: int = BUCKETS) -> None:
        """``files``: how many files at most a write makes of each partition value, by table; by size where none is given.

        ``broadcast_rows``: up to how many keys of a target, by count, are broadcast to find new rows.
        ``key_database``: where bucketed tables of the keys of Bronze and Silver are kept, by which new rows are found without a shuffle of the target.
        """
        self.spark, self.root, self.files, self.broadcast_rows = spark, root.rstrip("/"), files or {}, broadcast_rows
        self.key_database, self.buckets = key_database, buckets

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def schema(self, name: str):
        return {"bronze_events": BRONZE, "silver_events": SILVER}.get(name) or MARTS[name].schema

    def table(self, name: str) -> Table:
        if name in states.STATES:
            state = states.STATES[name]
            return Table(self.spark, f"{self.root}/_state/{name}", state.schema, state.partition)
        return Table(self.spark, self.path(name), self.schema(name), PARTITIONS.get(name) or (None if name in PARTITIONS else MARTS[name].partition))

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """A table, or an older version of it; empty if nothing was written yet."""
        return self.table(name).read(version)

    def drop(self, *names: str) -> None:
        """Remove tables; with Silver, or without names, the states that are made of it."""
        for name in names or (*PARTITIONS, *MARTS):
            if sinks.exists(self.spark, self.path(name)):
                sinks.delete(self.spark, self.path(name), self.root)
        if (not names or "silver_events" in names) and sinks.exists(self.spark, f"{self.root}/_state"):
            sinks.delete(self.spark, f"{self.root}/_state", self.root)

    def create(self, *names: str) -> list[str]:
        """Empty tables with their schemas and partitions; those that exist stay. Returns what was made."""
        return [n for n in names or (*PARTITIONS, *MARTS) if self.table(n).create()]

    def recover(self, older_than: float = GRACE, keep: int = VERSIONS, execute: bool = True) -> dict[str, dict]:
        """Remove what stopped writes left behind, and versions beyond the last ``keep``. Without ``execute`` it is only told.

        No table needs mending after a stop: what wasn't committed was never part of it.
        """
        found = {n: self.table(n).expire(keep, older_than, execute) for n in (*PARTITIONS, *MARTS, *states.STATES)}
        return {n: x for n, x in found.items() if any(x.values())}

    def tables(self) -> list[str]:
        """The tables that stand, by name."""
        return sorted(n for n in (*PARTITIONS, *MARTS) if self.table(n).exists())

    def register_views(self) -> None:
        """Temporary views of the Gold tables, for SQL."""
        for name in MARTS:
            self.read(name).createOrReplaceTempView(name)

    def publish_catalog(self, database: str, location: str | None = None) -> list[str]:
        """The Gold tables as tables of the session catalog, at their newest versions; returns those that changed."""
        return catalog.publish(catalog.mart_tables(self), database, location)

    # Batch.

    def process(self, bronze: DataFrame, run_id: str, gold: str = "affected_dates", fail_on_quality: bool = True) -> Batch:
        """Land a batch of Bronze rows, publish its new events, and refresh the marts."""
        done = Batch(run_id)
        timed = lambda layer, work: done.metrics.update({layer: timed_action(self.spark, f"{run_id} {layer}", work)[1]})
        batch = bronze.persist(StorageLevel.DISK_ONLY)  # read for Bronze, Silver and quarantine
        try:
            timed("bronze", lambda: self.land(batch, done))
            timed("silver", lambda: self.publish(batch, done, fail_on_quality))
        finally:
            batch.unpersist()
        timed("gold", lambda: done.gold.update(self.refresh(done.dates, gold, fail_on_quality)))
        return done

    def land(self, batch: DataFrame, done: Batch) -> None:
        """New rows go to Bronze, and those of them that can't be cleaned to quarantine, before Bronze shows them."""
        table = self.table("bronze_events")
        fresh, found = quality.observed(self.new_bronze(batch).select(*BRONZE.names), [])
        generation = table.stage(fresh, self.files.get("bronze_events"))
        done.bronze_rows, _ = found(table.read_staged(generation))
        if not done.bronze_rows:
            table.discard(generation)
            return
        bad = rejects(table.read_staged(generation)).persist(StorageLevel.DISK_ONLY)  # all rows are judged once
        try:
            done.rejected_rows = bad.count()
            if done.rejected_rows:
                sinks.quarantine(bad, self.root, done.run_id)
        finally:
            bad.unpersist()
        table.add(generation)

    def publish(self, batch: DataFrame, done: Batch, fail_on_quality: bool = True) -> None:
        """New events of some Bronze rows go to Silver, if they pass the quality gate."""
        table = self.table("silver_events")
        normalized = normalize(batch)
        seen = normalized.agg(*quality.seen_counts()).first()
        candidates = deduplicate(normalized).persist(StorageLevel.DISK_ONLY)
        try:
            done.dates = affected_dates(candidates)
            fresh = self.new_silver(candidates, done.dates).select(*SILVER.names)
            done.silver_rows = self._publish(table, fresh, quality.silver_rules(), quality.SILVER_COLUMNS, fail_on_quality, table.add, self.files.get("silver_events"))
        finally:
            candidates.unpersist()
        done.warnings = {"invalid_timestamps": seen.invalid_timestamps, "repeated_rows": seen.valid_rows - done.silver_rows}

    def keys(self, name: str, key: str) -> KeyIndex | None:
        return KeyIndex(self.table(name), key, self.key_database, f"{name}_keys", self.buckets) if self.key_database else None

    def new_bronze(self, batch: DataFrame) -> DataFrame:
        """The rows of a batch that Bronze lacks."""
        index = self.keys("bronze_events", "record_hash")
        if index is None:
            return new_bronze(batch, self.read("bronze_events"), self.broadcast_rows)
        months = [r[0] for r in batch.select("source_month").distinct().collect()]  # one entry for each
        near = F.col("source_month").isin(*months) if months else F.lit(False)
        return new_rows(index.dealt(batch), index.keys(), index.key, near)

    def new_silver(self, candidates: DataFrame, dates: list) -> DataFrame:
        """The deduplicated candidates that Silver lacks."""
        index = self.keys("silver_events", "dedupe_key")
        if index is None:
            return new_silver(candidates, self.read("silver_events"), dates, self.broadcast_rows)
        return new_silver(index.dealt(candidates), index.keys(), dates)

    def _publish(self, table: Table, df: DataFrame, rules: list[quality.Rule], required, fail_on_quality: bool, commit, files: int | None = None, keep_empty: bool = False) -> int:
        """Write rows in one job that also counts the rules, and commit them if these hold; returns their number."""
        watched, found = quality.observed(df, rules, required)
        generation = table.stage(watched, files)
        rows, results = found(table.read_staged(generation))
        try:
            quality.gate(results, fail_on_quality)
        except quality.QualityError:
            table.discard(generation)
            raise
        if rows or keep_empty:
            commit(generation)
        else:
            table.discard(generation)
        return rows

    # Gold.

    def refresh(self, dates: list, mode: str = "affected_dates", fail_on_quality: bool = True) -> dict[str, str]:
        """Refresh the marts: none; the given dates of date-scoped marts and what they change in history marts; or everything.

        "full" and "rebuild" recompute all dates; "full" only if the batch had any, "rebuild" always.
        Of Silver, "affected_dates" reads the given dates alone.
        """
        if mode not in MODES:
            raise ValueError(f"mode is one of {MODES}")
        if mode == "none" or (not dates and mode != "rebuild"):
            return {}
        partial = mode == "affected_dates" and all(self.table(n).exists() for n in states.STATES)
        silver = self.read("silver_events")
        scoped = silver.where(F.col("event_date").isin(*dates)) if mode == "affected_dates" else silver
        sessions = sessionize(scoped).persist(StorageLevel.DISK_ONLY)  # for three marts and a state
        try:
            if partial:
                self._update_states(scoped, sessions, dates)
            else:
                self._build_states(silver, sessions if scoped is silver else sessionize(silver))
            written = {}
            for name, df in self.marts(scoped, sessions).items():
                mart, table = MARTS[name], self.table(name)
                whole = mart.scope == "history" or mode != "affected_dates"
                commit = table.put if whole else lambda g, t=table: t.put_partitions(g, dates)
                self._publish(table, df, quality.mart_rules(mart), mart.schema.names, fail_on_quality, commit, keep_empty=True)
                written[name] = "table" if whole else "partitions"
        finally:
            sessions.unpersist()
        return written

    def marts(self, events: DataFrame, sessions: DataFrame) -> dict[str, DataFrame]:
        """Every mart: date-scoped ones over some events and their sessions, the others over the states."""
        out = {}
        for name, mart in MARTS.items():
            if mart.scope == "history":
                df = marts.OF_STATE[name](self.read(states.STATE_OF[name]))
            else:
                df = getattr(marts, name)(sessions if name in _FROM_SESSIONS else events)
            out[name] = df.select(*mart.schema.names)
        return out

    def _update_states(self, events: DataFrame, sessions: DataFrame, dates: list) -> None:
        """Bring the states up to date with the events of some dates."""
        for name, state in states.STATES.items():
            table, new = self.table(name), getattr(states, name)(sessions if name == "baskets" else events)
            if state.by_date:
                table.replace_partitions(new, dates)
            else:
                months = sorted({d.replace(day=1) for d in dates})
                held = table.read().where(F.col(state.partition).isin(*months))
                table.append(new.join(held, state.schema.names, "left_anti"))

    def _build_states(self, silver: DataFrame, sessions: DataFrame) -> None:
        for name in states.STATES:
            self.table(name).replace(getattr(states, name)(sessions if name == "baskets" else silver))


def build_marts(scoped: DataFrame, history: DataFrame, names: list[str] | None = None) -> dict[str, DataFrame]:
    """Every mart without tables: date-scoped ones over ``scoped`` events, the others over all."""
    out = {}
    for name in names or MARTS:
        events = scoped if MARTS[name].scope == "date" else history
        out[name] = getattr(marts, name)(sessionize(events) if name in {*_FROM_SESSIONS, "product_affinity"} else events)
    return out
