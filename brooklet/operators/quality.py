"""Data quality: declarative rules compiled into one aggregate per table, a gate, and samples of bad rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from brooklet.functions.expressions import is_type
from brooklet.schemas import EVENT_TYPES, MARTS, Mart

CRITICAL, WARNING = "critical", "warning"
SILVER_COLUMNS = ("event_time", "event_date", "event_type", "product_id", "user_id")


class QualityError(Exception):
    """A critical rule failed."""


@dataclass(frozen=True)
class Rule:
    """Rows that meet ``bad`` break the rule; ``needs`` are the columns it reads."""

    name: str
    bad: Column
    needs: tuple[str, ...]
    severity: str = CRITICAL


@dataclass(frozen=True)
class Result:
    name: str
    severity: str
    bad_rows: int

    @property
    def passed(self) -> bool:
        return self.bad_rows == 0


def bad_price() -> Column:
    return is_type("purchase") & (F.col("price").isNull() | F.isnan("price") | (F.col("price") < 0))


def silver_rules() -> list[Rule]:
    return [
        *[Rule(f"{c}_not_null", F.col(c).isNull(), (c,)) for c in ("event_time", "event_date", "event_type")],
        Rule("event_type_allowed", ~F.col("event_type").isin(*EVENT_TYPES), ("event_type",)),
        Rule("event_date_matches_time", F.col("event_date") != F.to_date("event_time"), ("event_date", "event_time")),
        Rule("purchase_price_valid", bad_price(), ("event_type", "price")),
    ]


def mart_rules(mart: Mart) -> list[Rule]:
    negative = F.lit(False)
    for c in mart.non_negative:
        negative = negative | F.coalesce(F.col(c) < 0, F.lit(False))
    rules = [Rule("metrics_not_negative", negative, mart.non_negative)]
    return ([Rule("event_date_not_null", F.col("event_date").isNull(), ("event_date",))] if mart.partition else []) + rules


def _counts(df: DataFrame, rules: Iterable[Rule], required: Iterable[str]) -> list[Column]:
    missing = [c for c in required if c not in df.columns]
    usable = [r for r in rules if set(r.needs) <= set(df.columns)]
    return [F.count(F.lit(1)).alias("rows"), F.lit(len(missing)).cast("long").alias("missing_columns"), *[F.count_if(r.bad).alias(r.name) for r in usable]]


def summarize(df: DataFrame, rules: Iterable[Rule], required: Iterable[str] = ()) -> DataFrame:
    """One row: rows, missing_columns, and the number of bad rows of each rule whose columns exist. One pass, no action."""
    return df.agg(*_counts(df, list(rules), required))


def observed(df: DataFrame, rules: Iterable[Rule], required: Iterable[str] = ()) -> tuple[DataFrame, Callable[[DataFrame], tuple[int, list[Result]]]]:
    """(the frame, what tells its rows and results once it was written): rules are counted where the rows pass, in the job that writes them.

    Spark reports nothing where it sees beforehand that there are no rows; then
    what was written, which the second takes, is looked at instead.
    """
    rules, required = list(rules), list(required)
    watch = Observation(f"quality-{uuid.uuid4().hex}")
    missing = sum(c not in df.columns for c in required)

    def found(written: DataFrame) -> tuple[int, list[Result]]:
        try:
            row = dict(watch.get)
        except Py4JJavaError:
            row = summarize(written, rules).first().asDict()
        return row.pop("rows"), _results({**row, "missing_columns": missing}, rules)

    return df.observe(watch, *_counts(df, rules, ())), found


def seen_counts() -> list[Column]:
    """Counts over a normalized batch."""
    return [
        F.count(F.lit(1)).alias("rows_seen"),
        F.count_if(F.col("raw_event_time").isNotNull() & F.col("event_time").isNull()).alias("invalid_timestamps"),
        F.count_if(F.col("event_time").isNotNull() & F.col("event_type").isNotNull()).alias("valid_rows"),
    ]


def silver_summary(normalized: DataFrame, published: DataFrame) -> DataFrame:
    """One row of counts over the normalized batch and the rows to publish; copies and rows already present are told apart."""
    return normalized.agg(*seen_counts()).crossJoin(summarize(published, silver_rules()))  # two one-row aggregates


def _results(row: dict[str, int], rules: Iterable[Rule]) -> list[Result]:
    severity = {r.name: r.severity for r in rules}
    return [Result("required_columns", CRITICAL, row["missing_columns"])] + [Result(k, severity[k], v) for k, v in row.items() if k in severity]


def evaluate(df: DataFrame, rules: Iterable[Rule], required: Iterable[str] = ()) -> list[Result]:
    rules = list(rules)
    return _results(summarize(df, rules, required).first().asDict(), rules)


def duplicates(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """One row: duplicate_keys, the number of key values that occur more than once."""
    return df.groupBy(*keys).count().where("count > 1").agg(F.count(F.lit(1)).alias("duplicate_keys"))


def bad_samples(df: DataFrame, rules: Iterable[Rule], limit: int = 5) -> dict[str, list[dict]]:
    """A few rows that break each rule."""
    return {r.name: [x.asDict() for x in df.where(r.bad).limit(limit).collect()] for r in rules if set(r.needs) <= set(df.columns)}


def gate(results: Iterable[Result], fail: bool = True) -> bool:
    """Whether all critical rules hold; raises otherwise unless ``fail`` is off."""
    broken = [f"{r.name}: {r.bad_rows}" for r in results if r.severity == CRITICAL and not r.passed]
    if broken and fail:
        raise QualityError("; ".join(broken))
    return not broken


def check_mart(df: DataFrame, name: str) -> list[Result]:
    mart = MARTS[name]
    return evaluate(df, mart_rules(mart), mart.schema.names)
