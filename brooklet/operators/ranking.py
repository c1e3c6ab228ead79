"""Exact global positions and tiles without sorting everything in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from brooklet.functions.expressions import unused
from brooklet.operators.kept import kept_rows

#: Rows of a range, the most ranges, and sampled keys for each.
ROWS_PER_RANGE, RANGES, SAMPLED = 500_000, 2048, 32


def global_positions(df: DataFrame, orders: dict[str, list[Column]], rows_per_range: int = ROWS_PER_RANGE) -> tuple[DataFrame, int]:
    """(df with the 1-based position of each row in some total orders, number of rows).

    An order is a list of ascending columns without nulls. Bounds from a
    hash-ordered sample of the keys (``SAMPLED`` for each range reach the driver)
    cut each order into ranges, as many as the rows ask for, whose sizes (one
    number each) are collected; a
    row's position is its number in its range after the rows of earlier ranges,
    so each order costs one shuffle by range and no task sorts everything.
    """
    keys = {name: F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)]) for name, order in orders.items()}
    held = kept_rows(df.select(*[k.alias(name) for name, k in keys.items()]), StorageLevel.MEMORY_AND_DISK)
    try:
        total = held.count()
        ranges = max(1, min(RANGES, -(-total // rows_per_range)))
        sample = held.orderBy(F.xxhash64(next(iter(keys)))).limit(ranges * SAMPLED).collect() if ranges > 1 else []
        at = {name: _range_of(F.col(name), held, sorted({tuple(r[name]) for r in sample}), ranges) for name in keys}
        marked = held.select(F.explode(F.array(*[F.struct(F.lit(name).alias("name"), a.alias("at")) for name, a in at.items()])).alias("x"))
        sizes = {(r["name"], r["at"]): r["count"] for r in marked.groupBy("x.name", "x.at").count().collect()}
    finally:
        held.unpersist()
    key_, range_ = unused([*df.columns, *keys], "key", "range")
    for name, key in keys.items():
        before, offsets = 0, []
        for k in range(ranges + 1):
            offsets.append(before)
            before += sizes.get((name, k), 0)
        placed = df.withColumn(key_, key).withColumn(range_, _range_of(F.col(key_), df.select(key.alias(key_)), sorted({tuple(r[name]) for r in sample}), ranges))
        inside = F.row_number().over(Window.partitionBy(range_).orderBy(key_))
        df = placed.withColumn(name, inside + F.element_at(F.array(*[F.lit(o).cast("long") for o in offsets]), F.col(range_) + 1)).drop(key_, range_)
    return df, total


def _range_of(key: Column, frame: DataFrame, sample: list[tuple], ranges: int) -> Column:
    """The range (0..ranges) of a struct column, by bounds spaced evenly in a sorted sample."""
    step = max(1, -(-len(sample) // ranges))  # the ranges are numbered by a binary search over the bounds
    bounds = sample[step::step]
    if not bounds:
        return F.lit(0)
    fields = frame.schema[0].dataType if len(frame.columns) == 1 else frame.select(key.alias("k")).schema[0].dataType
    literals = F.array(*[F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(b, fields, strict=True)]) for b in bounds])
    steps = F.sequence(F.lit(1), F.lit(len(bounds).bit_length()))

    def halved(acc: Column, _: Column) -> Column:
        middle = F.floor((acc["low"] + acc["high"]) / 2).cast("int")
        up = (acc["low"] < acc["high"]) & (F.get(literals, middle) <= key)
        return F.struct(F.when(up, middle + 1).otherwise(acc["low"]).alias("low"), F.when(up, acc["high"]).otherwise(middle).alias("high"))

    return F.aggregate(steps, F.struct(F.lit(0).alias("low"), F.lit(len(bounds)).alias("high")), halved, lambda acc: acc["low"])


def in_order(df: DataFrame, columns: list[str], partition: str | None = None) -> DataFrame:
    """Rows by some ascending columns, nulls first: within each value of ``partition`` (no total sort), or all together."""
    order = [F.col(c).asc_nulls_first() for c in columns]
    return df.orderBy(*order) if partition is None else df.repartition(partition).sortWithinPartitions(partition, *order)


def tile_of(position: Column, rows: Column, tiles: int) -> Column:
    """The tile (1..tiles) of a position among ``rows``: the first ``rows % tiles`` tiles have one row more."""
    small, more = F.floor(rows / tiles), rows % tiles
    cut = more * (small + 1)
    return F.when(position <= cut, F.floor((position - 1) / (small + 1)) + 1).otherwise(more + F.floor((position - 1 - cut) / F.greatest(small, F.lit(1))) + 1)
