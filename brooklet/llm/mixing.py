"""Mix sources to target weights, with DataFrame functions only.

Tokens per source give repetition rates; a document appears floor(rate) times
plus one more where its hash falls below the fraction. Nulls: a null text has
size 0, a null source is a source of its own, last in order; very long texts are
counted whole. Rows that repeat a doc_id share one draw, so reruns and retried
tasks agree; they count and are taken each for itself. Sources of one cap per
weight stop in their order. A source without words has rate 0, and an empty table
gives an empty result. ``mixed_documents`` keeps all columns, whatever their
names, and puts the copies of a document side by side; the other functions read
doc_id, text and source alone.

No row is collected: a hot source is pre-aggregated before the shuffle, and the
per-source table, one row per source, is written in the shared folder and joined
back by source. Its size on disk decides the join: under the session's threshold
it is broadcast and documents aren't moved at all; above it, adaptive execution
splits a hot source. Sources may be as many as hosts: their places in order are
numbered range by range, and the level at which sources stop is found by rounds of
sums, so no task sees them all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.llm.common import WORD_PATTERN, every, table, unused, written
from brooklet.operators.ranking import global_positions

WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
CAP = 2


def word_count(text: Column) -> Column:
    """Number of words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, share_percent: int = SHARE_PERCENT, cap: int = CAP) -> DataFrame:
    """(source, source_size, target) of rows (source, size).

    Targets share the total by weight; one above ``cap`` times its source's size
    stops there and the excess is reshared. Stopped sources leave the others a
    higher level (words per weight), at which more may stop; each round sums what
    is stopped and the weights of the rest, until no other source stops.
    """
    per = written(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    placed, _ = global_positions(per, {"place": [F.col("source").isNull(), F.coalesce("source", F.lit(""))]})
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))
    weighted = written(placed.select("source", "source_size", weight.cast("long").alias("weight"), (F.col("source_size") * cap).alias("most")), "weighted")
    level, stopped = 0.0, -1
    while True:
        stops = (F.col("most") <= F.lit(level) * F.col("weight")) if stopped >= 0 else F.lit(False)
        size, held, rest, count = weighted.agg(
            F.sum("source_size"), F.coalesce(F.sum(F.when(stops, F.col("most"))), F.lit(0)), F.coalesce(F.sum(F.when(~stops, F.col("weight"))), F.lit(0)), F.count_if(stops)
        ).first()
        if count == stopped or not rest:
            break
        level, stopped = ((size or 0) * share_percent / 100.0 - held) / rest, count
    stops = F.col("most") <= F.lit(level) * F.col("weight")
    return weighted.select("source", "source_size", F.when(stops, F.col("most").cast("double")).otherwise(F.lit(level) * F.col("weight")).alias("target"))


def draw(doc_id: Column, seed: str) -> Column:
    """A number in [0, 1) from the md5 of seed and id: 52 bits, the same in any engine."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def mix(docs: DataFrame, seed: str = "mix", weights: Sequence[int] = WEIGHTS, share_percent: int = SHARE_PERCENT, cap: int = CAP) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies): how often each document enters the mix."""
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    targets = written(source_targets(sized, weights, share_percent, cap), "targets")
    keyed = targets.select(F.col("source").alias("source_key"), "source_size", "target")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    more = (draw(F.col("doc_id"), seed) < rate - F.floor(rate)).cast("long")
    return (
        sized.join(keyed, F.col("source").eqNullSafe(F.col("source_key")))
        .withColumn("copies", F.floor(rate) + more)
        .select("doc_id", "source", "size", "source_size", "target", "copies")
    )


def mixed_documents(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with their columns alone."""
    targets = written(source_targets(docs.select("source", word_count(F.col("text")).alias("size"))), "targets")
    key, rate, copy = unused(docs.columns, "key", "rate", "copy")
    keyed = targets.select(F.col("source").alias(key), F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias(rate))
    copies = F.floor(rate) + (draw(F.col("doc_id"), seed) < F.col(rate) - F.floor(rate)).cast("long")
    return (
        docs.join(keyed, F.col("source").eqNullSafe(F.col(key)))
        .withColumn(copy, F.explode(F.sequence(F.lit(0).cast("long"), copies)))
        .where(F.col(copy) > 0)
        .select(*every(docs))
    )


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents
), per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), w AS (
  SELECT *, CAST([3, 1, 2][CAST((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS INT)] AS BIGINT) AS weight, source_size * 2 AS most FROM per
), r AS (
  SELECT *, CAST(most AS DOUBLE) / weight AS at_level FROM w
), l AS (
  SELECT *, (CAST(sum(source_size) OVER () * 150 AS DOUBLE) / 100.0
      - CAST(coalesce(sum(most) OVER (ORDER BY at_level, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
      / CAST(sum(weight) OVER (ORDER BY at_level, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level,
    row_number() OVER (ORDER BY at_level, source NULLS LAST) AS place FROM r
), s AS (
  SELECT *, most <= level * weight AS stops FROM l
), t AS (
  SELECT source, source_size, CASE WHEN stops THEN CAST(most AS DOUBLE)
      ELSE (SELECT min_by(level, place) FROM s WHERE NOT stops) * weight END AS target FROM s
), d AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
    CAST(('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13)) AS BIGINT) / 4503599627370496.0 AS u
  FROM sized JOIN t ON sized.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  CAST((floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) * size AS taken FROM d
"""

QUERIES = {"op8_mixing": op8_mixing}
ORACLES = {"op8_mixing": ORACLE}
