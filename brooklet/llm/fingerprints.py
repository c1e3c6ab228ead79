"""Document fingerprints: bottom-k sketches of five-word shingle hashes, in DataFrame functions only.

A sketch is the sorted array of the k least distinct shingle hashes (fewer words
than a shingle: the whole sequence as one; no words: empty). Sketches merge by
union, and estimate resemblance, containment and the number of distinct
shingles; while the documents have fewer than k shingles together, all of these
are exact. Two empty sketches are alike
(1.0), an empty and another are not (0.0). Null texts count as empty.

Neighbours in doc_id order are found without a global sort in one task: quantile
bounds (at most ``COARSE``, collected) cut the ids into ranges, each range is cut
again in even parts, and the first rows of a part are also sent, as guests, to the
end of the part before it (of the last part for the very first rows). Parts grow
in number with the rows, up to ``PARTS``, whose first rows are a table of a proven
size; with more rows they grow in length, to some 400 MB at 100 TB. Null ids come
first. Rows that repeat an id follow in the order of their texts' hashes (equal
rows in any order, which makes no difference), so an id that many rows share is
cut in parts too. Very long texts are sketched whole. Documents without neighbours
are their own next ones, an empty table gives an empty result, and columns other
than doc_id and text, whatever their names, change nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brooklet.llm.common import table, unused

K = 128
SHINGLE = 5
COARSE, PARTS, STEP = 4096, 262_144, 64
ROWS_PER_PART = 1000
_NULL_ID = -(1 << 63)
_SEPARATORS = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), _SEPARATORS), lambda w: w != F.lit(""))


def sketch(text: Column, k: int = K, size: int = SHINGLE) -> Column:
    """The bottom-k sketch of a text: array<bigint>, ascending."""
    hashes = F.transform(words(text), lambda w: F.xxhash64(w))

    def of(row: Column) -> Column:
        n = F.size(row)
        rolled = F.transform(F.sequence(F.lit(0), n - size), lambda i: F.xxhash64(*[F.get(row, i + j) for j in range(size)]))
        return F.when(n == 0, F.array().cast("array<bigint>")).when(n < size, F.array(F.xxhash64(row))).otherwise(rolled)

    # A lambda variable stands for the hashes, so they are computed once.
    shingles = F.element_at(F.transform(F.array(hashes), of), 1)
    return F.slice(F.sort_array(F.array_distinct(shingles)), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union of two shingle sets."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of common shingles among all of two documents."""
    both = merged(a, b, k)
    common = F.size(F.array_intersect(F.array_intersect(both, a), b))
    return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(common / F.size(both))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below k, else (k - 1) / (share of the hash range below the k-th)."""
    share = (F.element_at(a, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b holds."""
    r, n = resemblance(a, b, k), distinct_shingles(a, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), r * distinct_shingles(merged(a, b, k), k) / n))


def printed(a: Column) -> Column:
    """A sketch as text: 16 hexadecimal digits for each hash."""
    return F.lower(F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def _numbers(values: list[int]) -> Column:
    """A literal array of numbers, as one expression that folds."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _at_most(bounds: list[int], key: Column) -> Column:
    """How many of the sorted bounds, the first of which is the least key, are at most the key; searched in two steps."""
    block = F.size(F.filter(_numbers(bounds[::STEP]), lambda b: b <= key)) - 1
    return block * STEP + F.size(F.filter(F.slice(_numbers(bounds), block * STEP + 1, STEP), lambda b: b <= key))


def cut_points(cuts: list[int], low: int, high: int, parts: int) -> list[tuple[int, int, int]]:
    """(first key, last key, parts) of the ranges between quantiles; a key that is several quantiles has a range of its own."""
    weight: dict[int, int] = {low: 1}
    for c in cuts:
        weight[c] = weight.get(c, 0) + 1
    bounds = sorted({*weight, *(c + 1 for c, n in weight.items() if n > 1 and c < high)})
    return [(a, b - 1, parts * weight.get(a, 1)) for a, b in zip(bounds, [*bounds[1:], high + 1], strict=True)]


def _part(ranges: list[tuple[int, int, int]], key: Column, tie: Column) -> Column:
    """The number of a key's part: ascending with (key, tie)."""
    if len(ranges) == 1 and ranges[0][2] == 1:
        return F.lit(0)
    lows, highs, parts = zip(*ranges, strict=True)
    bases = [sum(parts[:i]) for i in range(len(parts))]
    at = _at_most(list(lows), key)
    of = lambda values: F.element_at(_numbers(list(values)), at)
    start = of(lows).cast("double")
    along = key.cast("double") - start + (tie.cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    inside = F.floor(along / F.greatest(of(highs).cast("double") - start + 1, F.lit(1.0)) * of(parts))
    return (of(bases) + F.least(inside, of(parts) - 1)).cast("int")


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``docs`` (doc_id, text, ..) with next_<c> for each of the columns: the next row's in doc_id order, the first's after the last.

    A column that has such a name already is replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop(*[f"next_{c}" for c in columns])
    key, tie, part, before, stop = unused([*docs.columns, *[f"next_{c}" for c in columns]], "key", "tie", "part", "before", "stop")
    whole = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NULL_ID)).alias("key"), F.xxhash64("text").alias("tie"))
    rows, low, high = whole.agg(F.count(F.lit(1)), F.min("key"), F.max("key")).first()
    n = max(1, min(PARTS, rows // ROWS_PER_PART))
    coarse = min(n, COARSE)
    cuts = whole.agg(F.percentile_approx("key", [i / coarse for i in range(1, coarse)], 10 * coarse)).first()[0] if coarse > 1 else []
    ranges = cut_points(cuts, low or 0, high or 0, -(-n // coarse))
    firsts = whole.withColumn("part", _part(ranges, F.col("key"), F.col("tie"))).groupBy("part").agg(F.min(F.struct("key", "tie")).alias("first")).select("part", "first.*").collect()
    order = sorted((r["part"], r["key"], r["tie"]) for r in firsts)
    # At most some PARTS rows: the first place of each part and the part before it.
    first = spark.createDataFrame([(k, t, order[i - 1][0]) for i, (_, k, t) in enumerate(order)] or [(0, 0, 0)], f"`{key}` long, `{tie}` long, `{before}` int")
    placed = docs.withColumn(key, F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NULL_ID))).withColumn(tie, F.xxhash64("text"))
    placed = placed.withColumn(part, _part(ranges, F.col(key), F.col(tie)))
    own = F.struct(F.col(part).alias("at"), F.lit(False).alias("guest"))
    stops = F.when(F.col(before).isNull(), F.array(own)).otherwise(F.array(own, F.struct(F.col(before).alias("at"), F.lit(True).alias("guest"))))
    sent = placed.join(F.broadcast(first), [key, tie], "left").withColumn(stop, F.explode(stops))
    window = Window.partitionBy(f"{stop}.at").orderBy(f"{stop}.guest", key, tie, "text")
    led = sent.select("*", *[F.lead(c).over(window).alias(f"next_{c}") for c in columns])
    return led.where(~F.col(f"{stop}.guest")).drop(key, tie, part, before, stop)


def fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row."""
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("bottom", sketch(F.col("text"), k))
    n = F.char_length("text").cast("long")
    taken = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), (n - taken).cast("int")), F.substring(F.col("next_text"), F.lit(1), taken))
    near = with_next(base, ["text", "bottom"]).select("doc_id", n.alias("n_chars"), "bottom", "next_bottom", edited.alias("edited"))
    near = near.withColumn("edited_bottom", sketch(F.col("edited"), k))
    return near.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        printed(F.col("bottom")).alias("fingerprint"),
        printed(F.col("edited_bottom")).alias("edited_fingerprint"),
        resemblance(F.col("bottom"), F.col("edited_bottom"), k).alias("near_edited"),
        resemblance(F.col("bottom"), F.col("next_bottom"), k).alias("near_next"),
    )


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


QUERIES = {"op3_fingerprints": op3_fingerprints}
ORACLES: dict[str, str] = {}
