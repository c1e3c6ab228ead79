"""The most frequent pairs of products bought in one session, with most pairs never made."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from brooklet.operators.kept import kept_rows

#: Products whose pairs give the bound, and the products that a task pairs at most with as many others.
PROBED, BLOCK = 1000, 1024


def top_pairs(bought: DataFrame, top: int, probed: int = PROBED, block: int = BLOCK) -> tuple[DataFrame, DataFrame, int]:
    """(the ``top`` pairs by sessions, then products; sessions of each product; all sessions) of distinct (session_id, product_id).

    A pair has at most as many sessions as the rarer of its products. So the
    ``top``-th best count among the pairs of the ``probed`` most sold products is a
    bound that no product below takes part in a top pair: ties included, what is
    sold at least as often as the bound is all that has to be paired. Purchases are read
    once and kept on disk meanwhile; the result, ``top`` rows, is collected.
    """
    spark, kept = bought.sparkSession, kept_rows(bought, StorageLevel.DISK_ONLY)
    sold = kept_rows(kept.groupBy("product_id").agg(F.count(F.lit(1)).alias("n")), StorageLevel.DISK_ONLY)
    try:
        sizes = kept.groupBy("session_id").agg(F.count(F.lit(1)).alias("n"))
        total, largest = sizes.agg(F.count("session_id"), F.max("n")).first()
        cut = (largest or 0) > block
        bound = _bound(kept, sold, top, probed, block, cut)
        best = _counted(at_least(kept, sold, bound), block, cut).orderBy(F.desc("co_purchase_sessions"), "product_a", "product_b").limit(top).collect()
        ends = sorted({p for r in best for p in (r.product_a, r.product_b)})
        counts = sold.where(F.col("product_id").isin(*ends)).collect() if ends else []  # two for each pair at most
    finally:
        sold.unpersist()
        kept.unpersist()
    return _local(spark, best, ["product_a", "product_b", "co_purchase_sessions"]), _local(spark, counts, ["product_id", "n"]), total


def _local(spark: SparkSession, rows: list, names: list[str]) -> DataFrame:
    """Rows of whole numbers as a frame of known size, from which the optimizer chooses its joins."""
    return spark.createDataFrame(pa.table({name: pa.array([r[name] for r in rows], pa.int64()) for name in names}))


def _bound(bought: DataFrame, sold: DataFrame, top: int, probed: int, block: int, cut: bool) -> int:
    """The sessions of the top-th best pair among the most sold products: no top pair has fewer."""
    heavy = sold.orderBy(F.desc("n"), "product_id").limit(probed).select("product_id")
    counts = _counted(bought.join(F.broadcast(heavy), "product_id"), block, cut).orderBy(F.desc("co_purchase_sessions")).limit(top).collect()
    return counts[-1].co_purchase_sessions if len(counts) == top else 1


def at_least(bought: DataFrame, sold: DataFrame, bound: int) -> DataFrame:
    """The purchases of products that are sold in at least ``bound`` sessions."""
    return bought if bound <= 1 else bought.join(sold.where(F.col("n") >= bound).select("product_id"), "product_id", "left_semi")


def _counted(bought: DataFrame, block: int, cut: bool) -> DataFrame:
    return session_pairs(bought, block, cut).groupBy("product_a", "product_b").agg(F.count(F.lit(1)).alias("co_purchase_sessions"))


def session_pairs(bought: DataFrame, block: int = BLOCK, cut: bool | None = None) -> DataFrame:
    """(product_a, product_b), a < b, of every session of distinct (session_id, product_id).

    Sizes come from an aggregate, so no task holds a session to count it. A basket
    of up to ``block`` products is paired where its rows meet. A larger
    one is cut into blocks by product, and each two blocks meet in a task of their
    own, so no task holds or pairs more than two blocks. ``cut`` tells whether there may be
    larger ones; without it they are looked for.
    """
    sizes = bought.groupBy("session_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    large = sizes.where(F.col("n") > block).select("session_id", F.ceil(F.col("n") / block).alias("blocks"))
    cut = not large.isEmpty() if cut is None else cut
    usual = bought.join(large, "session_id", "left_anti") if cut else bought
    basket = usual.groupBy("session_id").agg(F.sort_array(F.collect_list("product_id")).alias("basket")).where(F.size("basket") > 1)
    left = basket.select("basket", F.posexplode("basket").alias("at", "product_a"))
    small = left.select("product_a", F.explode(F.slice("basket", F.col("at") + 2, F.size("basket"))).alias("product_b"))
    if not cut:
        return small
    dealt = bought.join(large, "session_id").withColumn("own", F.pmod(F.xxhash64("product_id"), "blocks"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "session_id", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "product_id"
    )
    of = lambda side: F.collect_list(F.when(F.col("own") == F.col(side), F.col("product_id"))).alias(f"of_{side}")
    sides = met.repartition("session_id", "low", "high").groupBy("session_id", "low", "high").agg(of("low"), of("high"))
    crossed = sides.withColumn("a", F.explode("of_low")).withColumn("b", F.explode("of_high")).where("a < b OR (low < high AND a <> b)")
    return small.union(crossed.select(F.least("a", "b").alias("product_a"), F.greatest("a", "b").alias("product_b")))
