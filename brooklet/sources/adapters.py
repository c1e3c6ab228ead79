"""Adapters from the benchmark's star-schema tables to the shapes the engine works on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as canonical events: clicks are carts, other types are left out, no session is given."""
    events = table(spark, sf_dir, "events").where(F.col("event_type").isin("view", "click", "purchase"))
    product = F.get_json_object("props", "$.k").cast("bigint")
    return events.select(
        F.col("event_id"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.to_date("ts").alias("event_date"),
        F.when(F.col("event_type") == "click", "cart").otherwise(F.col("event_type")).alias("event_type"),
        product.alias("product_id"),
        (product % 10).alias("category_id"),
        F.concat(F.lit("cat."), (product % 10).cast("string")).alias("category_code"),
        F.lit(None).cast("string").alias("brand"),
        F.col("value").alias("price"),
        F.col("user_id"),
        F.lit(None).cast("string").alias("user_session"),
    )


def order_purchases(spark: SparkSession, sf_dir: str, session: Column | None = None) -> DataFrame:
    """Order lines as purchases: the customer is the user, the order the session.

    ``session`` replaces the order's number as text. By the number itself (``o_orderkey``) lines are
    already together after the join, so what groups sessions needs no shuffle.
    """
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.to_date("o_orderdate").alias("event_date"),
        F.lit("purchase").alias("event_type"),
        F.col("l_partkey").alias("product_id"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("price"),
        F.col("o_custkey").alias("user_id"),
        (F.col("o_orderkey").cast("string") if session is None else session).alias("session_id"),
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as raw text rows in several spellings, with defects, and a second file that repeats a tenth of them."""
    e = table(spark, sf_dir, "events")
    every = lambda n: F.col("event_id") % n == 0
    clock = lambda f: F.date_format("ts", f)
    product = F.get_json_object("props", "$.k")
    kind = F.when(F.col("event_type") == "click", "cart").otherwise(F.col("event_type"))
    rows = e.select(
        F.lit("2024-Jan.csv").alias("source_file"),
        F.when(every(97), "garbage").when(every(3), clock("yyyy-MM-dd'T'HH:mm:ss'Z'")).when(every(2), clock("yyyy-MM-dd HH:mm:ss 'UTC'")).otherwise(clock("yyyy-MM-dd HH:mm:ss'+00:00'")).alias("event_time"),
        F.when(every(101), "").when(every(7), F.concat(F.lit(" "), F.initcap(kind), F.lit(" "))).otherwise(kind).alias("event_type"),
        F.when(every(79), "12.5").otherwise(product).alias("product_id"),
        F.concat(F.lit(" "), (product.cast("bigint") % 10).cast("string")).alias("category_id"),
        F.concat(F.lit("Cat."), (product.cast("bigint") % 10).cast("string")).alias("category_code"),
        F.when(every(5), "  ").otherwise("Acme ").alias("brand"),
        F.when(every(89), "bad").when(every(83), "NaN").otherwise(F.col("value").cast("decimal(18,2)").cast("string")).alias("price"),
        F.when(every(73), None).otherwise(F.col("user_id").cast("string")).alias("user_id"),
        F.when(every(4), F.concat(F.lit("s-"), F.col("user_id").cast("string"))).alias("user_session"),
        F.col("event_id"),
    )
    again = rows.where(every(10)).withColumn("source_file", F.lit("2024-Feb.csv"))
    return rows.unionByName(again)
