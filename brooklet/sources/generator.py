"""Seeded synthetic events, made in parallel from a range of row numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Share of all events up to each type.
TYPES = (("view", 0.80), ("cart", 0.95), ("purchase", 1.0))
#: How many of each there are. Names are made from the numbers: category 7 is dept2.line07.
CATEGORIES, DEPARTMENTS, BRANDS, PRODUCTS = 24, 5, 60, 3000
#: Users take part by a power law: user u with weight falling in u.
USERS, SESSIONS_PER_USER, LOWEST_PRICE, HIGHEST_PRICE = 20_000, 3, 0.5, 800.0


def _uniform(seed: int, salt: str) -> Column:
    """A number in [0, 1) that depends on the row number alone, not on partitions."""
    return F.pmod(F.xxhash64(F.lit(f"{seed}:{salt}"), "id"), F.lit(1 << 40)) / float(1 << 40)


def synthetic_events(spark: SparkSession, rows: int, seed: int = 42, start: str = "2020-04-01 00:00:00", days: int = 1) -> DataFrame:
    """Raw event rows (all text): 80 % views, 15 % carts, 5 % purchases, spread over some days."""
    below = lambda salt, n, power=1.0: F.floor(F.pow(_uniform(seed, salt), F.lit(power)) * n).cast("long")
    kind_at = _uniform(seed, "type")
    kind = F.lit(TYPES[-1][0])
    for name, upto in reversed(TYPES[:-1]):
        kind = F.when(kind_at < upto, name).otherwise(kind)
    at = F.timestamp_seconds(F.unix_timestamp(F.lit(start).cast("timestamp")) + F.floor(_uniform(seed, "time") * days * 86400).cast("long"))
    # A product has one category, brand and price; popular products and busy users have low numbers.
    product, user = below("product", PRODUCTS, 2.0), below("user", USERS, 1.5)
    category, brand = product % CATEGORIES, product % BRANDS
    price = F.round(LOWEST_PRICE + (HIGHEST_PRICE - LOWEST_PRICE) * F.pmod(F.xxhash64(F.lit(seed), product), F.lit(10_000)) / 10_000, 2)
    return spark.range(rows).select(
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("event_time"),
        kind.alias("event_type"),
        product.cast("string").alias("product_id"),
        category.cast("string").alias("category_id"),
        F.format_string("dept%d.line%02d", category % DEPARTMENTS, category).alias("category_code"),
        F.format_string("brand%02d", brand).alias("brand"),
        F.format_string("%.2f", price).alias("price"),
        user.cast("string").alias("user_id"),
        F.format_string("u%d-%d", user, below("session", SESSIONS_PER_USER)).alias("user_session"),
    )
