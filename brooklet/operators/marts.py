"""The marts: pure DataFrame to DataFrame functions shared by batch, streaming and tests.

Date-scoped marts group by event_date first, so a refresh of some dates equals
the same dates of a full run; history marts are functions of the states that
batches keep up to date. None runs an action, but for rfm_segmentation's last
date and bounded key samples, and product_affinity's bound on counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brooklet.functions.expressions import count_of, first_of, funnel_counts, is_type, money, month_of, path_label, ratio, revenue, to_cents, whole_seconds
from brooklet.operators import pairs, states
from brooklet.operators.ranking import global_positions, tile_of
from brooklet.schemas import EVENT_TYPES, MARTS, OTHER_SEGMENT, SEGMENTS, TIME_BUCKETS

TOP_PRODUCTS, TOP_PAIRS, LOOKBACK_DAYS, TILES = 10, 200, 90, 5
_RATES = (("view_to_cart_rate", "carts", "views"), ("cart_to_purchase_rate", "purchases", "carts"), ("view_to_purchase_rate", "purchases", "views"))


def _purchases(events: DataFrame) -> DataFrame:
    return events.where(is_type("purchase"))


def _average(total: str, count: str) -> Column:
    return ratio(F.col(total), F.col(count), 2)


def daily_revenue(silver: DataFrame) -> DataFrame:
    per = _purchases(silver).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("purchase_count"), money(F.coalesce("price", F.lit(0.0))).alias("purchase_revenue"), F.countDistinct("user_id").alias("unique_buyers")
    )
    return per.withColumn("average_order_value", _average("purchase_revenue", "purchase_count"))


def top_products(silver: DataFrame, k: int = TOP_PRODUCTS) -> DataFrame:
    group = ["event_date", "product_id", "category_id", "category_code", "brand"]
    per = silver.groupBy(*group).agg(*funnel_counts(), revenue().alias("purchase_revenue"), F.countDistinct("user_id").alias("unique_users"))
    order = [F.desc("purchase_revenue"), F.desc("purchases"), F.desc("views"), *[F.col(c).asc_nulls_last() for c in group[1:]]]
    ranked = per.withColumn("product_rank", F.row_number().over(Window.partitionBy("event_date").orderBy(*order))).where(F.col("product_rank") <= k)
    rate = ratio(F.col("purchases"), F.col("views")).alias("view_to_purchase_rate")
    return ranked.select("event_date", "product_rank", *group[1:], "views", "carts", "purchases", "purchase_revenue", "unique_users", rate)


def conversion_funnel_daily(silver: DataFrame) -> DataFrame:
    return silver.groupBy("event_date").agg(*funnel_counts()).withColumns({name: ratio(F.col(a), F.col(b)) for name, a, b in _RATES})


def category_performance_daily(silver: DataFrame) -> DataFrame:
    per = silver.groupBy("event_date", "category_id", "category_code").agg(
        *funnel_counts(), revenue().alias("purchase_revenue"), F.countDistinct(F.when(is_type("purchase"), F.col("user_id"))).alias("unique_buyers")
    )
    return per.withColumn("average_order_value", _average("purchase_revenue", "purchases"))


def _journeys(sessions: DataFrame, keys: list[str], ends: tuple[str, str], more: list[Column]) -> DataFrame:
    """One row per key: when it begins and ends, what happens in it, its path by the stages' first times, and whether it converts."""
    stages = {kind: f"first_{kind}" for kind in EVENT_TYPES}
    measures = [F.min("event_time").alias(ends[0]), F.max("event_time").alias(ends[1]), *more, *funnel_counts(), revenue().alias("purchase_revenue")]
    per = sessions.groupBy(*keys).agg(*measures, *[first_of(kind).alias(name) for kind, name in stages.items()])
    label = path_label({kind: F.col(name) for kind, name in stages.items()})
    return per.select("*", label.alias("path_label"), (F.col("purchases") > 0).alias("converted")).drop(*stages.values())


def session_funnel(sessions: DataFrame) -> DataFrame:
    more = [F.count(F.lit(1)).alias("total_events"), F.countDistinct("product_id").alias("distinct_products")]
    per = _journeys(sessions, ["event_date", "user_id", "session_id"], ("session_start_time", "session_end_time"), more)
    length = F.greatest(whole_seconds(F.col("session_start_time"), F.col("session_end_time")), F.lit(0))
    return per.withColumn("session_duration_seconds", length).select(*MARTS["session_funnel"].schema.names)


def user_conversion_path(sessions: DataFrame) -> DataFrame:
    per = _journeys(sessions, ["event_date", "user_id"], ("first_event_time", "last_event_time"), [F.countDistinct("session_id").alias("session_count")])
    return per.select(*MARTS["user_conversion_path"].schema.names)


def time_to_conversion_distribution(sessions: DataFrame) -> DataFrame:
    per = sessions.where(F.col("event_type").isin("view", "purchase")).groupBy("event_date", "session_id").agg(first_of("view").alias("viewed"), first_of("purchase").alias("bought"))
    seconds = whole_seconds(F.col("viewed"), F.col("bought"))
    bucket = F.lit(f">{TIME_BUCKETS[-1][1]}s")
    for low, high in reversed(TIME_BUCKETS):
        bucket = F.when(seconds <= high, F.lit(f"{low}-{high}s")).otherwise(bucket)
    return per.where("bought >= viewed").groupBy("event_date", bucket.alias("time_bucket")).agg(F.count(F.lit(1)).alias("conversions"))


def cohort_retention(silver: DataFrame) -> DataFrame:
    return cohorts_of(states.buyer_months(silver))


def cohorts_of(months: DataFrame) -> DataFrame:
    """From distinct (month, user), with one shuffle on user: the first month is a window minimum."""
    first = months.withColumn("cohort", F.min("month").over(Window.partitionBy("user_id")))
    offset = F.months_between("month", "cohort").cast("int").alias("period_offset")
    active = first.groupBy("cohort", offset).agg(F.count(F.lit(1)).alias("active_users"))
    size = F.max(F.when(F.col("period_offset") == 0, F.col("active_users"))).over(Window.partitionBy("cohort"))
    return active.withColumn("cohort_users", size).select(
        month_of(F.col("cohort")).alias("cohort_month"), "period_offset", "cohort_users", "active_users", ratio(F.col("active_users"), F.col("cohort_users")).alias("retention_rate")
    )


def repeat_purchase(silver: DataFrame) -> DataFrame:
    return repeats_of(states.buyer_months(silver))


def repeats_of(months: DataFrame) -> DataFrame:
    """A month's buyer is a repeater if an earlier month has a purchase: the first month again, with no join."""
    first = months.withColumn("first", F.min("month").over(Window.partitionBy("user_id")))
    per = first.groupBy("month").agg(F.count(F.lit(1)).alias("purchasers"), F.count_if(F.col("first") < F.col("month")).alias("repeat_purchasers"))
    return per.select(
        month_of(F.col("month")).alias("activity_month"), "purchasers", "repeat_purchasers", ratio(F.col("repeat_purchasers"), F.col("purchasers")).alias("repeat_purchase_rate")
    )


def product_affinity(sessions: DataFrame, top: int = TOP_PAIRS) -> DataFrame:
    return affinity_of(states.basket_rows(sessions), top)  # made distinct there, without the date


def affinity_of(baskets: DataFrame, top: int = TOP_PAIRS) -> DataFrame:
    """The ``top`` pairs of products bought in one session, and lift co * N / (n_a * n_b); N counts all sessions with a purchase."""
    best, sold, total = pairs.top_pairs(baskets.select("session_id", "product_id").distinct(), top)
    of = lambda side: sold.select(F.col("product_id").alias(f"product_{side}"), F.col("n").alias(f"n_{side}"))
    lift = ratio(F.col("co_purchase_sessions") * F.lit(float(total)), F.col("n_a") * F.col("n_b"))
    return best.join(of("a"), "product_a").join(of("b"), "product_b").select("product_a", "product_b", "co_purchase_sessions", lift.alias("affinity_lift"))


def rfm_segmentation(silver: DataFrame, lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    return rfm_of(states.buyer_days(silver), lookback_days, _last_date(_purchases(silver).where("user_id IS NOT NULL")))


def _last_date(rows: DataFrame) -> Column:
    """The last event_date, as a literal: a filter by it reaches the reads of whatever the rows are made of."""
    return F.lit(rows.agg(F.max("event_date").cast("string")).first()[0]).cast("date")


def rfm_of(days: DataFrame, lookback_days: int = LOOKBACK_DAYS, last: Column | None = None) -> DataFrame:
    """Scores 5 (best) to 1 by exact global quintiles of recency, frequency and money of the buyers of the last days, up to ``last`` (that of ``days``)."""
    last = _last_date(days) if last is None else last
    recent = days.where(F.col("event_date") > F.date_sub(last, lookback_days))
    users = recent.groupBy("user_id").agg(
        last.alias("as_of_date"), F.datediff(last, F.max("event_date")).alias("recency_days"), F.sum("purchases").alias("frequency_90d"), to_cents(F.sum("spent")).alias("monetary_90d")
    )
    orders = {"r_score": F.col("recency_days"), "f_score": -F.col("frequency_90d"), "m_score": -F.col("monetary_90d")}
    scored, total = global_positions(users, {name: [c, F.col("user_id")] for name, c in orders.items()})
    scored = scored.withColumns({name: (TILES + 1 - tile_of(F.col(name), F.lit(total), TILES)).cast("int") for name in orders})
    segment = F.lit(OTHER_SEGMENT)
    for name, conditions in reversed(SEGMENTS):
        segment = F.when(F.expr(" AND ".join(conditions)), name).otherwise(segment)
    return scored.select("as_of_date", "user_id", "recency_days", "frequency_90d", "monetary_90d", *orders, segment.alias("rfm_segment"))


#: Each history mart as a function of its state.
OF_STATE = {"cohort_retention": cohorts_of, "repeat_purchase": repeats_of, "product_affinity": affinity_of, "rfm_segmentation": rfm_of}

# Marts of the row-level path.


def user_activity_summary(silver: DataFrame) -> DataFrame:
    """A null product counts as one distinct product."""
    products = F.countDistinct("product_id") + F.max(F.col("product_id").isNull().cast("int"))
    return silver.groupBy("event_date", "user_id").agg(
        F.count(F.lit(1)).alias("total_events"), *funnel_counts(), revenue().alias("purchase_revenue"), products.alias("distinct_products"), F.min("event_time").alias("first_event_time"), F.max("event_time").alias("last_event_time")
    )


def product_popularity(silver: DataFrame) -> DataFrame:
    """Attributes are those of the product's first event of the day."""
    about = F.min_by(F.struct("category_id", "category_code", "brand"), F.struct("event_time", "event_id"))
    per = silver.groupBy("event_date", "product_id").agg(about.alias("about"), *funnel_counts(), revenue().alias("purchase_revenue"), F.countDistinct("user_id").alias("unique_users"))
    return per.select("event_date", "product_id", "about.*", "views", "carts", "purchases", "purchase_revenue", "unique_users", ratio(F.col("purchases"), F.col("views")).alias("view_to_purchase_rate"))


def revenue_by_category(silver: DataFrame) -> DataFrame:
    per = silver.groupBy("event_date", "category_id", "category_code").agg(
        count_of("purchase").alias("purchase_count"), revenue().alias("purchase_revenue"), F.countDistinct(F.when(is_type("purchase"), F.col("user_id"))).alias("unique_buyers")
    )
    return per.withColumn("average_order_value", _average("purchase_revenue", "purchase_count"))


def session_summary(silver: DataFrame) -> DataFrame:
    """By given session alone: rows without one share a group."""
    return silver.groupBy("event_date", "user_id", "user_session").agg(
        F.min("event_time").alias("first_event_time"), F.max("event_time").alias("last_event_time"), F.count(F.lit(1)).alias("total_events"), *funnel_counts(), revenue().alias("purchase_revenue")
    )
