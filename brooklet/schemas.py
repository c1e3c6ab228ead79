"""Declared schemas, and the registry of marts with their grain, partitioning, scope and quality columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T
from pyspark.sql.types import StructType

EVENT_COLUMNS = ("event_time", "event_type", "product_id", "category_id", "category_code", "brand", "price", "user_id", "user_session")
EVENT_TYPES = ("view", "cart", "purchase")
REQUIRED_COLUMNS = ("event_time", "event_type", "product_id", "user_id")
#: Fixed values of the marts: seconds from first view to first purchase, and the segments of scores, the first that fits.
TIME_BUCKETS = ((0, 60), (61, 300), (301, 1800), (1801, 86400))
SEGMENTS = (
    ("champions", ("r_score >= 4", "f_score >= 4", "m_score >= 4")),
    ("new_customers", ("r_score >= 4", "f_score <= 2")),
    ("at_risk", ("r_score <= 2", "f_score >= 3")),
    ("hibernating", ("r_score <= 2", "f_score <= 2")),
    ("loyal_customers", ("f_score >= 4",)),
)
OTHER_SEGMENT = "potential"


_TYPES = {"string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampType()}


def ddl(text: str) -> StructType:
    """A flat schema from "name type, ..", without a session."""
    return StructType([T.StructField(name, _TYPES[kind]) for name, kind in (x.split() for x in text.split(","))])


RAW = ddl(", ".join(f"{c} string" for c in EVENT_COLUMNS))
EVENT = ddl(
    "event_time timestamp, event_type string, product_id bigint, category_id bigint, category_code string, brand string, price double, user_id bigint, user_session string"
)
ENVELOPE = ddl("replayed_at string, source_file string, source_month string").add("payload", RAW)
BRONZE = ddl(
    "batch_run_id string, ingested_at timestamp, source_type string, source_file string, source_month string, record_hash string, " + ", ".join(f"{c} string" for c in EVENT_COLUMNS)
)
SILVER = ddl(
    "event_id string, dedupe_key string, batch_run_id string, ingested_at timestamp, source_file string, source_month string, record_hash string, "
    "event_time timestamp, event_date date, event_type string, product_id bigint, category_id bigint, category_code string, brand string, price double, user_id bigint, user_session string"
)
_FUNNEL = "views bigint, carts bigint, purchases bigint"


@dataclass(frozen=True)
class Mart:
    """A Gold table: its schema, partition column, whether it depends on one date or on history, and quality columns."""

    name: str
    schema: StructType
    keys: tuple[str, ...]
    scope: str
    partition: str | None
    non_negative: tuple[str, ...]
    description: str


def _mart(name: str, schema: str, keys: str, scope: str, non_negative: str, description: str) -> Mart:
    parsed = ddl(schema)
    return Mart(name, parsed, tuple(keys.split()), scope, "event_date" if "event_date" in parsed.names else None, tuple(non_negative.split()), description)


MARTS: dict[str, Mart] = {
    m.name: m
    for m in (
        _mart("daily_revenue", "event_date date, purchase_count bigint, purchase_revenue double, unique_buyers bigint, average_order_value double",
              "event_date", "date", "purchase_count purchase_revenue unique_buyers average_order_value", "Purchases and revenue by day."),
        _mart("top_products", f"event_date date, product_rank int, product_id bigint, category_id bigint, category_code string, brand string, {_FUNNEL}, purchase_revenue double, unique_users bigint, view_to_purchase_rate double",
              "event_date product_rank", "date", "views carts purchases purchase_revenue unique_users", "The ten best-selling products of each day."),
        _mart("conversion_funnel_daily", f"event_date date, {_FUNNEL}, view_to_cart_rate double, cart_to_purchase_rate double, view_to_purchase_rate double",
              "event_date", "date", "views carts purchases", "Views, carts, purchases and their ratios by day."),
        _mart("category_performance_daily", f"event_date date, category_id bigint, category_code string, {_FUNNEL}, purchase_revenue double, unique_buyers bigint, average_order_value double",
              "event_date category_id category_code", "date", "views carts purchases purchase_revenue unique_buyers average_order_value", "Funnel and revenue by day and category."),
        _mart("session_funnel", f"event_date date, user_id bigint, session_id string, session_start_time timestamp, session_end_time timestamp, session_duration_seconds bigint, total_events bigint, distinct_products bigint, {_FUNNEL}, purchase_revenue double, path_label string, converted boolean",
              "event_date user_id session_id", "date", "session_duration_seconds total_events distinct_products views carts purchases purchase_revenue", "One row per day, user and session, with its path."),
        _mart("user_conversion_path", f"event_date date, user_id bigint, session_count bigint, first_event_time timestamp, last_event_time timestamp, {_FUNNEL}, purchase_revenue double, path_label string, converted boolean",
              "event_date user_id", "date", "session_count views carts purchases purchase_revenue", "One row per day and user, with the day's path."),
        _mart("time_to_conversion_distribution", "event_date date, time_bucket string, conversions bigint",
              "event_date time_bucket", "date", "conversions", "Sessions by time from first view to first purchase."),
        _mart("cohort_retention", "cohort_month string, period_offset int, cohort_users bigint, active_users bigint, retention_rate double",
              "cohort_month period_offset", "history", "period_offset cohort_users active_users retention_rate", "Share of a first-purchase cohort that buys again, by month."),
        _mart("repeat_purchase", "activity_month string, purchasers bigint, repeat_purchasers bigint, repeat_purchase_rate double",
              "activity_month", "history", "purchasers repeat_purchasers repeat_purchase_rate", "Share of a month's buyers who bought before it."),
        _mart("product_affinity", "product_a bigint, product_b bigint, co_purchase_sessions bigint, affinity_lift double",
              "product_a product_b", "history", "co_purchase_sessions affinity_lift", "Products bought in one session, with lift."),
        _mart("rfm_segmentation", "as_of_date date, user_id bigint, recency_days int, frequency_90d bigint, monetary_90d double, r_score int, f_score int, m_score int, rfm_segment string",
              "user_id", "history", "recency_days frequency_90d monetary_90d", "Recency, frequency and money scores of recent buyers."),
    )
}
