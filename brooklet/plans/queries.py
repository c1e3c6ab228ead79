"""The registry of the engine's queries over the benchmark tables, each with its SQL oracle.

Fixtures: S, clickstream events; P, order lines as purchases; R, raw text rows
with defects. Results have plain columns: dates and times as text.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brooklet.functions.expressions import parsed_time, record_hash
from brooklet.operators import marts, quality, silver
from brooklet.operators.bronze import new_rows, project_bronze
from brooklet.operators.ranking import in_order
from brooklet.operators.sessions import sessionize
from brooklet.plans import lakehouse, operations
from brooklet.schemas import MARTS
from brooklet.sources.adapters import clickstream, order_purchases, raw_events, table
from brooklet.sources.files import source_month, stream_json
from brooklet.sources.sinks import hadoop_path
from brooklet.sources.tables import FILE_BYTES, Table
from brooklet.streaming import replay

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Fixtures in SQL.

S = """silver AS (
  SELECT event_id, ts AS event_time, CAST(ts AS DATE) AS event_date, CASE event_type WHEN 'click' THEN 'cart' ELSE event_type END AS event_type,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id, CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS category_id,
    'cat.' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS VARCHAR) AS category_code,
    CAST(NULL AS VARCHAR) AS brand, value AS price, user_id, CAST(NULL AS VARCHAR) AS user_session
  FROM events WHERE event_type IN ('view', 'click', 'purchase'))"""
P = """bought AS (
  SELECT CAST(o_orderdate AS DATE) AS event_date, l_partkey AS product_id, l_extendedprice * (1 - l_discount) AS price, o_custkey AS user_id, CAST(o_orderkey AS VARCHAR) AS session_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
SESSIONS = """marked AS (
  SELECT *, lag(event_time) OVER w AS before, lag(user_session IS NOT NULL) OVER w AS before_given FROM silver WINDOW w AS (PARTITION BY event_date, user_id ORDER BY event_time, event_id)
), opened AS (
  SELECT *, CASE WHEN user_session IS NOT NULL THEN 0 WHEN before IS NULL OR before_given OR CAST(floor(epoch(event_time)) AS BIGINT) - CAST(floor(epoch(before)) AS BIGINT) > 1800 THEN 1 ELSE 0 END AS opens FROM marked
), numbered AS (
  SELECT *, CAST(sum(opens) OVER (PARTITION BY event_date, user_id ORDER BY event_time, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS k FROM opened
), sessions AS (
  SELECT *, coalesce(user_session, 'derived-' || coalesce(CAST(user_id AS VARCHAR), 'anonymous') || '-' || strftime(event_date, '%Y%m%d') || '-'
    || CASE WHEN k < 10000 THEN lpad(CAST(k AS VARCHAR), 4, '0') ELSE CAST(k AS VARCHAR) END) AS session_id FROM numbered)"""
R = """raw_one AS (
  SELECT '2024-Jan.csv' AS source_file,
    CASE WHEN event_id % 97 = 0 THEN 'garbage' WHEN event_id % 3 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') WHEN event_id % 2 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S UTC') ELSE strftime(ts, '%Y-%m-%d %H:%M:%S+00:00') END AS event_time,
    CASE WHEN event_id % 101 = 0 THEN '' WHEN event_id % 7 = 0 THEN ' ' || upper(substr(kind, 1, 1)) || lower(substr(kind, 2)) || ' ' ELSE kind END AS event_type,
    CASE WHEN event_id % 79 = 0 THEN '12.5' ELSE k END AS product_id, ' ' || CAST(CAST(k AS BIGINT) % 10 AS VARCHAR) AS category_id, 'Cat.' || CAST(CAST(k AS BIGINT) % 10 AS VARCHAR) AS category_code,
    CASE WHEN event_id % 5 = 0 THEN '  ' ELSE 'Acme ' END AS brand,
    CASE WHEN event_id % 89 = 0 THEN 'bad' WHEN event_id % 83 = 0 THEN 'NaN' ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS price,
    CASE WHEN event_id % 73 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS user_id, CASE WHEN event_id % 4 = 0 THEN 's-' || CAST(user_id AS VARCHAR) END AS user_session, event_id
  FROM (SELECT *, json_extract_string(props, '$.k') AS k, CASE event_type WHEN 'click' THEN 'cart' ELSE event_type END AS kind FROM events)
), raw AS (
  SELECT * FROM raw_one UNION ALL SELECT '2024-Feb.csv', event_time, event_type, product_id, category_id, category_code, brand, price, user_id, user_session, event_id FROM raw_one WHERE event_id % 10 = 0
), hashed AS (
  SELECT *, CASE source_file WHEN '2024-Jan.csv' THEN '2024-01' ELSE '2024-02' END AS source_month, sha256(concat_ws('||', source_file, coalesce(event_time, ''), coalesce(event_type, ''), coalesce(product_id, ''), coalesce(category_id, ''), coalesce(category_code, ''),
    coalesce(brand, ''), coalesce(price, ''), coalesce(user_id, ''), coalesce(user_session, ''))) AS record_hash FROM raw
), normal AS (
  SELECT record_hash AS event_id, source_file, source_month, record_hash, nullif(trim(event_time), '') AS raw_event_time,
    coalesce(try_strptime(event_time, '%Y-%m-%dT%H:%M:%SZ'), try_strptime(event_time, '%Y-%m-%d %H:%M:%S UTC'), try_strptime(event_time, '%Y-%m-%d %H:%M:%S+00:00')) AS event_time,
    lower(nullif(trim(event_type), '')) AS event_type, CASE WHEN regexp_matches(trim(product_id), '^[+-]?[0-9]+$') THEN TRY_CAST(trim(product_id) AS BIGINT) END AS product_id, TRY_CAST(trim(category_id) AS BIGINT) AS category_id,
    lower(nullif(trim(category_code), '')) AS category_code, nullif(trim(brand), '') AS brand, CASE WHEN isfinite(TRY_CAST(trim(price) AS DOUBLE)) THEN TRY_CAST(trim(price) AS DOUBLE) END AS price,
    TRY_CAST(trim(user_id) AS BIGINT) AS user_id, nullif(trim(user_session), '') AS user_session FROM hashed)"""
_COUNTS = "count_if(event_type = 'view') AS views, count_if(event_type = 'cart') AS carts, count_if(event_type = 'purchase') AS purchases"


def _money(x: str) -> str:
    return f"CAST(round(sum(CAST(round({x}, 4) AS DECIMAL(18,4))), 2) AS DOUBLE)"


def _ratio(a: str, b: str, scale: int = 4) -> str:
    """Rounded half up on the quotient's own digits."""
    return f"CASE WHEN {b} = 0 THEN 0.0 ELSE CAST(round(CAST(CAST({a} AS DOUBLE) / {b} AS DECIMAL(30,15)), {scale}) AS DOUBLE) END"


_REVENUE = _money("CASE WHEN event_type = 'purchase' THEN coalesce(price, 0.0) ELSE 0.0 END")
_SPENT = _money("coalesce(price, 0.0)")
_DAY = "CAST(event_date AS VARCHAR) AS event_date"
_AT = "strftime({0}, '%Y-%m-%d %H:%M:%S') AS {0}"
_FIRSTS = ", ".join(f"min(CASE WHEN event_type = '{s}' THEN event_time END) AS first_{s}" for s in ("view", "cart", "purchase"))
_PATH = "array_to_string(list_transform(list_sort(list_filter([{'at': first_view, 'stage': 'view'}, {'at': first_cart, 'stage': 'cart'}, {'at': first_purchase, 'stage': 'purchase'}], lambda x: x.at IS NOT NULL)), lambda x: x.stage), '>')"


def plain(df: DataFrame) -> DataFrame:
    """Dates and times as text."""
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)


def register(name: str, query: Query, sql: str | None = None) -> None:
    QUERIES[name] = lambda spark, sf_dir: plain(query(spark, sf_dir))
    if sql:
        ORACLES[name] = sql


# Marts as SQL common table expressions, each under the mart's name.

MART_SQL = {
    "daily_revenue": f"SELECT event_date, count(*) AS purchase_count, {_SPENT} AS purchase_revenue, count(DISTINCT user_id) AS unique_buyers, {_ratio(_SPENT, 'count(*)', 2)} AS average_order_value FROM silver WHERE event_type = 'purchase' GROUP BY event_date",
    "top_products": f"SELECT event_date, CAST(product_rank AS INT) AS product_rank, product_id, category_id, category_code, brand, views, carts, purchases, purchase_revenue, unique_users, {_ratio('purchases', 'views')} AS view_to_purchase_rate FROM (SELECT *, row_number() OVER (PARTITION BY event_date ORDER BY purchase_revenue DESC, purchases DESC, views DESC, product_id NULLS LAST, category_id NULLS LAST, category_code NULLS LAST, brand NULLS LAST) AS product_rank FROM (SELECT event_date, product_id, category_id, category_code, brand, {_COUNTS}, {_REVENUE} AS purchase_revenue, count(DISTINCT user_id) AS unique_users FROM silver GROUP BY ALL)) WHERE product_rank <= 10",
    "conversion_funnel_daily": f"SELECT *, {_ratio('carts', 'views')} AS view_to_cart_rate, {_ratio('purchases', 'carts')} AS cart_to_purchase_rate, {_ratio('purchases', 'views')} AS view_to_purchase_rate FROM (SELECT event_date, {_COUNTS} FROM silver GROUP BY event_date)",
    "category_performance_daily": f"SELECT *, {_ratio('purchase_revenue', 'purchases', 2)} AS average_order_value FROM (SELECT event_date, category_id, category_code, {_COUNTS}, {_REVENUE} AS purchase_revenue, count(DISTINCT CASE WHEN event_type = 'purchase' THEN user_id END) AS unique_buyers FROM silver GROUP BY event_date, category_id, category_code)",
    "session_funnel": f"SELECT event_date, user_id, session_id, session_start_time, session_end_time, greatest(CAST(floor(epoch(session_end_time)) AS BIGINT) - CAST(floor(epoch(session_start_time)) AS BIGINT), 0) AS session_duration_seconds, total_events, distinct_products, views, carts, purchases, purchase_revenue, {_PATH} AS path_label, purchases > 0 AS converted FROM (SELECT event_date, user_id, session_id, min(event_time) AS session_start_time, max(event_time) AS session_end_time, count(*) AS total_events, count(DISTINCT product_id) AS distinct_products, {_COUNTS}, {_REVENUE} AS purchase_revenue, {_FIRSTS} FROM sessions GROUP BY event_date, user_id, session_id)",
    "user_conversion_path": f"SELECT event_date, user_id, session_count, first_event_time, last_event_time, views, carts, purchases, purchase_revenue, {_PATH} AS path_label, purchases > 0 AS converted FROM (SELECT event_date, user_id, count(DISTINCT session_id) AS session_count, min(event_time) AS first_event_time, max(event_time) AS last_event_time, {_COUNTS}, {_REVENUE} AS purchase_revenue, {_FIRSTS} FROM sessions GROUP BY event_date, user_id)",
    "time_to_conversion_distribution": "SELECT event_date, CASE WHEN s <= 60 THEN '0-60s' WHEN s <= 300 THEN '61-300s' WHEN s <= 1800 THEN '301-1800s' WHEN s <= 86400 THEN '1801-86400s' ELSE '>86400s' END AS time_bucket, count(*) AS conversions FROM (SELECT event_date, CAST(floor(epoch(b)) AS BIGINT) - CAST(floor(epoch(v)) AS BIGINT) AS s FROM (SELECT event_date, session_id, min(CASE WHEN event_type = 'view' THEN event_time END) AS v, min(CASE WHEN event_type = 'purchase' THEN event_time END) AS b FROM sessions GROUP BY event_date, session_id) WHERE b >= v) GROUP BY ALL",
    "cohort_retention": f"SELECT strftime(cohort, '%Y-%m') AS cohort_month, CAST(period_offset AS INT) AS period_offset, cohort_users, active_users, {_ratio('active_users', 'cohort_users')} AS retention_rate FROM (SELECT cohort, date_diff('month', cohort, month) AS period_offset, count(DISTINCT user_id) AS active_users FROM (SELECT user_id, date_trunc('month', event_date) AS month, min(date_trunc('month', event_date)) OVER (PARTITION BY user_id) AS cohort FROM bought WHERE user_id IS NOT NULL) GROUP BY ALL) JOIN (SELECT cohort, count(*) AS cohort_users FROM (SELECT user_id, min(date_trunc('month', event_date)) AS cohort FROM bought WHERE user_id IS NOT NULL GROUP BY user_id) GROUP BY cohort) USING (cohort)",
    "repeat_purchase": f"SELECT strftime(month, '%Y-%m') AS activity_month, purchasers, repeat_purchasers, {_ratio('repeat_purchasers', 'purchasers')} AS repeat_purchase_rate FROM (SELECT month, count(DISTINCT b.user_id) AS purchasers, count(DISTINCT CASE WHEN f.first < month THEN b.user_id END) AS repeat_purchasers FROM (SELECT DISTINCT user_id, date_trunc('month', event_date) AS month FROM bought WHERE user_id IS NOT NULL) b JOIN (SELECT user_id, min(event_date) AS first FROM bought GROUP BY user_id) f ON b.user_id = f.user_id GROUP BY month)",
    "product_affinity": f"SELECT x.product_a, x.product_b, x.co AS co_purchase_sessions, {_ratio('x.co * CAST(t.n AS DOUBLE)', '(a.n * b.n)')} AS affinity_lift FROM (SELECT a.product_id AS product_a, b.product_id AS product_b, count(*) AS co FROM baskets a JOIN baskets b ON a.session_id = b.session_id AND a.product_id < b.product_id GROUP BY ALL ORDER BY co DESC, product_a, product_b LIMIT 200) x JOIN (SELECT product_id, count(*) AS n FROM baskets GROUP BY product_id) a ON x.product_a = a.product_id JOIN (SELECT product_id, count(*) AS n FROM baskets GROUP BY product_id) b ON x.product_b = b.product_id, (SELECT count(DISTINCT session_id) AS n FROM baskets) t",
    "rfm_segmentation": f"SELECT as_of_date, user_id, recency_days, frequency_90d, monetary_90d, r_score, f_score, m_score, CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'champions' WHEN r_score >= 4 AND f_score <= 2 THEN 'new_customers' WHEN r_score <= 2 AND f_score >= 3 THEN 'at_risk' WHEN r_score <= 2 AND f_score <= 2 THEN 'hibernating' WHEN f_score >= 4 THEN 'loyal_customers' ELSE 'potential' END AS rfm_segment FROM (SELECT *, CAST(6 - ntile(5) OVER (ORDER BY recency_days, user_id) AS INT) AS r_score, CAST(6 - ntile(5) OVER (ORDER BY frequency_90d DESC, user_id) AS INT) AS f_score, CAST(6 - ntile(5) OVER (ORDER BY monetary_90d DESC, user_id) AS INT) AS m_score FROM (SELECT d.as_of_date, user_id, CAST(date_diff('day', max(event_date), d.as_of_date) AS INT) AS recency_days, count(*) AS frequency_90d, {_SPENT} AS monetary_90d FROM bought, (SELECT max(event_date) AS as_of_date FROM bought WHERE user_id IS NOT NULL) d WHERE user_id IS NOT NULL AND event_date > d.as_of_date - 90 GROUP BY d.as_of_date, user_id))",
}
_HISTORY = {"cohort_retention", "repeat_purchase", "product_affinity", "rfm_segmentation"}
_SESSION_MARTS = {"session_funnel", "user_conversion_path", "time_to_conversion_distribution"}


_BASKETS = "baskets AS (SELECT DISTINCT session_id, product_id FROM bought WHERE product_id IS NOT NULL)"


def with_marts(*names: str, extra: str = "") -> str:
    """WITH clause that holds the fixtures and the named marts."""
    parts = []
    if set(names) - _HISTORY or extra == S:
        parts.append(S)
    if set(names) & _SESSION_MARTS:
        parts.append(SESSIONS)
    if set(names) & _HISTORY:
        parts.append(P)
    if "product_affinity" in names:
        parts.append(_BASKETS)
    return "WITH " + ",\n".join([*parts, *[f"{n} AS ({MART_SQL[n]})" for n in names]]) + "\n"


def mart(name: str) -> Query:
    """A mart over its fixture."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        build = getattr(marts, name)
        if name == "product_affinity":  # which returns no session
            return build(order_purchases(spark, sf_dir, F.col("o_orderkey")))
        if name in _HISTORY:
            return build(order_purchases(spark, sf_dir))
        events = clickstream(spark, sf_dir)
        return build(sessionize(events) if name in _SESSION_MARTS else events)

    return query


def _selected(name: str) -> str:
    columns = []
    for f in MARTS[name].schema:
        if isinstance(f.dataType, T.DateType):
            columns.append(f"CAST({f.name} AS VARCHAR) AS {f.name}")
        elif isinstance(f.dataType, T.TimestampType):
            columns.append(_AT.format(f.name))
        else:
            columns.append(f.name)
    return f"SELECT {', '.join(columns)} FROM {name}"


for _name in MARTS:
    register(_name, mart(_name), with_marts(_name) + _selected(_name))

# Marts of the row-level path.

register("user_activity_summary", lambda s, d: marts.user_activity_summary(clickstream(s, d)), f"WITH {S} SELECT {_DAY}, user_id, count(*) AS total_events, {_COUNTS}, {_REVENUE} AS purchase_revenue, count(DISTINCT product_id) + max(CASE WHEN product_id IS NULL THEN 1 ELSE 0 END) AS distinct_products, strftime(min(event_time), '%Y-%m-%d %H:%M:%S') AS first_event_time, strftime(max(event_time), '%Y-%m-%d %H:%M:%S') AS last_event_time FROM silver GROUP BY event_date, user_id")
register("product_popularity", lambda s, d: marts.product_popularity(clickstream(s, d)), f"WITH {S} SELECT {_DAY}, product_id, category_id, category_code, brand, views, carts, purchases, purchase_revenue, unique_users, {_ratio('purchases', 'views')} AS view_to_purchase_rate FROM (SELECT event_date, product_id, arg_min(category_id, event_time) AS category_id, arg_min(category_code, event_time) AS category_code, CAST(NULL AS VARCHAR) AS brand, {_COUNTS}, {_REVENUE} AS purchase_revenue, count(DISTINCT user_id) AS unique_users FROM silver GROUP BY event_date, product_id)")
register("revenue_by_category", lambda s, d: marts.revenue_by_category(clickstream(s, d)), f"WITH {S} SELECT {_DAY}, category_id, category_code, purchase_count, purchase_revenue, unique_buyers, {_ratio('purchase_revenue', 'purchase_count', 2)} AS average_order_value FROM (SELECT event_date, category_id, category_code, count_if(event_type = 'purchase') AS purchase_count, {_REVENUE} AS purchase_revenue, count(DISTINCT CASE WHEN event_type = 'purchase' THEN user_id END) AS unique_buyers FROM silver GROUP BY ALL)")
register("session_summary", lambda s, d: marts.session_summary(clickstream(s, d)), f"WITH {S} SELECT {_DAY}, user_id, user_session, strftime(min(event_time), '%Y-%m-%d %H:%M:%S') AS first_event_time, strftime(max(event_time), '%Y-%m-%d %H:%M:%S') AS last_event_time, count(*) AS total_events, {_COUNTS}, {_REVENUE} AS purchase_revenue FROM silver GROUP BY event_date, user_id, user_session")
register("sessionize", lambda s, d: sessionize(clickstream(s, d)).select("event_id", "event_date", "user_id", "session_id"), f"WITH {S}, {SESSIONS} SELECT event_id, {_DAY}, user_id, session_id FROM sessions")

# Bronze and Silver.


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_events(spark, sf_dir)
    return project_bronze(raw, "batch-1", "csv", F.col("source_file"), source_month(F.col("source_file")))


def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.normalize(bronze(spark, sf_dir))


_NORMAL = ["record_hash", "event_time", "event_date", "event_type", "product_id", "category_id", "category_code", "brand", "price", "user_id", "user_session"]
_NORMAL_SQL = "record_hash, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time, CAST(CAST(event_time AS DATE) AS VARCHAR) AS event_date, event_type, product_id, category_id, category_code, brand, price, user_id, user_session"
_KEY = "coalesce(strftime(event_time, '%Y-%m-%dT%H:%M:%SZ'), ''), event_type, coalesce(CAST(product_id AS VARCHAR), ''), coalesce(CAST(category_id AS VARCHAR), ''), coalesce(category_code, ''), coalesce(brand, ''), coalesce(CAST(price AS VARCHAR), ''), coalesce(CAST(user_id AS VARCHAR), ''), coalesce(user_session, '')"
_DEDUPED = f"deduped AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {_KEY} ORDER BY event_time, record_hash) AS place FROM normal WHERE event_time IS NOT NULL AND event_type IS NOT NULL) WHERE place = 1)"

register("bronze_project", lambda s, d: bronze(s, d).drop("ingested_at"), f"WITH {R} SELECT 'batch-1' AS batch_run_id, 'csv' AS source_type, source_file, source_month, record_hash, event_time, event_type, product_id, category_id, category_code, brand, price, user_id, user_session FROM hashed")
register("record_hash", lambda s, d: raw_events(s, d).select("event_id", "source_file", record_hash(F.col("source_file")).alias("record_hash")), f"WITH {R} SELECT event_id, source_file, record_hash FROM hashed")
register("parse_timestamps", lambda s, d: raw_events(s, d).select("event_id", "source_file", parsed_time("event_time").alias("event_time")), f"WITH {R} SELECT h.event_id, h.source_file, strftime(n.event_time, '%Y-%m-%d %H:%M:%S') AS event_time FROM hashed h JOIN (SELECT DISTINCT record_hash, event_time FROM normal) n ON h.record_hash = n.record_hash")
register("silver_normalize", lambda s, d: normalized(s, d).select(*_NORMAL), f"WITH {R} SELECT {_NORMAL_SQL} FROM normal")
register("silver_dedupe", lambda s, d: silver.deduplicate(normalized(s, d)).select(*_NORMAL), f"WITH {R}, {_DEDUPED} SELECT {_NORMAL_SQL} FROM deduped")


def silver_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The February file's events that the January file didn't bring, and the reverse: a second batch of all rows."""
    rows = normalized(spark, sf_dir)
    present = silver.deduplicate(rows.where("source_month = '2024-02'"))
    return silver.new_silver(silver.deduplicate(rows), present, silver.affected_dates(rows)).select(*_NORMAL)


def bronze_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bronze(spark, sf_dir)
    return new_rows(rows, rows.where("source_month = '2024-02'"), "record_hash").select("record_hash", "source_file")


_VALID = "event_time IS NOT NULL AND event_type IS NOT NULL"
register("silver_incremental", silver_incremental, f"WITH {R}, {_DEDUPED} SELECT {_NORMAL_SQL} FROM deduped WHERE concat_ws('|', {_KEY}) NOT IN (SELECT concat_ws('|', {_KEY}) FROM normal WHERE source_month = '2024-02' AND {_VALID})")
register("bronze_incremental", bronze_incremental, f"WITH {R} SELECT DISTINCT record_hash, source_file FROM hashed WHERE source_month <> '2024-02'")
register("silver_quarantine", lambda s, d: silver.rejects(bronze(s, d)).select("record_hash", "reason", "missing_columns"), f"WITH {R}, judged AS (SELECT record_hash, concat_ws(',', CASE WHEN nullif(trim(event_time), '') IS NULL THEN 'event_time' END, CASE WHEN nullif(trim(event_type), '') IS NULL THEN 'event_type' END, CASE WHEN nullif(trim(product_id), '') IS NULL THEN 'product_id' END, CASE WHEN nullif(trim(user_id), '') IS NULL THEN 'user_id' END) AS missing_columns, event_time = 'garbage' AS bad_time FROM hashed) SELECT record_hash, CASE WHEN missing_columns <> '' THEN 'missing_required_columns' ELSE 'invalid_timestamp' END AS reason, missing_columns FROM judged WHERE missing_columns <> '' OR bad_time")


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows as stream messages; every 53rd is malformed."""
    raw = raw_events(spark, sf_dir)
    from brooklet.schemas import EVENT_COLUMNS

    message = F.to_json(F.struct(F.lit("2024-02-01T00:00:10Z").alias("replayed_at"), "source_file", source_month(F.col("source_file")).alias("source_month"), F.struct(*EVENT_COLUMNS).alias("payload")), {"ignoreNullFields": "false"})
    return raw.select(F.when(F.col("event_id") % 53 == 0, "{broken").otherwise(message).alias("value"), F.timestamp_seconds(F.unix_timestamp(F.lit("2024-02-01 00:00:15").cast("timestamp")) + F.col("event_id") % 7).alias("timestamp"))


register("parse_envelope", lambda s, d: replay.parse_envelope(envelopes(s, d)).groupBy("parsed", "source_file", "source_month").agg(F.count(F.lit(1)).alias("messages"), F.count("event_type").alias("typed")), f"WITH {R} SELECT event_id % 53 <> 0 AS parsed, CASE WHEN event_id % 53 <> 0 THEN source_file END AS source_file, CASE WHEN event_id % 53 <> 0 THEN source_month END AS source_month, count(*) AS messages, count(CASE WHEN event_id % 53 <> 0 THEN event_type END) AS typed FROM hashed GROUP BY ALL")
register("stream_freshness", lambda s, d: replay.freshness(replay.parse_envelope(envelopes(s, d))).select(F.round("avg_freshness_seconds", 6).alias("avg_freshness_seconds"), "max_freshness_seconds"), f"WITH {R} SELECT round(avg(5 + event_id % 7), 6) AS avg_freshness_seconds, max(5 + event_id % 7) AS max_freshness_seconds FROM hashed WHERE event_id % 53 <> 0")


def replayed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows that came by the stream, by source and month."""
    rows = replay.stream_bronze(replay.parse_envelope(envelopes(spark, sf_dir)), "stream-0")
    return rows.where("source_type = 'stream'").groupBy("source_type", "source_file", "source_month").agg(F.count(F.lit(1)).alias("rows"))


#: The rows that arrive as whole messages.
_R_SENT = R.replace("AS record_hash FROM raw\n", "AS record_hash FROM raw WHERE event_id % 53 <> 0\n")
assert _R_SENT != R
register("replay_rows_by_source_month", replayed_rows, f"WITH {_R_SENT} SELECT 'stream' AS source_type, source_file, source_month, count(*) AS rows FROM hashed GROUP BY source_file, source_month")

# Quality.

register("dq_silver_summary", lambda s, d: quality.silver_summary(normalized(s, d), silver.deduplicate(normalized(s, d))), f"WITH {R}, {_DEDUPED} SELECT * FROM (SELECT count(*) AS rows_seen, count_if(raw_event_time IS NOT NULL AND event_time IS NULL) AS invalid_timestamps, count_if(event_time IS NOT NULL AND event_type IS NOT NULL) AS valid_rows FROM normal), (SELECT count(*) AS rows, 0 AS missing_columns, count_if(event_time IS NULL) AS event_time_not_null, count_if(event_time IS NULL) AS event_date_not_null, count_if(event_type IS NULL) AS event_type_not_null, count_if(event_type NOT IN ('view', 'cart', 'purchase')) AS event_type_allowed, 0 AS event_date_matches_time, count_if(event_type = 'purchase' AND (price IS NULL OR price < 0)) AS purchase_price_valid FROM deduped)")


def gold_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules of all marts, one row each; a mart without a rule has null there."""
    out = None
    for name in MARTS:
        row = quality.summarize(mart(name)(spark, sf_dir), quality.mart_rules(MARTS[name]), MARTS[name].schema.names).select(F.lit(name).alias("mart"), "*")
        out = row if out is None else out.unionByName(row, allowMissingColumns=True)
    return out


def _rules_sql(name: str) -> str:
    dated = "count_if(event_date IS NULL)" if MARTS[name].partition else "CAST(NULL AS BIGINT)"
    negative = " OR ".join(f"coalesce({c} < 0, FALSE)" for c in MARTS[name].non_negative)
    return f"SELECT '{name}' AS mart, count(*) AS rows, 0 AS missing_columns, {dated} AS event_date_not_null, count_if({negative}) AS metrics_not_negative FROM {name}"


def broken_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every rule over events spoiled on purpose: wrong dates, types and prices, nulls, and a column that is missing."""
    key = F.col("event_id")
    spoiled = clickstream(spark, sf_dir).withColumns(
        {
            "event_date": F.when(key % 7 == 0, F.date_add("event_date", 1)).when(key % 17 != 0, F.col("event_date")),
            "event_type": F.when(key % 11 == 0, "bogus").when(key % 19 != 0, F.col("event_type")),
            "price": F.when(key % 13 == 0, F.lit(-1.0)).when(key % 23 != 0, F.col("price")),
            "event_time": F.when(key % 29 != 0, F.col("event_time")),
        }
    )
    return quality.summarize(spoiled.drop("user_id"), quality.silver_rules(), quality.SILVER_COLUMNS)


_SPOILED = """spoiled AS (
  SELECT CASE WHEN event_id % 7 = 0 THEN event_date + 1 WHEN event_id % 17 <> 0 THEN event_date END AS event_date, CASE WHEN event_id % 11 = 0 THEN 'bogus' WHEN event_id % 19 <> 0 THEN event_type END AS event_type,
    CASE WHEN event_id % 13 = 0 THEN -1.0 WHEN event_id % 23 <> 0 THEN price END AS price, CASE WHEN event_id % 29 <> 0 THEN event_time END AS event_time FROM silver)"""
register("dq_broken_silver", broken_silver, f"WITH {S}, {_SPOILED} SELECT count(*) AS rows, 1 AS missing_columns, count_if(event_time IS NULL) AS event_time_not_null, count_if(event_date IS NULL) AS event_date_not_null, count_if(event_type IS NULL) AS event_type_not_null, count_if(event_type NOT IN ('view', 'cart', 'purchase')) AS event_type_allowed, count_if(event_date <> CAST(event_time AS DATE)) AS event_date_matches_time, count_if(event_type = 'purchase' AND (price IS NULL OR price < 0)) AS purchase_price_valid FROM spoiled")


register("dq_gold_summary", gold_quality, with_marts(*MARTS) + " UNION ALL ".join(map(_rules_sql, MARTS)))
register("duplicate_dedupe_keys", lambda s, d: quality.duplicates(silver.keyed(normalized(s, d)), ["dedupe_key"]), f"WITH {R} SELECT count(*) AS duplicate_keys FROM (SELECT 1 FROM normal WHERE {_VALID} GROUP BY {_KEY} HAVING count(*) > 1)")
register("duplicate_keys", lambda s, d: quality.duplicates(table(s, d, "lineitem"), ["l_orderkey", "l_linenumber"]), "SELECT count(*) AS duplicate_keys FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)")
register("first_rows_nulls_first", lambda s, d: in_order(normalized(s, d).select("user_id", "record_hash"), ["user_id", "record_hash"]).limit(20), f"WITH {R} SELECT user_id, record_hash FROM normal ORDER BY user_id ASC NULLS FIRST, record_hash LIMIT 20")
register("order_products_distinct", lambda s, d: order_purchases(s, d).select("session_id", "product_id").distinct(), f"WITH {P} SELECT DISTINCT session_id, product_id FROM bought")

# Streaming and maintenance: no SQL.


def _scratch(spark: SparkSession) -> str:
    """A folder of the session's shared one; a local session may have one of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="brooklet-")
    path = f"{folder}/{uuid.uuid4().hex}"
    where, system = hadoop_path(spark, path)
    system.deleteOnExit(where)
    return path


def stream_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """daily_revenue after all messages have passed the stream in files."""
    root = _scratch(spark)
    envelopes(spark, sf_dir).select("value").repartition(3).write.text(f"{root}/in")
    return replay.marts_of_stream(spark, stream_json(spark, f"{root}/in", files_per_trigger=2), f"{root}/tables", f"{root}/checkpoint")


def _small_files(spark: SparkSession, sf_dir: str) -> Table:
    """Events in twelve files."""
    made = Table(spark, f"{_scratch(spark)}/table", clickstream(spark, sf_dir).schema)
    made.append(clickstream(spark, sf_dir).repartition(12))
    return made


def small_file_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of each event type before and after, and whether files became fewer; what is below a compacted file's size counts as small."""
    made = _small_files(spark, sf_dir)
    done = operations.maintain(made, FILE_BYTES, execute=True)
    count = lambda n, name: made.read(n).groupBy("event_type").agg(F.count(F.lit(1)).alias(name))
    fewer = done.get("after", done["before"])["files"] < done["before"]["files"]
    return count(1, "rows_before").join(count(None, "rows_after"), "event_type").withColumn("fewer_files", F.lit(fewer))


#: Silver and its purchases after a whole run over R.
_LANDED = """, {deduped}, silver AS (SELECT * REPLACE (CAST(event_time AS TIMESTAMP) AS event_time), CAST(event_time AS DATE) AS event_date FROM deduped), {sessions}, bought AS (SELECT * FROM sessions WHERE event_type = 'purchase'), {baskets}, """.format(deduped=_DEDUPED, sessions=SESSIONS, baskets=_BASKETS)
register("stream_marts", stream_marts, f"WITH {_R_SENT}{_LANDED}daily_revenue AS ({MART_SQL['daily_revenue']}) {_selected('daily_revenue')}")
register("file_stats", lambda s, d: operations.file_stats(_small_files(s, d).file_sizes()))
register("file_counts", lambda s, d: operations.file_stats(_small_files(s, d).file_sizes()).select("files", "small_files"), "SELECT 12 AS files, 12 AS small_files")
register("small_file_compaction", small_file_compaction, f"WITH {S} SELECT event_type, count(*) AS rows_before, count(*) AS rows_after, TRUE AS fewer_files FROM silver GROUP BY event_type")
register("bernoulli_sample", lambda s, d: operations.bernoulli_sample(clickstream(s, d), 0.1, key=["event_id"]).select("event_id", "event_type", "user_id"), f"WITH {S} SELECT event_id, event_type, user_id FROM silver WHERE CAST('0x' || left(sha256('42|' || event_id), 8) AS BIGINT) / 4294967296.0 < 0.1")


def refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of all Gold tables after one batch through the lakehouse."""
    house = lakehouse.Lakehouse(spark, _scratch(spark))
    house.process(bronze(spark, sf_dir), "batch-1", fail_on_quality=False)
    out = None
    for name in MARTS:
        row = house.read(name).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("mart"), "rows")
        out = row if out is None else out.unionByName(row)
    return out


def listed_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables that the session catalog shows of a filled lakehouse, with their rows as read by name."""
    root = _scratch(spark)
    house, database = lakehouse.Lakehouse(spark, root), f"brooklet_{uuid.uuid4().hex}"
    house.process(bronze(spark, sf_dir), "batch-1", fail_on_quality=False)
    house.publish_catalog(database, f"{root}/database")
    out = None
    for name in sorted(r.tableName for r in spark.sql(f"SHOW TABLES IN {database}").where("NOT isTemporary").collect()):
        row = spark.table(f"{database}.{name}").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        out = row if out is None else out.unionByName(row)
    return out


_counted = ", ".join(f"{n} AS ({MART_SQL[n]})" for n in MARTS)
register("lakehouse_batch", refreshed, f"WITH {R}{_LANDED}{_counted} " + " UNION ALL ".join(f"SELECT '{n}' AS mart, count(*) AS rows FROM {n}" for n in MARTS))
register("list_tables", listed_tables, f"WITH {R}{_LANDED}{_counted} " + " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS rows FROM {n}" for n in MARTS))
