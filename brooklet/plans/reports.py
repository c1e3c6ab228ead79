"""Stored queries over the marts: dashboard figures, validation checks, reconciliations and benchmark queries.

Each is one SQL text over the marts' names; Spark runs it over views of the
marts, and the oracle over the same marts as common table expressions.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from brooklet.plans.queries import MARTS, S, mart, plain, with_marts
from brooklet.sources.adapters import clickstream

_D = "CAST(event_date AS {text}) AS event_date"
_BUSY = "CAST(sum(CASE WHEN converted THEN 1 ELSE 0 END) AS DOUBLE) / nullif(count(session_id), 0)"

#: name: SQL over the marts; {text} is the engine's text type.
REPORTS = {
    # Dashboard.
    "kpi_total_revenue": "SELECT round(sum(purchase_revenue), 2) AS total_revenue FROM daily_revenue",
    "kpi_total_purchases": "SELECT sum(purchase_count) AS total_purchases FROM daily_revenue",
    "kpi_average_purchase_value": "SELECT round(sum(purchase_revenue) / nullif(sum(purchase_count), 0), 6) AS average_purchase_value FROM daily_revenue",
    "kpi_repeat_rate": "SELECT round(CAST(sum(repeat_purchasers) AS DOUBLE) / nullif(sum(purchasers), 0), 6) AS repeat_rate FROM repeat_purchase",
    "kpi_session_conversion": f"SELECT round({_BUSY}, 6) AS conversion_rate FROM session_funnel",
    "bi_revenue_by_day": f"SELECT {_D}, round(sum(purchase_revenue), 2) AS revenue, sum(purchase_count) AS purchases FROM daily_revenue GROUP BY event_date",
    "bi_funnel_by_day": f"SELECT {_D}, sum(views) AS views, sum(carts) AS carts, sum(purchases) AS purchases FROM conversion_funnel_daily GROUP BY event_date",
    "bi_funnel_rates": f"SELECT {_D}, round(avg(view_to_cart_rate), 6) AS view_to_cart_rate, round(avg(cart_to_purchase_rate), 6) AS cart_to_purchase_rate, round(avg(view_to_purchase_rate), 6) AS view_to_purchase_rate FROM conversion_funnel_daily GROUP BY event_date",
    "bi_session_conversion_by_day": f"SELECT {_D}, round({_BUSY}, 6) AS conversion_rate FROM session_funnel GROUP BY event_date",
    "bi_top_products": "SELECT product_id, round(sum(purchase_revenue), 2) AS revenue FROM top_products GROUP BY product_id ORDER BY revenue DESC, product_id LIMIT 10",
    "bi_revenue_mix": "SELECT category_code, round(sum(purchase_revenue), 2) AS revenue FROM category_performance_daily GROUP BY category_code ORDER BY revenue DESC, category_code LIMIT 25",
    "bi_category_leaders": "SELECT category_code, round(sum(purchase_revenue), 2) AS revenue, sum(purchases) AS purchases FROM category_performance_daily GROUP BY category_code ORDER BY revenue DESC, category_code LIMIT 12",
    "bi_time_to_conversion": "SELECT time_bucket, sum(conversions) AS conversions FROM time_to_conversion_distribution GROUP BY time_bucket",
    "bi_repeat_rate_by_month": "SELECT activity_month, round(avg(repeat_purchase_rate), 6) AS repeat_rate FROM repeat_purchase GROUP BY activity_month",
    "bi_cohort_heatmap": "SELECT cohort_month, period_offset, round(avg(retention_rate), 6) AS retention_rate FROM cohort_retention GROUP BY cohort_month, period_offset",
    "bi_session_paths": "SELECT path_label, count(*) AS sessions FROM session_funnel GROUP BY path_label ORDER BY sessions DESC, path_label LIMIT 10",
    "bi_rfm_mix": "SELECT rfm_segment, count(*) AS users FROM rfm_segmentation GROUP BY rfm_segment",
    "bi_affinity_heatmap": "SELECT product_a, product_b, round(avg(affinity_lift), 6) AS lift FROM product_affinity GROUP BY product_a, product_b",
    "monthly_revenue": "SELECT substr(CAST(event_date AS {text}), 1, 7) AS month, round(sum(purchase_revenue), 2) AS revenue, sum(purchase_count) AS purchases FROM daily_revenue GROUP BY substr(CAST(event_date AS {text}), 1, 7)",
    # Validation of events.
    "silver_row_count": "SELECT count(*) AS silver_rows FROM silver",
    "silver_null_checks": "SELECT count_if(event_time IS NULL) AS null_times, count_if(event_date IS NULL) AS null_dates, count_if(event_type IS NULL) AS null_types, count_if(event_type NOT IN ('view', 'cart', 'purchase')) AS unexpected_types FROM silver",
    "silver_type_mix": "SELECT event_type, count(*) AS n FROM silver GROUP BY event_type",
    "silver_daily_profile": f"SELECT {_D}, {{first}} AS first_event_time, {{last}} AS last_event_time, count(*) AS n FROM silver GROUP BY event_date",
    "silver_window_counts": f"SELECT {_D}, count(*) AS n FROM silver WHERE event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20' GROUP BY event_date",
    "silver_window_checks": "SELECT count(*) AS n, count_if(event_time IS NULL) AS null_times, count_if(price IS NULL) AS null_prices, count(*) - count(DISTINCT event_id) AS repeated_ids FROM silver WHERE event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'",
    # Validation of marts.
    "gold_row_counts": "SELECT " + ", ".join(f"(SELECT count(*) FROM {n}) AS {n}_rows" for n in MARTS),
    "gold_window_counts": "SELECT " + ", ".join(f"(SELECT count(*) FROM {n} WHERE event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20') AS {n}_rows" for n in ("daily_revenue", "conversion_funnel_daily", "session_funnel")),
    "table_row_counts": " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n FROM {n}" for n in MARTS),
    "revenue_reconcile": f"SELECT CAST(g.event_date AS {{text}}) AS event_date, s.n AS silver_purchases, g.purchase_count AS gold_purchases, s.revenue AS silver_revenue, g.purchase_revenue AS gold_revenue FROM (SELECT event_date, count(*) AS n, CAST(round(sum(CAST(round(coalesce(price, 0.0), 4) AS DECIMAL(18,4))), 2) AS DOUBLE) AS revenue FROM silver WHERE event_type = 'purchase' GROUP BY event_date) s JOIN daily_revenue g ON s.event_date = g.event_date",
    "window_revenue_reconcile": f"SELECT CAST(g.event_date AS {{text}}) AS event_date, s.n AS silver_purchases, g.purchase_count AS gold_purchases FROM (SELECT event_date, count(*) AS n FROM silver WHERE event_type = 'purchase' AND event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20' GROUP BY event_date) s JOIN daily_revenue g ON s.event_date = g.event_date",
    "category_reconcile": "SELECT CAST(g.event_date AS {text}) AS event_date, g.category_id, g.category_code, s.revenue AS silver_revenue, g.purchase_revenue AS gold_revenue FROM (SELECT event_date, category_id, category_code, CAST(round(sum(CAST(round(CASE WHEN event_type = 'purchase' THEN coalesce(price, 0.0) ELSE 0.0 END, 4) AS DECIMAL(18,4))), 2) AS DOUBLE) AS revenue FROM silver GROUP BY event_date, category_id, category_code) s JOIN category_performance_daily g ON s.event_date = g.event_date AND s.category_id IS NOT DISTINCT FROM g.category_id AND s.category_code IS NOT DISTINCT FROM g.category_code",
    "rank_counts": f"SELECT {_D}, count(*) AS ranked_products, max(product_rank) AS max_rank FROM top_products GROUP BY event_date",
    "duplicate_ranks": "SELECT count(*) AS duplicate_ranks FROM (SELECT event_date, product_rank FROM top_products GROUP BY event_date, product_rank HAVING count(*) > 1) x",
    "funnel_recomputed": f"SELECT {_D}, views, carts, purchases, round(CASE WHEN views = 0 THEN 0 ELSE CAST(carts AS DOUBLE) / views END, 4) AS recomputed_view_to_cart, view_to_cart_rate, round(CASE WHEN carts = 0 THEN 0 ELSE CAST(purchases AS DOUBLE) / carts END, 4) AS recomputed_cart_to_purchase, cart_to_purchase_rate FROM conversion_funnel_daily",
    "window_funnel": f"SELECT {_D}, views, carts, purchases, view_to_purchase_rate FROM conversion_funnel_daily WHERE event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'",
    "session_sanity": "SELECT count(*) AS sessions, count_if(converted) AS converted_sessions, count_if(session_duration_seconds < 0) AS negative_durations FROM session_funnel",
    "session_path_mix": f"SELECT {_D}, path_label, count(*) AS sessions FROM session_funnel GROUP BY event_date, path_label",
    "user_path_sanity": "SELECT count(*) AS user_days, count_if(converted) AS converted_days, sum(session_count) AS sessions, count_if(last_event_time < first_event_time) AS reversed_times FROM user_conversion_path",
    "user_path_mix": f"SELECT {_D}, path_label, count(*) AS users FROM user_conversion_path GROUP BY event_date, path_label",
    "gold_sanity_cohort": "SELECT count(*) AS n, count_if(period_offset < 0) AS negative_offsets, count_if(retention_rate < 0 OR retention_rate > 1) AS rates_out_of_range FROM cohort_retention",
    "gold_sanity_repeat": "SELECT count(*) AS n, count_if(repeat_purchasers > purchasers) AS too_many_repeaters FROM repeat_purchase",
    "gold_sanity_affinity": "SELECT count(*) AS n, count_if(product_a >= product_b) AS misordered_pairs FROM product_affinity",
    "conversions_per_day": f"SELECT {_D}, sum(conversions) AS conversions FROM time_to_conversion_distribution GROUP BY event_date",
    "window_session_sanity": "SELECT count(*) AS sessions, count_if(converted) AS converted_sessions, count_if(session_duration_seconds < 0) AS negative_durations FROM session_funnel WHERE event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'",
    "window_user_path_mix": f"SELECT {_D}, path_label, count(*) AS users FROM user_conversion_path WHERE event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20' GROUP BY event_date, path_label",
    "window_conversions": f"SELECT {_D}, time_bucket, sum(conversions) AS conversions FROM time_to_conversion_distribution WHERE event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20' GROUP BY event_date, time_bucket",
    "gold_sanity_rfm": "SELECT count(*) AS users, count_if(r_score NOT BETWEEN 1 AND 5 OR f_score NOT BETWEEN 1 AND 5 OR m_score NOT BETWEEN 1 AND 5) AS scores_out_of_range FROM rfm_segmentation",
    # Benchmark queries.
    "bench_daily_revenue_sum": "SELECT round(sum(purchase_revenue), 2) AS revenue FROM daily_revenue",
    "bench_top_products_avg": "SELECT round(avg(purchase_revenue), 2) AS avg_revenue FROM top_products",
    "bench_funnel_totals": "SELECT sum(views) AS views, sum(purchases) AS purchases FROM conversion_funnel_daily",
    "bench_repeat_purchase_avg": "SELECT round(avg(repeat_purchase_rate), 4) AS rate FROM repeat_purchase",
    "bench_rfm_users": "SELECT count(*) AS users FROM rfm_segmentation",
    # Canned questions.
    "question_cohort": "SELECT cohort_month, period_offset, retention_rate FROM cohort_retention ORDER BY cohort_month, period_offset LIMIT 120",
    "question_category": "SELECT category_code, sum(purchase_revenue) AS revenue FROM category_performance_daily GROUP BY category_code ORDER BY revenue DESC, category_code LIMIT 12",
    "question_product": "SELECT product_id, sum(purchase_revenue) AS revenue FROM top_products GROUP BY product_id ORDER BY revenue DESC, product_id LIMIT 10",
    "question_trend": f"SELECT {_D}, sum(purchase_revenue) AS revenue, sum(purchase_count) AS purchases FROM daily_revenue g GROUP BY g.event_date ORDER BY g.event_date LIMIT 90",
}
_SPARK = {"{text}": "STRING", "{first}": "date_format(min(event_time), 'yyyy-MM-dd HH:mm:ss')", "{last}": "date_format(max(event_time), 'yyyy-MM-dd HH:mm:ss')"}
_DUCK = {"{text}": "VARCHAR", "{first}": "strftime(min(event_time), '%Y-%m-%d %H:%M:%S')", "{last}": "strftime(max(event_time), '%Y-%m-%d %H:%M:%S')"}


def _filled(sql: str, words: dict[str, str]) -> str:
    for k, v in words.items():
        sql = sql.replace(k, v)
    return sql


def tables_of(sql: str) -> list[str]:
    return [n for n in MARTS if re.search(rf"\b(?:FROM|JOIN) {n}\b", sql)]


def report(name: str):
    """A report as a query: the marts that it reads are passed as frames, so no view of the session is touched."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        frames = {n: mart(n)(spark, sf_dir) for n in tables_of(REPORTS[name])}
        if re.search(r"\bFROM silver\b", REPORTS[name]):
            frames["silver"] = clickstream(spark, sf_dir)
        sql = _filled(REPORTS[name], _SPARK)
        for n in frames:
            sql = re.sub(rf"\b(FROM|JOIN) {n}\b", rf"\1 {{{n}}}", sql)
        return plain(spark.sql(sql, **frames))

    return query


def oracle(name: str) -> str:
    sql = REPORTS[name]
    return with_marts(*tables_of(sql), extra=S if re.search(r"\bFROM silver\b", sql) else "") + _filled(sql, _DUCK)


QUERIES = {n: report(n) for n in REPORTS}
ORACLES = {n: oracle(n) for n in REPORTS}
