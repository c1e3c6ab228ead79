import re

import pytest
from helpers import SIX, events

from brooklet.operators import marts
from brooklet.operators.pairs import session_pairs, top_pairs
from brooklet.operators.ranking import global_positions, tile_of
from brooklet.operators.sessions import sessionize
from brooklet.schemas import MARTS
from pyspark.sql import functions as F


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_golden_six_events(spark):
    e = events(spark, SIX)
    s = sessionize(e)
    r = one(marts.daily_revenue(e))
    assert (r.purchase_count, r.purchase_revenue, r.unique_buyers, r.average_order_value) == (2, 22.0, 1, 11.0)
    r = one(marts.conversion_funnel_daily(e))
    assert (r.views, r.carts, r.purchases, r.view_to_purchase_rate) == (2, 2, 2, 1.0)
    r = one(marts.session_funnel(s))
    assert (r.path_label, r.session_duration_seconds, r.converted) == ("view>cart>purchase", 150, True)
    r = one(marts.time_to_conversion_distribution(s))
    assert (r.time_bucket, r.conversions) == ("61-300s", 1)
    r = one(marts.product_affinity(s))
    assert (r.product_a, r.product_b, r.co_purchase_sessions, r.affinity_lift) == (10, 11, 1, 1.0)
    r = one(marts.cohort_retention(e))
    assert (r.cohort_month, r.period_offset, r.retention_rate) == ("2020-04", 0, 1.0)
    r = one(marts.repeat_purchase(e))
    assert (r.purchasers, r.repeat_purchasers, r.repeat_purchase_rate) == (1, 0, 0.0)
    r = one(marts.rfm_segmentation(e))
    assert (r.recency_days, r.frequency_90d, r.monetary_90d, r.r_score, r.f_score, r.m_score, r.rfm_segment) == (0, 2, 22.0, 5, 5, 5, "champions")


def test_marts_of_nothing_are_empty(spark):
    from brooklet.plans.lakehouse import build_marts

    e = events(spark, SIX).where("false")
    for name, df in build_marts(e, e).items():
        assert df.select(*MARTS[name].schema.names).count() == 0, name


def test_mart_schemas_match_the_registry(spark):
    from brooklet.plans.lakehouse import build_marts

    e = events(spark, SIX)
    for name, df in build_marts(e, e).items():
        got = {f.name: f.dataType for f in df.schema}
        assert got == {f.name: f.dataType for f in MARTS[name].schema}, name


def test_sessions(spark):
    rows = [
        ("2020-04-01 08:00:00", "view", 1, 1.0, 5, None),
        ("2020-04-01 08:30:00", "view", 1, 1.0, 5, None),  # gap of exactly 30 minutes: same session
        ("2020-04-01 09:00:01", "view", 1, 1.0, 5, None),  # more: a new one
        ("2020-04-01 09:01:00", "view", 1, 1.0, 5, "given"),
        ("2020-04-01 09:02:00", "view", 1, 1.0, 5, None),  # a given session lies between
        ("2020-04-01 23:50:00", "view", 1, 1.0, 6, None),
        ("2020-04-02 00:10:00", "view", 1, 1.0, 6, None),  # midnight ends a session
        ("2020-04-01 12:00:00", "view", 1, 1.0, None, None),
    ]
    got = [r.session_id for r in sessionize(events(spark, rows)).orderBy("event_id").collect()]
    assert got == [
        "derived-5-20200401-0001",
        "derived-5-20200401-0001",
        "derived-5-20200401-0002",
        "given",
        "derived-5-20200401-0003",
        "derived-6-20200401-0001",
        "derived-6-20200402-0001",
        "derived-anonymous-20200401-0001",
    ]


def test_anonymous_users_are_numbered_on_from_slice_to_slice(spark):
    """Against the window over a whole day, over ties, gaps at slice borders and given sessions."""
    import random

    rng = random.Random(5)
    rows, t = [], 0
    for _ in range(400):
        t += rng.choice([0, 0, 30, 899, 900, 901, 1799, 1800, 1801, 4000])
        rows.append((f"2020-04-{1 + t // 86400:02d} {t % 86400 // 3600:02d}:{t % 3600 // 60:02d}:{t % 60:02d}", "view", 1, 1.0, None, rng.choice([None] * 6 + ["given"])))
    got = {r.event_id: r.session_id for r in sessionize(events(spark, rows)).collect()}
    known = sessionize(events(spark, [(*r[:4], 7, r[5]) for r in rows])).collect()
    assert got == {r.event_id: r.session_id.replace("derived-7-", "derived-anonymous-") for r in known} and len(set(got.values())) > 20


@pytest.mark.parametrize("block", [2, 5, 100])
def test_large_baskets_meet_by_blocks(spark, block):
    baskets = {"a": range(17), "b": range(5, 11), "c": [3], "d": [1, 9]}
    bought = spark.createDataFrame([(s, p) for s, held in baskets.items() for p in held], "session_id string, product_id long")
    want = sorted((x, y) for held in baskets.values() for x in held for y in held if x < y)
    assert sorted((r.product_a, r.product_b) for r in session_pairs(bought, block).collect()) == want


def random_day(n, seed=5):
    import random

    rng, rows, t = random.Random(seed), [], 0
    for _ in range(n):
        t += rng.choice([0, 0, 30, 899, 900, 901, 1799, 1800, 1801, 4000])
        user = rng.choice([None, None, 7, 8])
        rows.append((f"2020-04-{1 + t // 86400:02d} {t % 86400 // 3600:02d}:{t % 3600 // 60:02d}:{t % 60:02d}", "view", 1, 1.0, user, rng.choice([None] * 6 + ["given"])))
    return rows


@pytest.mark.parametrize("most", [1, 7, 30])
def test_long_days_by_pieces_equal_the_window(spark, most):
    """Null users and bots, ties, given sessions at the borders; names that clash."""
    frame = events(spark, random_day(400)).withColumn("piece", F.lit("own")).withColumn("n", F.lit(1))
    got, want = sessionize(frame, most=most), sessionize(frame)
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_a_bot_is_split_over_tasks(spark):
    """A quarter of an hour of one user: no piece holds more than a part of it."""
    rows = spark.range(40_000).selectExpr(
        "lpad(id, 6, '0') AS event_id", "timestamp_micros(1585735200000000 + id * 22500) AS event_time", "DATE '2020-04-01' AS event_date", "IF(id % 9000 = 0, 'given', NULL) AS user_session", "IF(id < 20000, 5L, NULL) AS user_id"
    )
    plan = sessionize(rows, most=5_000)
    assert sorted(map(str, plan.select("event_id", "session_id").collect())) == sorted(map(str, sessionize(rows).select("event_id", "session_id").collect()))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile_approx" in text and "piece" in text
    assert "percentile_approx" not in sessionize(rows.limit(10))._jdf.queryExecution().optimizedPlan().toString()


def test_top_pairs_make_few_pairs(spark, monkeypatch):
    """Ties at the last place count; products sold too seldom are never paired."""
    import itertools
    import random
    from collections import Counter

    from brooklet.operators import pairs

    rng = random.Random(3)
    baskets = [sorted({*rng.sample(range(10), 3), *(rng.randrange(10, 3000) for _ in range(9))}) for _ in range(600)]
    bought = spark.createDataFrame([(f"s{k}", p) for k, b in enumerate(baskets) for p in b], "session_id string, product_id long")
    counts = Counter(p for b in baskets for p in itertools.combinations(b, 2))
    made = []
    real = pairs.session_pairs
    monkeypatch.setattr(pairs, "session_pairs", lambda *a: made.append(real(*a).count()) or real(*a))
    for top, probed in ((1, 5), (10, 5), (40, 20), (200, 30), (10**6, 5)):
        made.clear()
        best, sold, total = top_pairs(bought, top, probed)
        want = sorted(((a, b, n) for (a, b), n in counts.items()), key=lambda x: (-x[2], x[0], x[1]))[:top]
        assert [tuple(r) for r in best.collect()] == want and total == sum(1 for b in baskets if b)
        assert all(r.n == sum(r.product_id in b for b in baskets) for r in sold.collect())
        if top <= 10:
            assert sum(made) < 0.2 * sum(counts.values()), (top, made)
    tied = spark.createDataFrame([(f"s{k}", p) for k in range(3) for p in range(6)], "session_id string, product_id long")
    assert [tuple(r) for r in top_pairs(tied, 4, 3)[0].collect()] == [(0, 1, 3), (0, 2, 3), (0, 3, 3), (0, 4, 3)]
    best, sold, total = top_pairs(tied.where("false"), 4)
    assert best.collect() == [] and sold.collect() == [] and total == 0


def test_ranges_are_found_by_binary_search(spark):
    df = spark.range(300).select(F.pmod(F.xxhash64("id"), F.lit(7)).alias("v"), "id", F.lit("own").alias("key"))
    placed, total = global_positions(df, {"p": [F.col("v"), F.col("id")]}, rows_per_range=20)
    plan = placed._jdf.queryExecution().optimizedPlan().toString()
    assert "filter(" not in plan.lower().replace("filter (", "") and total == 300 and placed.columns == ["v", "id", "key", "p"]
    want = {r.id: r.p for r in df.selectExpr("id", "row_number() OVER (ORDER BY v, id) AS p").collect()}
    assert {r.id: r.p for r in placed.collect()} == want


def test_path_ties_go_by_name(spark):
    rows = [("2020-04-01 10:00:00", "view", 1, 1.0, 1, "s"), ("2020-04-01 10:00:00", "cart", 1, 1.0, 1, "s")]
    assert one(marts.session_funnel(sessionize(events(spark, rows)))).path_label == "cart>view"


def test_top_products_ranks_and_ties(spark):
    rows = [("2020-04-01 10:00:00", "purchase", p, 5.0, 1, "s") for p in range(12, 0, -1)] + [("2020-04-01 10:00:00", "view", None, 5.0, 1, "s")]
    got = marts.top_products(events(spark, rows)).orderBy("product_rank").collect()
    assert [r.product_id for r in got] == list(range(1, 11)) and [r.product_rank for r in got] == list(range(1, 11))


@pytest.mark.parametrize("n", [1, 4, 7, 23, 100])
def test_positions_and_tiles_match_ntile(spark, n):
    df = spark.range(n).select(F.pmod(F.xxhash64("id"), F.lit(3)).alias("v"), "id")
    placed, total = global_positions(df, {"p": [F.col("v"), F.col("id")], "q": [-F.col("id")]}, rows_per_range=max(1, n // 5))
    assert total == n and all(r.q == n - r.id for r in placed.collect())
    got = placed.withColumn("t", tile_of(F.col("p"), F.lit(n), 5)).orderBy("p").collect()
    want = df.selectExpr("v", "id", "row_number() OVER (ORDER BY v, id) AS p", "ntile(5) OVER (ORDER BY v, id) AS t").orderBy("p").collect()
    assert [(r.id, r.p, r.t) for r in got] == [(r.id, r.p, r.t) for r in want]


def test_row_level_marts(spark):
    rows = [("2020-04-01 10:00:00", "view", None, 1.0, 1, "a"), ("2020-04-01 10:00:01", "purchase", 7, 2.5, 1, "a"), ("2020-04-01 10:00:02", "view", 7, 2.5, 2, "b")]
    e = events(spark, rows)
    got = {r.user_id: r.distinct_products for r in marts.user_activity_summary(e).collect()}
    assert got == {1: 2, 2: 1}
    assert {r.product_id: r.unique_users for r in marts.product_popularity(e).collect()} == {None: 1, 7: 2}
    assert one(marts.revenue_by_category(e)).purchase_revenue == 2.5
    assert marts.session_summary(e).count() == 2


def test_no_python_in_mart_plans(spark):
    from brooklet.plans.lakehouse import build_marts

    e = events(spark, SIX)
    for name, df in build_marts(e, e).items():
        assert "Python" not in df._jdf.queryExecution().executedPlan().toString(), name


def test_rfm_reads_the_last_days_alone(spark, tmp_path):
    """The days' filter reaches the read, below the aggregate of days; the last date is that of purchases with a user."""
    days = ["2020-01-01", "2020-04-01", "2020-05-01"]
    rows = [(f"{d} 10:00:00", "purchase", 1, 2.0, k, None) for k, d in enumerate(days)]
    events(spark, [*rows, ("2020-12-01 10:00:00", "view", 1, 2.0, 1, None), ("2020-12-02 10:00:00", "purchase", 1, 2.0, None, None)]).write.parquet(f"{tmp_path}/silver")
    found = marts.rfm_segmentation(spark.read.parquet(f"{tmp_path}/silver"))
    assert re.search(r"Filter .*event_date#\d+ > 2020-02-01.*\n.*Relation", found._jdf.queryExecution().optimizedPlan().toString())
    assert {(str(r.as_of_date), r.user_id, r.recency_days) for r in found.collect()} == {("2020-05-01", 1, 30), ("2020-05-01", 2, 0)}


def test_kept_rows_have_partitions_by_their_size(spark):
    from pyspark.storagelevel import StorageLevel

    from brooklet.operators.kept import MERGED, kept_rows

    before = spark.conf.get(MERGED)
    kept = kept_rows(spark.range(100).repartition(5).groupBy("id").count(), StorageLevel.DISK_ONLY)
    assert spark.conf.get(MERGED) == before
    try:
        assert kept.count() == 100 and kept.rdd.getNumPartitions() < int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        kept.unpersist()


def test_order_lines_are_grouped_by_order_without_a_shuffle(spark, tmp_path, monkeypatch):
    from brooklet.plans import queries

    spark.createDataFrame([(k, 7, "2020-01-01") for k in range(9)], "o_orderkey long, o_custkey long, o_orderdate string").write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(k, p, 1.0, 0.0) for k in range(9) for p in (1, 2, 2)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_extendedprice double, l_discount double").write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(queries.marts, "product_affinity", lambda sessions: sessions.groupBy("session_id").count())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = queries.mart("product_affinity")(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2  # of the join
    monkeypatch.undo()
    (pair,) = queries.mart("product_affinity")(spark, str(tmp_path)).collect()
    assert (pair.product_a, pair.product_b, pair.co_purchase_sessions, pair.affinity_lift) == (1, 2, 9, 1.0)
