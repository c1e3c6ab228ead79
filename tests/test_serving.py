import pytest
from helpers import SIX, events

from brooklet.operators import marts
from brooklet.plans import serving


@pytest.fixture()
def views(spark):
    e = events(spark, SIX)
    marts.daily_revenue(e).createOrReplaceTempView("daily_revenue")
    marts.category_performance_daily(e).createOrReplaceTempView("category_performance_daily")
    return spark


def test_accepts_and_limits(views):
    c = serving.check_sql(views, "SELECT * FROM daily_revenue")
    assert (c.tables, c.limit) == (("daily_revenue",), 50)
    assert serving.check_sql(views, "select * from daily_revenue limit 9000;").limit == 500
    assert serving.run_sql(views, "WITH x AS (SELECT event_date FROM daily_revenue) SELECT * FROM x").count() == 1
    assert serving.run_sql(views, "SELECT * FROM daily_revenue WHERE event_date IN (SELECT event_date FROM category_performance_daily)").count() == 1


@pytest.mark.parametrize(
    "sql",
    [
        "SELECT 1",
        "SELECT * FROM secrets",
        "SELECT * FROM other.daily_revenue",
        "SELECT * FROM daily_revenue; SELECT * FROM daily_revenue",
        "DROP TABLE daily_revenue",
        "INSERT INTO daily_revenue SELECT * FROM daily_revenue",
        "CREATE VIEW v AS SELECT * FROM daily_revenue",
        "SELECT * FROM daily_revenue WHERE event_date IN (SELECT event_date FROM secrets)",
        "SELECT (SELECT max(x) FROM secrets) FROM daily_revenue",
        "SELECT * FROM csv.`/etc/passwd`",
        "SELECT * FROM range(5), daily_revenue",
        "SELECT reflect('java.lang.System', 'exit', 0) FROM daily_revenue",
        "SELECT try_reflect('java.lang.System', 'getProperty', 'user.dir') x FROM daily_revenue",
        "SELECT java_method('java.lang.System', 'exit', 0) FROM daily_revenue",
        "SELECT system.builtin.reflect('java.lang.System', 'exit', 0) FROM daily_revenue",
        "SELECT input_file_name() FROM daily_revenue",
        "SELECT max(aes_decrypt('a', 'b')) FROM daily_revenue",
        "SELECT * FROM daily_revenue WHERE event_date IN (SELECT try_reflect('a', 'b') FROM daily_revenue)",
        "SELECT * FROM daily_revenue LIMIT 1+600",
        "SHOW TABLES",
        "SET spark.sql.ansi.enabled=false",
        "not sql at all",
    ],
)
def test_rejects(views, sql):
    with pytest.raises(serving.GuardError):
        serving.check_sql(views, sql)


def test_listed_functions_pass(views):
    sql = "SELECT date_trunc('MONTH', event_date) m, round(sum(purchase_revenue), 2) r, count(DISTINCT unique_buyers) n, rank() OVER (ORDER BY max(purchase_count)) k FROM daily_revenue WHERE coalesce(purchase_count, 0) >= 0 GROUP BY 1 LIMIT 5"
    assert serving.run_sql(views, sql).count() == 1


def test_catalog_and_charts(views):
    tables = {t.name: t for t in serving.catalog()}
    assert "purchases" in tables["top_products"].metrics and "purchase_count" not in tables["top_products"].metrics
    assert "daily_revenue" in serving.prompt_context()
    assert serving.suggest_chart(views.sql("SELECT event_date, purchase_revenue FROM daily_revenue"))["type"] == "line"
    assert serving.suggest_chart(views.sql("SELECT category_code, purchase_revenue FROM category_performance_daily"))["type"] == "bar"
    assert serving.suggest_chart(views.sql("SELECT category_code, brand, 1 AS n FROM (SELECT 'a' AS category_code, 'b' AS brand)"))["type"] == "heatmap"
    assert serving.suggest_chart(views.sql("SELECT event_date FROM daily_revenue")) is None
    columns, rows = serving.to_records(serving.run_sql(views, "SELECT event_date FROM daily_revenue"))
    assert columns == ["event_date"] and rows == [{"event_date": "2020-04-01"}]


def test_questions(views):
    asked = serving.plan_question("How is it going?")
    assert asked["action"] == "clarify" and all(w in asked["clarification"] for w in ("category", "cohort", "product", "revenue"))
    assert "cohort_retention" in serving.plan_question("Do customers come back? Show retention")["sql"] and "top_products" in serving.plan_question("What are the best products")["sql"]
    assert "category_code" in serving.plan_question("Best category?")["sql"]
    answer = serving.plan_question("revenue performance")
    assert answer["action"] == "answer" and serving.run_sql(views, answer["sql"]).count() == 1


@pytest.mark.parametrize(
    ("sql", "limit"),
    [("SELECT * FROM daily_revenue LIMIT 400 OFFSET 5", 400), ("SELECT * FROM daily_revenue -- limit 500", 50), ("WITH x AS (SELECT * FROM daily_revenue LIMIT 3) SELECT * FROM x", 50), ("SELECT * FROM daily_revenue ORDER BY 1 LIMIT 7", 7), ("WITH x AS (SELECT * FROM daily_revenue) SELECT * FROM x LIMIT 900", 500)],
)
def test_limits_are_read_from_the_plan(views, sql, limit):
    assert serving.check_sql(views, sql).limit == limit


def test_a_query_stops_after_its_time(spark):
    import time

    spark.range(10**12).selectExpr("id AS event_date").createOrReplaceTempView("daily_revenue")
    began = time.monotonic()
    with pytest.raises(serving.QueryTimeout):
        serving.execute(spark, "SELECT sum(event_date % 7) AS s FROM daily_revenue", seconds=1.5)
    assert time.monotonic() - began < 30
    spark.range(3).selectExpr("id AS event_date").createOrReplaceTempView("daily_revenue")
    assert serving.execute(spark, "SELECT max(event_date) AS m FROM daily_revenue") == (["m"], [{"m": 2}])


def test_reports_leave_views_alone(spark):
    from brooklet.plans import reports

    spark.range(3).createOrReplaceTempView("daily_revenue")
    reports.QUERIES["kpi_total_revenue"](spark, "/root/testdata/sf0.001").collect()
    assert spark.table("daily_revenue").columns == ["id"]
