"""Read-only SQL over the marts: catalog, guard, execution with a row cap, chart hint and canned questions.

The guard works on the plan that Spark's own parser makes. It allows one query
statement over allow-listed one-part table names, also in CTEs and subqueries,
and no table functions; the row limit is put on top of the checked query.
"""

from __future__ import annotations

import re
import threading
import uuid
from dataclasses import dataclass
from datetime import date, datetime
from decimal import Decimal

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from brooklet.schemas import MARTS

DEFAULT_LIMIT, HARD_LIMIT, TIMEOUT_SECONDS = 50, 500, 25.0
#: Nodes a query may consist of (names of Spark's logical plan classes).
QUERY_NODES = frozenset(
    "Aggregate CTERelationDef Distinct Except Filter GlobalLimit Intersect Join LocalLimit Offset OneRowRelation Project Sort SubqueryAlias Union UnresolvedHaving UnresolvedInlineTable UnresolvedRelation UnresolvedWith WithWindowDefinition UnresolvedSubqueryColumnAliases".split()
)
#: Functions a query may call: aggregates, windows, numbers, texts, dates, conditions. All others are refused.
FUNCTIONS = frozenset(
    """
    any any_value approx_count_distinct array_agg avg bool_and bool_or count count_if every first first_value last last_value max max_by mean median min min_by mode
    percentile percentile_approx some stddev stddev_pop stddev_samp sum var_pop var_samp variance corr
    cume_dist dense_rank lag lead nth_value ntile percent_rank rank row_number
    abs ceil ceiling exp floor greatest least ln log log10 mod negative pmod pow power round bround sign signum sqrt try_add try_divide try_multiply try_subtract width_bucket
    btrim char_length character_length concat concat_ws contains endswith initcap instr left length like locate lower lpad ltrim replace right rpad rtrim split_part startswith
    substr substring trim upper
    add_months current_date current_timestamp date date_add date_diff date_format date_part date_sub date_trunc datediff day dayofmonth dayofweek dayofyear extract from_unixtime hour
    last_day make_date minute month months_between next_day now quarter second to_date to_timestamp trunc unix_timestamp weekday weekofyear year
    cast coalesce if ifnull isnotnull isnull nullif nullifzero nvl nvl2 zeroifnull bigint boolean decimal double float int string timestamp
    and between case in not or when
    """.split()
)


class GuardError(ValueError):
    """The SQL is not allowed."""


@dataclass(frozen=True)
class Checked:
    sql: str
    tables: tuple[str, ...]
    limit: int


@dataclass(frozen=True)
class SemanticTable:
    name: str
    description: str
    grain: str
    dimensions: tuple[str, ...]
    metrics: tuple[str, ...]


def catalog() -> list[SemanticTable]:
    """The marts for a reader or a prompt, made from the registry so it can't drift from the tables."""
    out = []
    for m in MARTS.values():
        numeric = tuple(f.name for f in m.schema if isinstance(f.dataType, T.NumericType) and f.name not in m.keys)
        out.append(SemanticTable(m.name, m.description, "One row per " + ", ".join(m.keys), tuple(c for c in m.schema.names if c not in numeric), numeric))
    return out


def prompt_context() -> str:
    return "\n".join(f"{t.name}: {t.description} {t.grain}. Dimensions: {', '.join(t.dimensions)}. Metrics: {', '.join(t.metrics)}." for t in catalog())


def _seq(jseq) -> list:
    return [jseq.apply(i) for i in range(jseq.size())]


def _walk(spark: SparkSession, plan, names: list[list[str]], ctes: set[str], nodes: set[str], functions: set[str]) -> None:
    kind = plan.getClass().getSimpleName()
    nodes.add(kind)
    if kind == "UnresolvedRelation":
        names.append([str(x) for x in _seq(plan.multipartIdentifier())])
    if kind == "UnresolvedWith":
        for pair in _seq(plan.cteRelations()):
            ctes.add(str(pair._1()).lower())
            _walk(spark, pair._2(), names, ctes, nodes, functions)
    for expression in _seq(plan.expressions()):
        _walk_expression(spark, expression, names, ctes, nodes, functions)
    for child in _seq(plan.children()):
        _walk(spark, child, names, ctes, nodes, functions)


def _walk_expression(spark: SparkSession, e, names, ctes, nodes, functions) -> None:
    kind = e.getClass().getSimpleName()
    if kind == "UnresolvedFunction":
        functions.add(".".join(str(x) for x in _seq(e.nameParts())).lower())
    if hasattr(e, "plan") and kind in ("ScalarSubquery", "Exists", "ListQuery", "InSubquery", "LateralSubquery"):
        target = e.query() if kind == "InSubquery" else e
        _walk(spark, target.plan(), names, ctes, nodes, functions)
    for child in _seq(e.children()):
        _walk_expression(spark, child, names, ctes, nodes, functions)


def check_sql(spark: SparkSession, sql: str, allowed: set[str] | None = None) -> Checked:
    """The checked query, or GuardError. A limit above the hard one is reduced, a missing one added."""
    allowed = set(MARTS) if allowed is None else allowed
    text = sql.strip().rstrip(";").strip()
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    except (PySparkException, Exception) as error:  # noqa: B014  py4j raises its own
        raise GuardError("Only one SQL statement that parses is allowed.") from error
    names: list[list[str]] = []
    ctes: set[str] = set()
    nodes: set[str] = set()
    functions: set[str] = set()
    _walk(spark, plan, names, ctes, nodes, functions)
    if nodes - QUERY_NODES:
        raise GuardError(f"Only read-only queries are allowed, not {', '.join(sorted(nodes - QUERY_NODES))}.")
    if functions - FUNCTIONS:
        raise GuardError(f"Functions that aren't allowed: {', '.join(sorted(functions - FUNCTIONS))}.")
    used = set()
    for parts in names:
        if len(parts) == 1 and parts[0].lower() in ctes:
            continue
        if len(parts) != 1:
            raise GuardError("Catalogs, schemas and files are out of scope.")
        if parts[0].lower() not in allowed:
            raise GuardError(f"Table {parts[0]} is not allowed.")
        used.add(parts[0].lower())
    if not used:
        raise GuardError("At least one allowed table must be read.")
    asked = _limit(plan)
    return Checked(text, tuple(sorted(used)), DEFAULT_LIMIT if asked is None else min(asked, HARD_LIMIT))


def _limit(plan) -> int | None:
    """The limit on top of a parsed plan, None without one; what isn't a plain number is refused."""
    while plan.getClass().getSimpleName() in ("UnresolvedWith", "SubqueryAlias"):
        plan = plan.child()
    if plan.getClass().getSimpleName() != "GlobalLimit":
        return None
    text = plan.limitExpr().toString()
    if not text.isdigit():
        raise GuardError("A limit is a plain number.")
    return int(text)


class QueryTimeout(TimeoutError):
    """A query ran longer than it may."""


def execute(spark: SparkSession, sql: str, allowed: set[str] | None = None, seconds: float = TIMEOUT_SECONDS, database: str | None = None) -> tuple[list[str], list[dict]]:
    """(columns, rows) of a checked query; its jobs are cancelled after ``seconds``. Names are tables of ``database``, if one is given."""
    context, group, late = spark.sparkContext, f"sql-{uuid.uuid4().hex}", threading.Event()

    def stop() -> None:
        late.set()
        while not done.is_set():  # a query may start another job after the first is cancelled
            context.cancelJobGroup(group)
            done.wait(0.2)

    done, timer = threading.Event(), threading.Timer(seconds, stop)
    timer.daemon = True
    context.setJobGroup(group, "guarded query", True)
    timer.start()
    try:
        found = to_records(run_sql(spark, sql, allowed, database))
    except Exception as error:
        if late.is_set():
            raise QueryTimeout(f"the query took more than {seconds} seconds") from error
        raise
    finally:
        done.set()
        timer.cancel()
        context.setLocalProperty("spark.jobGroup.id", None)
    if late.is_set():
        raise QueryTimeout(f"the query took more than {seconds} seconds")
    return found


def run_sql(spark: SparkSession, sql: str, allowed: set[str] | None = None, database: str | None = None) -> DataFrame:
    """The rows of a checked query, at most its limit.

    With ``database``, names are its tables: the query runs in a session of its own, where views of this one don't hide them.
    """
    checked = check_sql(spark, sql, allowed)
    if database:
        spark = spark.newSession()
        spark.catalog.setCurrentDatabase(database)
    return spark.sql(checked.sql).limit(checked.limit)


def to_records(df: DataFrame) -> tuple[list[str], list[dict]]:
    """(columns, rows); dates as ISO text, decimals as floats."""
    plain = lambda v: v.isoformat() if isinstance(v, (date, datetime)) else float(v) if isinstance(v, Decimal) else v
    return df.columns, [{k: plain(v) for k, v in r.asDict().items()} for r in df.limit(HARD_LIMIT).collect()]


def suggest_chart(df: DataFrame) -> dict | None:
    """A chart for a result, by the kinds of its columns: time first is a line, two texts and a number a heat map, text first bars."""
    fields = [(f.name, f.dataType) for f in df.schema]
    time_like = lambda t: isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType))
    number = lambda t: isinstance(t, T.NumericType)
    text = lambda t: isinstance(t, T.StringType)
    if len(fields) < 2:
        return None
    (x, xt), (y, yt) = fields[:2]
    month = text(xt) and x.endswith("_month")
    if len(fields) == 3 and text(xt) and (text(yt) or x.startswith("cohort")) and number(fields[2][1]):
        return {"type": "heatmap", "x": x, "series": y, "value": fields[2][0]}
    if (time_like(xt) or month) and number(yt):
        return {"type": "line", "x": x, "y": [n for n, t in fields[1:] if number(t)]}
    if (text(xt) or number(xt)) and number(yt):
        return {"type": "bar", "x": x, "y": [y]}
    return None


@dataclass(frozen=True)
class Template:
    """A prepared answer: the words that ask for it (its subject first) beside those of its table, its SQL, and what it shows."""

    table: str
    words: tuple[str, ...]
    sql: str
    shows: str


#: The SQL of the prepared answers.
TEMPLATES = (
    Template("category_performance_daily", ("category", "categories"), "SELECT category_code, SUM(purchase_revenue) AS revenue FROM category_performance_daily GROUP BY category_code ORDER BY revenue DESC LIMIT 12", "Revenue of the strongest categories"),
    Template("cohort_retention", ("cohort", "cohorts", "retention", "retained"), "SELECT cohort_month, period_offset, retention_rate FROM cohort_retention ORDER BY cohort_month, period_offset LIMIT 120", "Share of each cohort that came back, by month"),
    Template("top_products", ("product", "products", "seller", "sellers"), "SELECT product_id, SUM(purchase_revenue) AS revenue FROM top_products GROUP BY product_id ORDER BY revenue DESC LIMIT 10", "Revenue of the strongest products"),
    Template("daily_revenue", ("revenue", "sales", "trend", "purchases", "conversion", "orders"), "SELECT event_date, SUM(purchase_revenue) AS revenue, SUM(purchase_count) AS purchases FROM daily_revenue GROUP BY event_date ORDER BY event_date LIMIT 90", "Revenue and purchases of each day"),
)


def plan_question(question: str) -> dict:
    """Answer with the template that shares most words with a question (ties: the first), or ask back if none shares any.

    A template's words are its own and those of its table's name and metrics in the catalog.
    """
    asked = set(re.findall(r"[a-z]+", question.lower()))
    known = {t.name: t for t in catalog()}

    def score(t: Template) -> tuple[int, int]:
        listed = {w for name in (t.table, *known[t.table].metrics) for w in name.split("_")}
        return len(asked & set(t.words)), len(asked & listed)

    best = max(TEMPLATES, key=score)
    if not any(score(best)):
        subjects = [t.words[0] for t in TEMPLATES]
        return {"action": "clarify", "clarification": f"Please name a subject, such as {', '.join(subjects[:-1])} or {subjects[-1]}."}
    return {"action": "answer", "sql": best.sql, "explanation": best.shows}
