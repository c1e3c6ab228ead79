import os
from pathlib import Path

import duckdb
import pytest

from brooklet.plans import queries, reports

SF = "/root/testdata/sf0.001"
NAMES = sorted({**queries.ORACLES, **reports.ORACLES})


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        c.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


def rows(records, columns):
    plain = lambda v: None if v is None or v != v else round(float(v), 9) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted(str([plain(r[c]) for c in columns]) for r in records)


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the benchmark tables")
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_oracle(spark, duck, name):
    df = {**queries.QUERIES, **reports.QUERIES}[name](spark, SF)
    columns = sorted(df.columns)
    want = duck.sql({**queries.ORACLES, **reports.ORACLES}[name])
    assert columns == sorted(want.columns)
    records = [dict(zip(want.columns, r, strict=True)) for r in want.fetchall()]
    assert rows([r.asDict() for r in df.collect()], columns) == rows(records, columns)


def test_entry_module_knows_the_engine():
    import __spark_entry__ as entry

    assert set(NAMES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the benchmark tables")
def test_scans_read_what_they_need(spark):
    plan = queries.QUERIES["daily_revenue"](spark, SF)._jdf.queryExecution().toString()
    assert "PushedFilters: [In(event_type" in plan
    schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "props" not in schema and "event_id" not in schema
    # top_products keeps ten rows of a day before they are shuffled for the rank.
    assert "WindowGroupLimit" in queries.QUERIES["top_products"](spark, SF)._jdf.queryExecution().toString()
