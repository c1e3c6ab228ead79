import gzip
from datetime import date

import pytest
from helpers import RAW_COLUMNS, SIX, events, raw

from brooklet.operators import quality, silver
from brooklet.functions.expressions import parsed_time
from brooklet.operators.bronze import new_bronze, new_rows, project_bronze, small_enough
from brooklet.plans.lakehouse import Lakehouse, build_run_id
from brooklet.schemas import BRONZE, RAW
from brooklet.sources import files, generator, sinks
from brooklet.sources.tables import Table
from pyspark.sql import functions as F


def bronze_of(spark, rows, file="2020-Apr.csv"):
    df = spark.createDataFrame([tuple(r[c] for c in RAW_COLUMNS) for r in rows], RAW)
    return project_bronze(df, "run", "csv", F.lit(file), files.source_month(F.lit(file)))


def test_months_and_files(spark, tmp_path):
    assert files.months_between("2019-11", "2020-02") == ["2019-11", "2019-12", "2020-01", "2020-02"]
    assert files.month_of_file("2019-Oct.csv") == "2019-10" and files.month_of_file("2020-Feb.csv.gz") == "2020-02"
    assert files.month_of_file("2020-Xyz.csv") is None and files.month_of_file("notes.txt") is None
    line = ",".join(RAW_COLUMNS) + "\n" + ",".join(raw().values()) + "\n"
    (tmp_path / "2020-Jan.csv").write_text(line)
    with gzip.open(tmp_path / "2020-Mar.csv.gz", "wt") as f:
        f.write(line)
    found, missing = files.discover_months(spark, str(tmp_path), "2020-01", "2020-03")
    assert len(found) == 2 and missing == ["2020-02"]
    rows = files.read_csv(spark, found)
    assert {r[0] for r in rows.select(files.source_month(F.col("source_file"))).collect()} == {"2020-01", "2020-03"}
    # Rows of gzip files, which one task reads whole, are dealt again; others stay where they are read.
    dealt = lambda df: "REBALANCE" in df._jdf.queryExecution().executedPlan().toString()
    assert dealt(rows) and not dealt(files.read_csv(spark, found[0]))
    assert {r.source_row_number for r in files.read_numbered_csv(spark, found).collect()} == {2}


def test_numbered_rows(spark, tmp_path):
    body = "".join(",".join(raw(product_id=str(k)).values()) + "\n" for k in range(50))
    (tmp_path / "2020-Jan.csv").write_text(",".join(RAW_COLUMNS) + "\n" + body)
    got = files.read_numbered_csv(spark, str(tmp_path / "2020-Jan.csv")).collect()
    assert all(r.source_row_number == int(r.product_id) + 2 for r in got) and len(got) == 50


def test_names_without_month_are_left_out(spark):
    assert bronze_of(spark, [raw()], "export.csv").count() == 0


@pytest.mark.parametrize(
    ("change", "column", "want"),
    [
        ({"brand": "  "}, "brand", None),
        ({"event_type": " View "}, "event_type", "view"),
        ({"price": "bad"}, "price", None),
        ({"price": "NaN"}, "price", None),
        ({"price": " 12.50 "}, "price", 12.5),
        ({"product_id": "12.5"}, "product_id", None),
        ({"category_code": "Electronics.Audio"}, "category_code", "electronics.audio"),
        ({"event_time": "garbage"}, "event_time", None),
        ({"event_time": "2019-10-01 00:00:00 UTC"}, "event_date", date(2019, 10, 1)),
        ({"event_time": "2019-10-01 01:00:00+02:00"}, "event_date", date(2019, 9, 30)),
    ],
)
def test_normalize(spark, change, column, want):
    assert silver.normalize(bronze_of(spark, [raw(**change)])).first()[column] == want


def test_dedupe_and_identity(spark):
    a, b = bronze_of(spark, [raw(), raw()]), bronze_of(spark, [raw()], "2020-May.csv")
    rows = a.unionByName(b)
    assert rows.select("record_hash").distinct().count() == 2
    assert silver.deduplicate(silver.normalize(rows)).count() == 1
    assert silver.deduplicate(silver.normalize(bronze_of(spark, [raw(event_time="garbage"), raw(event_type="")]))).count() == 0


def test_rejects(spark):
    got = {r.reason: r.missing_columns for r in silver.rejects(bronze_of(spark, [raw(), raw(event_time="garbage"), raw(user_id=None, product_id=" ")])).collect()}
    assert got == {"invalid_timestamp": "", "missing_required_columns": "product_id,user_id"}


def test_new_bronze_is_idempotent(spark):
    a = bronze_of(spark, [raw(), raw(product_id="2")])
    assert new_bronze(a, spark.createDataFrame([], BRONZE)).count() == 2
    assert new_bronze(a, a).count() == 0


def test_quality_rules(spark):
    good = events(spark, SIX)
    results = quality.evaluate(good, quality.silver_rules(), quality.SILVER_COLUMNS)
    assert all(r.passed for r in results) and quality.gate(results)
    bad = events(spark, [("2020-04-01 10:00:00", "unknown", 1, 1.0, 1, "s"), ("2020-04-01 10:00:00", "purchase", 1, None, 1, "s"), ("2020-04-01 10:00:00", "purchase", 1, float("nan"), 1, "s")])
    results = {r.name: r.bad_rows for r in quality.evaluate(bad, quality.silver_rules())}
    assert results["event_type_allowed"] == 1 and results["purchase_price_valid"] == 2
    with pytest.raises(quality.QualityError):
        quality.gate(quality.evaluate(bad, quality.silver_rules()))
    assert not quality.gate(quality.evaluate(bad, quality.silver_rules()), fail=False)
    assert len(quality.bad_samples(bad, quality.silver_rules())["purchase_price_valid"]) == 2
    missing = quality.evaluate(good.drop("user_id"), quality.silver_rules(), quality.SILVER_COLUMNS)
    assert not quality.gate(missing, fail=False)
    assert quality.gate(quality.evaluate(good.where("false"), quality.silver_rules(), quality.SILVER_COLUMNS))


def test_lakehouse_batches(spark, tmp_path):
    house = Lakehouse(spark, str(tmp_path / "house"))
    first = [raw(), raw(event_time="2020-04-01T10:00:30Z", product_id="102", event_type="purchase"), raw(event_time="2020-04-02T09:00:00Z", event_type="purchase", price="5")]
    done = house.process(bronze_of(spark, first), "r1")
    assert (done.bronze_rows, done.silver_rows, len(done.dates)) == (3, 3, 2)
    again = house.process(bronze_of(spark, first), "r2")
    assert (again.bronze_rows, again.silver_rows) == (0, 0)
    assert house.read("daily_revenue").count() == 2
    late = house.process(bronze_of(spark, [raw(event_time="2020-04-01T11:00:00Z", event_type="purchase", price="1"), raw(event_time="nope")]), "r3")
    assert late.dates == [date(2020, 4, 1)] and late.rejected_rows == 1
    got = {str(r.event_date): r.purchase_revenue for r in house.read("daily_revenue").collect()}
    assert got == {"2020-04-01": 11.0, "2020-04-02": 5.0}
    assert spark.read.json(f"{house.root}/_quarantine/run_id=r3").count() == 1
    # A rebuild gives the same tables as the increments did.
    before = {n: sorted(map(str, house.read(n).collect())) for n in ("daily_revenue", "session_funnel", "rfm_segmentation")}
    house.refresh([], "rebuild")
    assert before == {n: sorted(map(str, house.read(n).collect())) for n in before}
    assert house.refresh([], "full") == {} and house.refresh([date(2020, 4, 1)], "none") == {}
    house.drop()
    assert house.read("silver_events").count() == 0


def test_deletion_stays_below_its_root(spark, tmp_path):
    with pytest.raises(ValueError):
        sinks.delete(spark, "/somewhere/else", str(tmp_path))


def test_generator(spark):
    a, b = generator.synthetic_events(spark, 2000, seed=1, days=3), generator.synthetic_events(spark.newSession(), 2000, seed=1, days=3)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    mix = {r.event_type: r["count"] for r in a.groupBy("event_type").count().collect()}
    assert 1500 < mix["view"] < 1700 and mix["purchase"] < 160
    assert silver.normalize(project_bronze(a, "g", "synthetic", F.lit("2020-Apr.csv"), F.lit("2020-04"))).where("event_time IS NULL OR price IS NULL").count() == 0


def test_run_id():
    assert build_run_id("x").startswith("x-")


def test_times_in_every_spelling(spark):
    rows = ["2020-04-01T10:00:00Z", "2020-04-01T12:00:00+02:00", "2020-04-01 10:00:00 UTC", "2020-04-01 10:00:00+00", "2020-04-01 10:00:00+00:00", " 2020-04-01 10:00:00 ", "garbage", "", None, "2020-13-01 10:00:00 UTC", "12:30:00", "10:00"]
    got = spark.createDataFrame([(k, x) for k, x in enumerate(rows)], "k int, t string").select("k", F.unix_timestamp(parsed_time("t")).alias("t")).orderBy("k").collect()
    assert [r.t for r in got] == [1585735200] * 6 + [None] * 6


def test_rejects_are_quarantined_once(spark, tmp_path, monkeypatch):
    """A run that stops between quarantine and Bronze is repeated under another id."""
    house = Lakehouse(spark, str(tmp_path / "house"))
    rows = lambda run: project_bronze(spark.createDataFrame([tuple(r[c] for c in RAW_COLUMNS) for r in (raw(), raw(event_time="bad"), raw(event_type=""))], RAW), run, "csv", F.lit("2020-Apr.csv"), F.lit("2020-04"))
    with monkeypatch.context() as m:
        m.setattr(Table, "add", lambda *a: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError):
            house.process(rows("r1"), "r1")
    done = house.process(rows("r2"), "r2")
    assert done.bronze_rows == 3 and spark.read.json(f"{house.root}/_quarantine", recursiveFileLookup=True).count() == 2


def test_tables_are_created_once(spark, tmp_path):
    house = Lakehouse(spark, str(tmp_path / "house"))
    assert set(house.create()) == set(house.tables()) and house.create() == []
    assert house.read("top_products").count() == 0 and house.create("silver_events") == []


def test_files_prune_the_anti_join(spark):
    rows = spark.createDataFrame([(f"f{k % 3}", "2020-04", f"h{k}") for k in range(9)], "source_file string, source_month string, record_hash string")
    assert sorted(r.record_hash for r in new_bronze(rows, rows.where("source_file <> 'f1'")).collect()) == ["h1", "h4", "h7"]


def test_broadcast_only_below_a_checked_size(spark):
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    keys = spark.range(5)
    assert hinted(small_enough(keys, 5)) and not hinted(small_enough(keys, 4)) and not hinted(small_enough(keys, 0))


def test_the_join_leaves_broadcasts_to_its_size(spark, tmp_path):
    """No hint: a small target is broadcast under the session's threshold, beyond it the join shuffles."""
    rows = spark.range(100).selectExpr("concat('f', id) AS source_file", "'2020-04' AS source_month", "concat('h', id) AS record_hash")
    rows.write.parquet(f"{tmp_path}/t")
    held, before = spark.read.parquet(f"{tmp_path}/t"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for threshold, kind in (("10MB", "BroadcastHashJoin"), ("-1", "SortMergeJoin")):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            assert kind in new_rows(held, held, "record_hash")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
