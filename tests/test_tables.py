import random
import time
from datetime import date

import pytest
from helpers import RAW_COLUMNS, raw

from brooklet.operators import quality
from brooklet.operators.bronze import project_bronze
from brooklet.plans.lakehouse import Lakehouse
from brooklet.schemas import MARTS, RAW, ddl
from brooklet.sources import tables
from brooklet.sources.tables import Conflict, Table
from pyspark.sql import functions as F

SCHEMA = ddl("v int, day string")


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture()
def made(spark, tmp_path):
    frame = lambda *x: spark.createDataFrame(list(x), SCHEMA)
    return Table(spark, f"{tmp_path}/t", SCHEMA, "day"), frame


def test_append_replace_and_old_versions(made):
    t, frame = made
    assert not t.exists() and rows(t.read()) == [] and t.create() and not t.create()
    t.append(frame((1, "a"), (2, "b")))
    t.append(frame((3, "b"), (4, "c")))
    t.replace_partitions(frame((9, "b")), ["a", "b"])
    assert rows(t.read()) == [(4, "c"), (9, "b")]
    assert rows(t.read(3)) == [(1, "a"), (2, "b"), (3, "b"), (4, "c")] and t.versions() == [1, 2, 3, 4]
    t.append(frame())
    assert rows(t.read()) == [(4, "c"), (9, "b")]
    t.replace(frame((7, "z")))
    assert rows(t.read()) == [(7, "z")] and rows(t.read(4)) == [(4, "c"), (9, "b")]
    with pytest.raises(ValueError, match="not among"):
        t.replace_partitions(frame((1, "q")), ["a"])
    with pytest.raises(ValueError, match="no version"):
        t.read(77)
    assert rows(t.read()) == [(7, "z")]


def test_filters_prune_folders(made):
    t, frame = made
    t.append(frame((1, "a"), (2, "b")))
    plan = t.read().where("day = 'b'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_writers_that_meet(made, monkeypatch):
    t, frame = made
    t.append(frame((1, "a")))
    one, two = t.stage(frame((2, "a"))), t.stage(frame((3, "a")))
    t.add(two)
    t.add(one)  # takes the next number
    assert rows(t.read()) == [(1, "a"), (2, "a"), (3, "a")]
    real = t.stage

    def slow(df, files=None):
        out = real(df, files)
        monkeypatch.setattr(t, "stage", real)
        t.append(frame((4, "b")))  # another writer comes while the compaction writes
        return out

    monkeypatch.setattr(t, "stage", slow)
    with pytest.raises(Conflict):
        t.compact()
    assert rows(t.read()) == [(1, "a"), (2, "a"), (3, "a"), (4, "b")]
    # The number is taken in the very last moment.
    now = t.version()
    t._point(tables.Version(now.number + 1, now.generations))
    with pytest.raises(Conflict):
        t._point(tables.Version(now.number + 1, ()))
    assert len(rows(t.read())) == 4


def test_stops_at_every_step_lose_no_row(made, monkeypatch):
    """Each write is stopped before its pointer, and while it writes its folder: readers see what was there; a repeat does it."""
    t, frame = made
    t.append(frame((1, "a"), (2, "b")))
    before = rows(t.read())
    works = {
        "append": lambda: t.append(frame((3, "c"))),
        "compact": t.compact,
        "partitions": lambda: t.replace_partitions(frame((8, "b")), ["b"]),
        "replace": lambda: t.replace(frame((5, "a"))),
        "create": t.create,
    }
    for name, work in works.items():
        before = rows(t.read())
        for step in ("_point", "_parts", "stage"):
            with monkeypatch.context() as m:
                m.setattr(t, step, lambda *a: (_ for _ in ()).throw(OSError("stopped")))
                if name != "create":
                    with pytest.raises(OSError, match="stopped"):
                        work()
            assert rows(t.read()) == before and not t.create(), (name, step)
        work()
    assert rows(t.read()) == [(5, "a")]


def test_expiry_tells_then_removes(made):
    t, frame = made
    for k in range(7):
        t.replace(frame((k, "a")))
    orphan = t.stage(frame((99, "x")))
    assert t.expire(keep=5)["generations"] == []  # all are young
    told = t.expire(keep=5, older_than=-5)
    assert len(told["versions"]) == 2 and len(told["generations"]) == 3 and f"generation={orphan}" in told["generations"]
    assert len(t.versions()) == 7  # only told
    assert t.expire(keep=5, older_than=-5, execute=True) == told
    assert t.versions() == [3, 4, 5, 6, 7] and [rows(t.read(n)) for n in t.versions()] == [[(k, "a")] for k in range(2, 7)]
    assert t.expire(keep=5, older_than=-5) == {"versions": [], "generations": []}
    with pytest.raises(ValueError):
        t.expire(keep=0)


def test_file_sizes_are_listed_by_spark(made, spark):
    t, frame = made
    t.append(frame((1, "a"), (2, "b")))
    t.replace_partitions(frame((3, "b")), ["b"])
    assert t.file_sizes().count() == 2 and t.file_sizes().agg(F.min("bytes")).first()[0] > 0
    assert "content" not in t.file_sizes()._jdf.queryExecution().optimizedPlan().toString().split("\n")[0]
    assert Table(spark, t.path + "-none", SCHEMA).file_sizes().count() == 0


# The lakehouse over such tables.


def bronze_of(spark, events, run="r"):
    df = spark.createDataFrame([tuple(r[c] for c in RAW_COLUMNS) for r in events], RAW)
    return project_bronze(df, run, "csv", F.lit("2020-Apr.csv"), F.lit("2020-04"))


def random_events(rng, n):
    out = []
    for _ in range(n):
        day = date(2020, rng.choice([1, 2, 3, 4]), rng.randrange(1, 4))
        out.append(
            raw(
                event_time=f"{day}T{rng.randrange(24):02d}:{rng.randrange(60):02d}:{rng.randrange(60):02d}Z", event_type=rng.choice(["view", "cart", "purchase", "purchase"]),
                product_id=str(rng.randrange(6)), price=f"{rng.randrange(1, 500) / 100}", user_id=rng.choice([None, "1", "2", "3", "4"]) or "5", user_session=rng.choice([None, "s1", "s2", "s3"]),
            )
        )
    return out


def test_late_batches_equal_a_rebuild(spark, tmp_path):
    """Events arrive in any order; after each batch the marts equal those of a rebuild from all of Silver."""
    rng = random.Random(4)
    pool = random_events(rng, 90)
    rng.shuffle(pool)
    house = Lakehouse(spark, f"{tmp_path}/house")
    for k in range(3):
        house.process(bronze_of(spark, pool[30 * k : 30 * k + 30 + 5]), f"b{k}", fail_on_quality=False)
        whole = Lakehouse(spark, f"{tmp_path}/whole-{k}")
        whole.table("silver_events").replace(house.read("silver_events"))
        whole.refresh([], "rebuild", fail_on_quality=False)
        for name in MARTS:
            assert sorted(map(str, house.read(name).collect())) == sorted(map(str, whole.read(name).collect())), (k, name)
    assert house.read("silver_events").count() >= 80


def test_a_batch_reads_no_events_outside_its_dates(spark, tmp_path, monkeypatch):
    house = Lakehouse(spark, f"{tmp_path}/house")
    house.process(bronze_of(spark, [raw(event_type="purchase", event_time=f"2020-04-0{d}T10:00:00Z", product_id=str(d)) for d in range(1, 6)]), "r1")
    real, read = house.marts, house.read
    history = [n for n, m in MARTS.items() if m.scope == "history"]

    def marts(events, sessions):
        out = real(events, sessions)
        assert not any("silver_events" in f for n in history for f in out[n].inputFiles())
        return out

    monkeypatch.setattr(house, "marts", marts)
    # Silver shows one date alone, and still all marts are right.
    monkeypatch.setattr(house, "read", lambda name, version=None: read(name).where("event_date = '2020-04-02'") if name == "silver_events" else read(name))
    house.refresh([date(2020, 4, 2)])
    assert read("daily_revenue").count() == 5 and read("cohort_retention").first().cohort_users == 1 and read("rfm_segmentation").first().frequency_90d == 5


def test_rules_are_counted_in_the_job_that_writes(spark, tmp_path):
    good = [raw(event_type="purchase"), raw(product_id="7")]
    house = Lakehouse(spark, f"{tmp_path}/house")
    done = house.process(bronze_of(spark, good), "r1")
    assert done.silver_rows == 2 and set(done.metrics) == {"bronze", "silver", "gold"} and done.metrics["silver"]["jobs"]
    bad = [raw(event_type="purchase", price="-3", event_time="2020-04-09T10:00:00Z"), raw(event_time="nope"), good[0], good[0]]
    with pytest.raises(quality.QualityError, match="purchase_price_valid: 1"):
        house.process(bronze_of(spark, bad), "r2")
    assert house.read("silver_events").count() == 2  # nothing of it was published
    orphans = house.table("silver_events").expire(older_than=-5)["generations"]
    assert orphans == []  # the refused rows are gone
    done = house.process(bronze_of(spark, bad, "r3"), "r3", fail_on_quality=False)
    assert done.silver_rows == 1 and done.warnings == {"invalid_timestamps": 1, "repeated_rows": 2}
    # Spark's own counts equal those of a scan.
    df = bronze_of(spark, random_events(random.Random(1), 40))
    rules = [quality.Rule("odd", F.col("product_id").cast("int") % 2 == 1, ("product_id",)), quality.Rule("gone", F.lit(True), ("missing",))]
    watched, found = quality.observed(df, rules, ["event_time", "missing"])
    watched.write.format("noop").mode("overwrite").save()
    assert found(df) == (40, quality.evaluate(df, rules, ["event_time", "missing"]))
    for empty in (df.where("false"), df.where("product_id = 'none'")):
        watched, found = quality.observed(empty, rules)
        began = time.monotonic()
        watched.write.mode("overwrite").parquet(f"{tmp_path}/empty")
        assert found(spark.read.schema(df.schema).parquet(f"{tmp_path}/empty"))[0] == 0 and time.monotonic() - began < 60


def test_keys_are_broadcast_below_a_counted_number(spark, tmp_path):
    for most in (0, 100):
        house = Lakehouse(spark, f"{tmp_path}/{most}", broadcast_rows=most)
        assert house.process(bronze_of(spark, [raw(), raw(product_id="2")]), "r1").silver_rows == 2
        again = house.process(bronze_of(spark, [raw(), raw(product_id="3")]), "r2")
        assert (again.bronze_rows, again.silver_rows) == (1, 1)


def test_recovery_removes_what_a_stopped_run_left(spark, tmp_path, monkeypatch):
    house = Lakehouse(spark, f"{tmp_path}/house")
    house.process(bronze_of(spark, [raw(event_type="purchase")]), "r1")
    before = {n: sorted(map(str, house.read(n).collect())) for n in house.tables()}
    with monkeypatch.context() as m:
        m.setattr(Table, "_point", lambda *a: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError, match="stopped"):
            house.process(bronze_of(spark, [raw(event_type="purchase", event_time="2020-04-03T10:00:00Z")]), "r2")
    assert before == {n: sorted(map(str, house.read(n).collect())) for n in house.tables()}
    assert house.create() == [] and house.recover() == {}  # a day must pass first
    assert list(house.recover(older_than=-5, execute=False)) == ["bronze_events"]
    assert list(house.recover(older_than=-5)) == ["bronze_events"] and house.recover(older_than=-5) == {}
    house.process(bronze_of(spark, [raw(event_type="purchase", event_time="2020-04-03T10:00:00Z")]), "r3")
    assert house.read("daily_revenue").count() == 2


def test_compaction_makes_files_by_size(spark, tmp_path):
    """However many tasks scan the table: on many cores each small file is a task of its own."""
    t = Table(spark, str(tmp_path / "plain"), SCHEMA)
    t.append(spark.range(600).selectExpr("cast(id AS int) AS v", "'a' AS day").repartition(6))
    size = sum(r.bytes for r in t.file_sizes().collect())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    try:
        t.compact()
        assert t.file_sizes().count() == 1 and t.read().count() == t.read(1).count() == 600
        t.append(spark.range(600).selectExpr("cast(id AS int) AS v", "'b' AS day").repartition(6))
        t.compact(size // 2)
        assert 1 < t.file_sizes().count() < 6 and t.read().count() == 1200
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_rows_are_judged_once_for_quarantine(spark, tmp_path, monkeypatch):
    """Counting and writing the rejects read what was found once, not Bronze and its times again."""
    from brooklet.plans import lakehouse

    held, plain = [], lakehouse.sinks.quarantine
    monkeypatch.setattr(lakehouse.sinks, "quarantine", lambda bad, *more: held.append(bad.storageLevel.useDisk) or plain(bad, *more))
    done = Lakehouse(spark, str(tmp_path)).process(bronze_of(spark, [raw(event_time="nope"), raw()]), "r", gold="none", fail_on_quality=False)
    assert (done.bronze_rows, done.rejected_rows, held) == (2, 1, [True])
