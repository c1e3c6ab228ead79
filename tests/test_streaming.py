import json

import pytest
from helpers import RAW_COLUMNS, raw

from brooklet.operators.bronze import project_bronze
from brooklet.plans import operations
from brooklet.plans.lakehouse import Batch, Lakehouse
from brooklet.schemas import RAW
from brooklet.sources.tables import Table
from brooklet.sources.files import stream_json
from brooklet.streaming import replay
from pyspark.sql import functions as F

ROWS = [raw(product_id=str(k), event_type=["view", "purchase"][k % 2], event_time=f"2020-04-0{k % 3 + 1}T10:00:{k % 60:02d}Z") for k in range(30)]


def test_replay_messages():
    got = [json.loads(m) for m in replay.replay_messages(ROWS[:2], "f.csv", max_rows=5, repeat=True)]
    assert len(got) == 5 and got[0]["source_month"] == "2020-04" and got[0]["replayed_at"].endswith("Z") and got[0]["payload"]["product_id"] == "0"
    assert len(list(replay.replay_messages(ROWS[:2], "f.csv", max_rows=5))) == 2


def test_stream_equals_batch(spark, tmp_path):
    folder = tmp_path / "in"
    assert replay.drop_messages(replay.replay_messages(ROWS, "events.csv"), str(folder), rows_per_file=8) == 30
    (folder / "broken.jsonl").write_text("{not json\n")
    streamed = Lakehouse(spark, str(tmp_path / "stream"))
    log = str(tmp_path / "progress.jsonl")
    run = replay.run_stream(stream_json(spark, str(folder), 2), streamed, str(tmp_path / "ck"), query_name="replay", progress_log=log)
    assert (run.rows, run.malformed, run.failed) == (31, 1, 0) and run.processed >= 2
    batch = Lakehouse(spark, str(tmp_path / "batch"))
    df = spark.createDataFrame([tuple(r[c] for c in RAW_COLUMNS) for r in ROWS], RAW)
    batch.process(project_bronze(df, "b", "csv", F.lit("events.csv"), F.lit("2020-04")), "b")
    for name in ("daily_revenue", "conversion_funnel_daily", "session_funnel", "rfm_segmentation"):
        assert sorted(map(str, streamed.read(name).collect())) == sorted(map(str, batch.read(name).collect())), name
    assert spark.read.json(f"{streamed.root}/_quarantine/*").where("reason = 'malformed_message'").count() == 1
    # A restart from the checkpoint finds nothing new; sent again, the events land nowhere twice.
    assert replay.run_stream(stream_json(spark, str(folder), 2), streamed, str(tmp_path / "ck")).rows == 0
    before = streamed.read("silver_events").count()
    replay.run_stream(stream_json(spark, str(folder), 2), streamed, str(tmp_path / "ck2"))
    assert streamed.read("silver_events").count() == before == 30
    assert sum(1 for _ in open(log)) == run.processed


def test_operations(spark, tmp_path):
    folder = str(tmp_path / "manifests")
    assert operations.run_stage(folder, "bronze", "r1", lambda: {"rows": 3}, str(tmp_path / "m.jsonl")) == {"rows": 3}
    try:
        operations.run_stage(folder, "silver", "r1", lambda: 1 / 0)
    except ZeroDivisionError:
        pass
    got = {r.stage: r.status for r in operations.read_manifests(spark, folder).collect()}
    assert got == {"bronze": "succeeded", "silver": "failed"}
    n, metrics = operations.timed_action(spark, "count", lambda: spark.range(10).count())
    assert n == 10 and metrics["tasks"] >= 1 and metrics["status"] == "succeeded"
    made = Table(spark, str(tmp_path / "t"), spark.range(1).schema)
    made.append(spark.range(100).repartition(6))
    assert operations.maintain(made)["before"]["small_files"] == 6 and made.versions() == [1]
    done = operations.maintain(made, execute=True)
    assert done["before"]["small_files"] == 6 and done["after"]["files"] < 6 and made.read().count() == made.read(1).count() == 100
    a, there = operations.cached_sample(spark.range(1000), str(tmp_path / "cache"), {"input": "x"}, 0.1)
    b, again = operations.cached_sample(spark.range(1000), str(tmp_path / "cache"), {"input": "x"}, 0.1)
    assert not there and again and a.count() == b.count() < 200
    dealt = operations.bernoulli_sample(spark.range(1000).repartition(7), 0.1)
    assert sorted(r.id for r in a.collect()) == sorted(r.id for r in dealt.collect()) and 60 < a.count()  # whatever the layout
    slices = operations.number_slices(spark.range(10), "id", 4).groupBy("slice").count().collect()
    assert {r.slice: r["count"] for r in slices} == {0: 4, 1: 4, 2: 2}


def test_two_streams_and_a_stop_after_each_step(spark, tmp_path, monkeypatch):
    """Every row once, no quarantine lost: two streams over one lakehouse, each stopped after Bronze, Silver, Gold and before its record."""
    house = Lakehouse(spark, str(tmp_path / "house"))
    for k in range(2):
        folder = tmp_path / f"in-{k}"
        folder.mkdir()
        lines = list(replay.replay_messages([{**r, "user_id": str(k)} for r in ROWS[:6]], "events.csv"))
        (folder / "a.jsonl").write_text("\n".join([*lines, f"{{broken {k}"]) + "\n")
        stops = [(Lakehouse, "publish"), (Lakehouse, "refresh"), (replay.Ledger, "add")] if k == 0 else [(replay.Ledger, "add")]
        for owner, name in stops:
            with monkeypatch.context() as m:
                m.setattr(owner, name, lambda *a, **b: (_ for _ in ()).throw(OSError("stopped")))
                with pytest.raises(Exception, match="stopped"):
                    replay.run_stream(stream_json(spark, str(folder)), house, str(tmp_path / f"ck-{k}"))
        run = replay.run_stream(stream_json(spark, str(folder)), house, str(tmp_path / f"ck-{k}"))
        assert (run.processed, run.rows, run.malformed) == (1, 7, 1)
    assert house.read("bronze_events").count() == house.read("silver_events").count() == 12
    assert house.read("conversion_funnel_daily").agg(F.sum("views"), F.sum("purchases")).first() == (6, 6)
    broken = spark.read.json(f"{house.root}/_quarantine", recursiveFileLookup=True)
    assert sorted(r.value for r in broken.collect()) == ["{broken 0", "{broken 1"]
    ids = [replay.query_id(spark, str(tmp_path / f"ck-{k}")) for k in range(2)]
    assert len(set(ids)) == 2 and all(replay.Ledger(house, i).holds(0) for i in ids)
    # A batch that the ledger holds is skipped whole, though the stream's own commit is gone.
    monkeypatch.setattr(house, "process", lambda *a, **b: 1 / 0)
    (tmp_path / "ck-0" / "commits" / "0").unlink()
    (tmp_path / "ck-0" / "commits" / ".0.crc").unlink(missing_ok=True)
    run = replay.run_stream(stream_json(spark, str(tmp_path / "in-0")), house, str(tmp_path / "ck-0"))
    assert (run.processed, run.skipped) == (0, 1)


def test_every_batch_has_its_progress(spark, tmp_path, monkeypatch):
    """More micro-batches than a query remembers."""
    folder = tmp_path / "in"
    folder.mkdir()
    for k in range(9):
        (folder / f"{k:03d}.jsonl").write_text("\n".join(replay.replay_messages(ROWS[:1], "f.csv")) + "\n")
    house = Lakehouse(spark, str(tmp_path / "house"))
    monkeypatch.setattr(house, "process", lambda *a, **b: Batch("none"))
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", 3)
    try:
        run = replay.run_stream(stream_json(spark, str(folder), 1), house, str(tmp_path / "ck"), poll_seconds=30)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert run.processed == 9 and [p["batch_id"] for p in run.progress if p["rows"]] == list(range(9))


def test_messages_by_spark(spark, tmp_path):
    df = spark.createDataFrame([tuple(r[c] for c in RAW_COLUMNS) for r in ROWS], RAW).withColumn("turn", F.lit("own"))
    assert replay.replayed(df, "f.csv", max_rows=70, repeat=True).count() == 70 and replay.replayed(df, "f.csv", max_rows=7).count() == 7
    replay.write_messages(replay.replayed(df, "f.csv"), str(tmp_path / "out"), rows_per_file=4)
    files = list((tmp_path / "out").glob("part-*"))
    got = sorted((json.loads(x) for f in files for x in f.read_text().splitlines()), key=lambda m: int(m["payload"]["product_id"]))
    assert [m["payload"] for m in got] == ROWS and max(len(f.read_text().splitlines()) for f in files) <= 4
    want = [json.loads(x) for x in replay.replay_messages(ROWS, "f.csv")]
    plain = lambda m: {k: v for k, v in m.items() if k != "replayed_at"}
    assert list(map(plain, got)) == list(map(plain, want)) and got[0]["replayed_at"].endswith("Z")
