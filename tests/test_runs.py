import csv
import json

from helpers import RAW_COLUMNS, raw

from brooklet.__main__ import main
from brooklet.operators.bronze import project_bronze
from brooklet.plans import benchmark
from brooklet.plans.backfill import backfill
from brooklet.plans.lakehouse import Lakehouse
from brooklet.sources import files, generator
from pyspark.sql import functions as F


def month_file(folder, name, rows):
    with open(folder / name, "w", newline="") as f:
        w = csv.DictWriter(f, RAW_COLUMNS)
        w.writeheader()
        w.writerows(rows)


def test_backfill_by_month(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    month_file(folder, "2020-Apr.csv", [raw(), raw(event_type="purchase", event_time="2020-04-02T10:00:00Z")])
    month_file(folder, "2020-Jun.csv", [raw(event_type="purchase", event_time="2020-06-02T10:00:00Z")])
    house = Lakehouse(spark, str(tmp_path / "house"))
    done = backfill(house, str(folder), "2020-04", "2020-06", manifests=str(tmp_path / "m"))
    assert {m: b.silver_rows for m, b in done.items()} == {"2020-04": 2, "2020-06": 1}
    assert sorted((r.activity_month, r.repeat_purchasers) for r in house.read("repeat_purchase").collect()) == [("2020-04", 0), ("2020-06", 1)]
    assert sum(b.silver_rows for b in backfill(house, str(folder), "2020-04", "2020-06").values()) == 0
    house.drop("silver_events")
    again = backfill(house, start_month="2020-04", end_month="2020-06", resume_from="silver")
    assert sum(b.silver_rows for b in again.values()) == 3
    assert sum(b.silver_rows for b in backfill(house, input_files=[str(folder / "2020-Apr.csv")], reset_tables=True).values()) == 2


def test_command_line(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    month_file(folder, "2020-Apr.csv", [raw(event_type="purchase", product_id=str(k)) for k in range(5)])
    root = str(tmp_path / "house")
    assert main(["backfill", "--root", root, "--input-dir", str(folder), "--start-month", "2020-04", "--end-month", "2020-04"])["2020-04"]["silver_rows"] == 5
    assert main(["sql", "--root", root, "SELECT purchase_count FROM daily_revenue"])[1] == [{"purchase_count": 5}]
    assert main(["replay", "--input-csv", str(folder / "2020-Apr.csv"), "--output-dir", str(tmp_path / "msg"), "--max-rows", "12", "--repeat-input"]) == 12
    run = main(["stream", "--root", str(tmp_path / "s"), "--checkpoint-location", str(tmp_path / "ck"), "--input-dir", str(tmp_path / "msg")])
    assert run["rows"] == 12 and Lakehouse(spark, str(tmp_path / "s")).read("silver_events").count() == 5
    assert "top_products" in main(["refresh", "--root", root])
    assert main(["maintain", "--root", root, "--tables", "silver_events"])["silver_events"]["before"]["files"] >= 1
    assert main(["maintain", "--root", root, "--tables", "silver_events", "--output-json", str(tmp_path / "report.json")]) == json.loads((tmp_path / "report.json").read_text())
    assert main(["create", "--root", str(tmp_path / "new")]) and main(["recover", "--root", str(tmp_path / "new")]) == []
    main(["generate", "--output", str(tmp_path / "gen"), "--rows", "20"])
    assert files.read_csv(spark, str(tmp_path / "gen")).count() == 20


def test_benchmarks(spark, tmp_path):
    raw_rows = generator.synthetic_events(spark, 300, days=2)
    bronze = project_bronze(raw_rows, "b", "synthetic", F.lit("2020-Apr.csv"), F.lit("2020-04"))
    got = benchmark.system_benchmark(Lakehouse(spark, str(tmp_path / "a")), bronze)
    assert got["rows"] == 300 and len(got["query_latency_seconds"]) == 5 and got["storage_bytes"] > 0
    one, many = Lakehouse(spark, str(tmp_path / "b")), Lakehouse(spark, str(tmp_path / "c"))
    got = benchmark.processing_benchmark(one, many, bronze, 150)
    assert got["microbatches"] == 2 and benchmark.same_marts(one, many)


def test_benchmark_command_writes_json_and_csv(spark, tmp_path):
    for kind in ("system", "processing"):
        out = main(["benchmark", kind, "--root", str(tmp_path / kind), "--output-dir", str(tmp_path / "out"), "--rows", "200", "--rows-per-batch", "100"])
        held = json.loads((tmp_path / "out" / f"{kind}.json").read_text())
        with open(tmp_path / "out" / f"{kind}.csv") as f:
            (row,) = csv.DictReader(f)
        assert set(held) < set(out) and set(row) == {k for k, _ in benchmark.flattened(held)}


def test_sample_command_keeps_its_sample(spark, tmp_path):
    month_file(tmp_path, "2020-Apr.csv", [raw(product_id=str(k)) for k in range(50)])
    args = ["sample", "--input-file", str(tmp_path / "2020-Apr.csv"), "--output-dir", str(tmp_path / "s"), "--fraction", "0.5"]
    one, two = main(args), main(args)
    assert not one["cached"] and two["cached"] and one["rows"] == two["rows"] and 0 < one["rows"] < 50


def test_options_come_from_the_environment(monkeypatch):
    from brooklet.__main__ import parser

    monkeypatch.setenv("BROOKLET_ROOT", "/data/house")
    monkeypatch.setenv("BROOKLET_TRIGGER_SECONDS", "7")
    monkeypatch.setenv("BROOKLET_TABLES", "a,b")
    monkeypatch.setenv("BROOKLET_EXECUTE", "true")
    a = parser().parse_args(["stream", "--checkpoint-location", "/ck"])
    assert a.root == "/data/house" and a.trigger_seconds == 7
    m = parser().parse_args(["maintain", "--root", "/other"])
    assert m.root == "/other" and m.tables == ["a", "b"] and m.execute


def test_replay_is_bounded_by_time(tmp_path):
    from brooklet.streaming import replay

    heard = []
    n = replay.drop_messages(replay.replay_messages([raw()], "f", repeat=True, runtime_seconds=0.3), str(tmp_path), 5, 0.05, heard.append)
    assert 0 < n == heard[-1] and len(heard) < 30


def test_stream_stops_after_its_time_and_writes_few_files(spark, tmp_path):
    month_file(tmp_path, "2020-Apr.csv", [raw(product_id=str(k)) for k in range(40)])
    main(["replay", "--input-csv", str(tmp_path / "2020-Apr.csv"), "--output-dir", str(tmp_path / "msg")])
    run = main(["stream", "--root", str(tmp_path / "s"), "--checkpoint-location", str(tmp_path / "ck"), "--input-dir", str(tmp_path / "msg"), "--trigger-seconds", "1", "--stop-after-seconds", "1", "--silver-partitions", "1", "--bronze-partitions", "2"])
    house = Lakehouse(spark, str(tmp_path / "s"))
    assert run["stop_reason"] == "stop_after" and house.read("silver_events").count() == 40
    assert len(house.read("silver_events").inputFiles()) == 1 and len(house.read("bronze_events").inputFiles()) <= 2


def test_layer_by_layer(spark, tmp_path):
    month_file(tmp_path, "2020-Apr.csv", [raw(event_type="purchase", product_id=str(k)) for k in range(5)])
    root = str(tmp_path / "house")
    assert main(["bronze", "--root", root, "--input-file", str(tmp_path / "2020-Apr.csv")])["bronze_rows"] == 5
    house = Lakehouse(spark, root)
    assert house.tables() == ["bronze_events"]
    assert main(["silver", "--root", root, "--start-month", "2020-04", "--end-month", "2020-04"])["silver_rows"] == 5
    assert main(["gold", "--root", root, "--dates", "2020-04-01"])["daily_revenue"] == "partitions"
    assert house.read("daily_revenue").first().purchase_count == 5 and "rfm_segmentation" in main(["gold", "--root", root])
