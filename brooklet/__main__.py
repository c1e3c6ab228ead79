"""Command line: backfill, bronze, silver, gold, stream, replay, create, refresh, recover, maintain, sql, generate, benchmark, sample.

Options that are not given come from the environment, as BROOKLET_<OPTION>: BROOKLET_ROOT for --root.
"""

from __future__ import annotations

import argparse
import csv
import json
import os
from datetime import date

from brooklet.session import build_session


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="brooklet", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)

    b = sub.add_parser("backfill", help="land monthly files")
    b.add_argument("--root", required=True)
    b.add_argument("--input-dir", default="")
    b.add_argument("--input-file", action="append")
    b.add_argument("--start-month", default="")
    b.add_argument("--end-month", default="")
    b.add_argument("--source-month")
    b.add_argument("--resume-from", choices=("full", "silver"), default="full")
    b.add_argument("--reset-tables", action="store_true")
    b.add_argument("--gold-refresh-mode", choices=("none", "affected_dates", "full", "rebuild"), default="affected_dates")
    b.add_argument("--manifests")

    s = sub.add_parser("stream", help="run a stream of messages")
    s.add_argument("--root", required=True)
    s.add_argument("--checkpoint-location", required=True)
    s.add_argument("--input-dir")
    s.add_argument("--bootstrap-servers")
    s.add_argument("--topic")
    s.add_argument("--query-name")
    s.add_argument("--starting-offsets", default="latest")
    s.add_argument("--fail-on-data-loss", action="store_true")
    s.add_argument("--max-offsets-per-trigger", type=int)
    s.add_argument("--max-files-per-trigger", type=int)
    s.add_argument("--trigger-seconds", type=int)
    s.add_argument("--timeout-seconds", type=float)
    s.add_argument("--stop-after-seconds", type=float)
    s.add_argument("--bronze-partitions", type=int, help="files of each month that a batch writes")
    s.add_argument("--silver-partitions", type=int, help="files of each date that a batch writes")
    s.add_argument("--progress-poll-seconds", type=float, default=0.5)
    s.add_argument("--progress-log-path")
    s.add_argument("--gold-refresh-mode", choices=("none", "affected_dates", "full"), default="affected_dates")

    r = sub.add_parser("replay", help="turn a CSV file into message files")
    r.add_argument("--input-csv", required=True)
    r.add_argument("--output-dir", required=True)
    r.add_argument("--batch-size", type=int, default=500)
    r.add_argument("--max-rows", type=int)
    r.add_argument("--runtime-seconds", type=float)
    r.add_argument("--sleep-seconds", type=float, default=0.0)
    r.add_argument("--report-every", type=int, default=0, help="messages between progress lines")
    r.add_argument("--repeat-input", action=argparse.BooleanOptionalAction, default=False)

    for name, about in (("bronze", "land files, no further"), ("silver", "publish the landed rows of some months"), ("gold", "refresh the marts of some dates")):
        layer = sub.add_parser(name, help=about)
        layer.add_argument("--root", required=True)
        if name == "bronze":
            layer.add_argument("--input-file", action="append", required=True)
            layer.add_argument("--source-month")
        elif name == "silver":
            layer.add_argument("--start-month", required=True)
            layer.add_argument("--end-month", required=True)
        else:
            layer.add_argument("--dates", nargs="+", help="yyyy-mm-dd; all where none is given")

    for name, about in (("create", "make empty tables"), ("refresh", "rebuild all marts"), ("recover", "remove what stopped writes left behind")):
        sub.add_parser(name, help=about).add_argument("--root", required=True)

    m = sub.add_parser("maintain", help="report and compact small files")
    m.add_argument("--root", required=True)
    m.add_argument("--tables", nargs="+", required=True)
    m.add_argument("--small-file-bytes", type=int, default=32 << 20)
    m.add_argument("--execute", action="store_true")
    m.add_argument("--keep-versions", type=int, default=5)
    m.add_argument("--older-than-seconds", type=float, default=24 * 3600, help="younger folders may be writes under way")
    m.add_argument("--output-json")

    q = sub.add_parser("sql", help="run a guarded query over the marts")
    q.add_argument("--root", required=True)
    q.add_argument("--timeout-seconds", type=float, default=25.0)
    q.add_argument("query")

    g = sub.add_parser("generate", help="write synthetic events as CSV")
    g.add_argument("--output", required=True)
    g.add_argument("--rows", type=int, default=1000)
    g.add_argument("--seed", type=int, default=42)
    g.add_argument("--days-span", type=int, default=1)

    n = sub.add_parser("benchmark", help="time the layers with their queries, or batch against micro-batches")
    n.add_argument("kind", choices=("system", "processing"))
    n.add_argument("--root", required=True)
    n.add_argument("--output-dir", required=True)
    n.add_argument("--input-file", action="append", help="event files; synthetic events where none is given")
    n.add_argument("--rows", type=int, default=10_000)
    n.add_argument("--rows-per-batch", type=int, default=2_000)
    n.add_argument("--seed", type=int, default=42)

    a = sub.add_parser("sample", help="keep a Bernoulli sample of event files")
    a.add_argument("--input-file", action="append", required=True)
    a.add_argument("--output-dir", required=True)
    a.add_argument("--fraction", type=float, required=True)
    a.add_argument("--seed", type=int, default=42)
    _from_environment(p)
    return p


def _from_environment(p: argparse.ArgumentParser) -> None:
    """Defaults of options from the environment; their types still apply."""
    for action in p._actions:
        if isinstance(action, argparse._SubParsersAction):
            for each in action.choices.values():
                _from_environment(each)
        elif action.option_strings and (held := os.environ.get("BROOKLET_" + action.dest.upper())) is not None:
            if action.nargs == 0 or isinstance(action, argparse.BooleanOptionalAction):
                action.default = held.lower() in ("1", "true", "yes")
            else:
                action.default = held.split(",") if isinstance(action, argparse._AppendAction) or action.nargs == "+" else held
            action.required = False


def main(argv: list[str] | None = None) -> object:
    a = parser().parse_args(argv)
    from pyspark.sql import functions as F

    from brooklet.operators.bronze import project_bronze
    from brooklet.plans import benchmark, operations, serving
    from brooklet.plans.backfill import backfill
    from brooklet.plans.lakehouse import Batch, Lakehouse, build_run_id
    from brooklet.sources import files, generator, sinks
    from brooklet.streaming import replay

    if a.command == "replay":
        with open(a.input_csv, newline="") as source:
            rows = list(csv.DictReader(source)) if a.repeat_input else csv.DictReader(source)
            said = 0

            def report(n: int) -> None:
                nonlocal said
                if a.report_every and n - said >= a.report_every:
                    said = n
                    print(json.dumps({"messages": n}), flush=True)

            messages = replay.replay_messages(rows, a.input_csv.rpartition("/")[2], a.max_rows, a.repeat_input, a.runtime_seconds)
            return replay.drop_messages(messages, a.output_dir, a.batch_size, a.sleep_seconds, report)
    spark = build_session()
    if a.command == "generate":
        return sinks.write_csv(generator.synthetic_events(spark, a.rows, a.seed, days=a.days_span), a.output)
    if a.command == "sample":
        frame, there = operations.cached_sample(files.read_csv(spark, a.input_file), a.output_dir, {"files": sorted(a.input_file)}, a.fraction, a.seed)
        return {"rows": frame.count(), "cached": there, "files": frame.inputFiles()}
    house = Lakehouse(spark, a.root)
    if a.command == "benchmark":
        raw = files.read_csv(spark, a.input_file) if a.input_file else generator.synthetic_events(spark, a.rows, a.seed).withColumn("source_file", F.lit("synthetic"))
        month = files.source_month(F.col("source_file")) if a.input_file else F.lit("2020-04")
        bronze = project_bronze(raw, "benchmark", "batch", F.col("source_file"), month)
        if a.kind == "system":
            result = benchmark.system_benchmark(house, bronze)
        else:
            result = benchmark.processing_benchmark(Lakehouse(spark, f"{house.root}/batch"), Lakehouse(spark, f"{house.root}/stream"), bronze, a.rows_per_batch)
        return {**result, "written": benchmark.write_result(result, a.output_dir, a.kind)}
    if a.command == "bronze":
        done = Batch(build_run_id("bronze"))
        month = F.lit(a.source_month) if a.source_month else files.source_month(F.col("source_file"))
        house.land(project_bronze(files.read_csv(spark, a.input_file), done.run_id, "batch", F.col("source_file"), month), done)
        return vars(done)
    if a.command == "silver":
        done = Batch(build_run_id("silver"))
        house.publish(house.read("bronze_events").where(F.col("source_month").between(a.start_month, a.end_month)), done)
        return vars(done)
    if a.command == "gold":
        return house.refresh([date.fromisoformat(d) for d in a.dates], "affected_dates") if a.dates else house.refresh([], "rebuild")
    if a.command in ("create", "recover"):
        return house.create() if a.command == "create" else list(house.recover())
    if a.command == "backfill":
        done = backfill(
            house, a.input_dir, a.start_month, a.end_month, input_files=a.input_file, source_month=a.source_month, resume_from=a.resume_from, reset_tables=a.reset_tables, gold=a.gold_refresh_mode, manifests=a.manifests
        )
        return {m: vars(b) for m, b in done.items()}
    if a.command == "stream":
        messages = (
            files.stream_kafka(spark, a.bootstrap_servers, a.topic, a.starting_offsets, a.fail_on_data_loss, a.max_offsets_per_trigger)
            if a.bootstrap_servers
            else files.stream_json(spark, a.input_dir, a.max_files_per_trigger)
        )
        house.files = {name: n for name, n in (("bronze_events", a.bronze_partitions), ("silver_events", a.silver_partitions)) if n}
        return vars(
            replay.run_stream(
                messages, house, a.checkpoint_location, gold=a.gold_refresh_mode, trigger_seconds=a.trigger_seconds, timeout_seconds=a.timeout_seconds, stop_after_seconds=a.stop_after_seconds, poll_seconds=a.progress_poll_seconds, query_name=a.query_name, progress_log=a.progress_log_path
            )
        )
    if a.command == "refresh":
        return house.refresh([], "rebuild")
    if a.command == "maintain":
        found = {n: operations.maintain(house.table(n), a.small_file_bytes, a.execute, a.keep_versions, a.older_than_seconds) for n in a.tables}
        if a.output_json:
            with open(a.output_json, "w") as f:
                json.dump(found, f, indent=2)
        return found
    house.register_views()
    return serving.execute(spark, a.query, seconds=a.timeout_seconds)


if __name__ == "__main__":
    print(json.dumps(main(), default=str))
