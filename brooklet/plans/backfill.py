"""Historical backfill: monthly files through the lakehouse, one run per month, resumable."""

from __future__ import annotations

from pyspark.sql import functions as F

from brooklet.operators.bronze import project_bronze
from brooklet.plans.lakehouse import Batch, Lakehouse, build_run_id
from brooklet.plans.operations import run_stage
from brooklet.sources import files


def backfill(
    house: Lakehouse,
    input_dir: str = "",
    start_month: str = "",
    end_month: str = "",
    *,
    input_files: list[str] | None = None,
    source_month: str | None = None,
    resume_from: str = "full",
    reset_tables: bool = False,
    gold: str = "affected_dates",
    manifests: str | None = None,
) -> dict[str, Batch]:
    """Land the files of an inclusive month range, or the given files, month by month.

    ``resume_from="silver"`` starts from the landed Bronze rows of the range.
    Months without files are skipped; a second run of the same files changes nothing.
    """
    if resume_from not in ("full", "silver"):
        raise ValueError("resume_from is full or silver")
    if reset_tables:
        house.drop()
    spark, run = house.spark, build_run_id("backfill")
    if input_files:
        found = list(input_files)
    elif resume_from == "full":
        found, _ = files.discover_months(spark, input_dir, start_month, end_month)
    else:
        found = []
    by_month: dict[str, list[str]] = {}
    for f in found:
        month = source_month or files.month_of_file(f)
        if month:
            by_month.setdefault(month, []).append(f)
    if resume_from == "silver":
        by_month = {m: [] for m in files.months_between(start_month, end_month)}
    done: dict[str, Batch] = {}
    for month, paths in sorted(by_month.items()):
        if resume_from == "silver":
            rows = house.read("bronze_events").where(F.col("source_month") == month)
        else:
            raw = files.read_csv(spark, paths)
            rows = project_bronze(raw, f"{run}-{month}", "batch", F.col("source_file"), F.lit(source_month) if source_month else files.source_month(F.col("source_file")))

        def work(month: str = month, rows=rows) -> dict:
            done[month] = house.process(rows, f"{run}-{month}", gold)
            return {"bronze_rows": done[month].bronze_rows, "silver_rows": done[month].silver_rows, "rejected_rows": done[month].rejected_rows, "dates": len(done[month].dates)}

        if manifests:
            run_stage(manifests, "batch", f"{run}-{month}", work)
        else:
            work()
    return done
