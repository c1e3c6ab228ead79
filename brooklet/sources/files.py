"""Readers: CSV (plain or gzip), JSON lines, Parquet, text, file streams, and discovery of monthly files."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from brooklet.functions.expressions import unused
from brooklet.schemas import RAW

#: Month names as files spell them (fixed values of the naming convention).
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
_MONTHLY = re.compile(r"(\d{4})-([A-Za-z]{3})\.csv(?:\.gz)?$")


def months_between(start: str, end: str) -> list[str]:
    """The months from start to end (yyyy-MM), both included."""
    (y0, m0), (y1, m1) = (map(int, x.split("-")) for x in (start, end))
    return [f"{k // 12:04d}-{k % 12 + 1:02d}" for k in range(y0 * 12 + m0 - 1, y1 * 12 + m1)]


def month_of_file(name: str) -> str | None:
    """yyyy-MM of a file name such as 2019-Oct.csv.gz, else None."""
    found = _MONTHLY.search(name)
    if not found or found[2].capitalize() not in MONTHS:
        return None
    return f"{found[1]}-{MONTHS.index(found[2].capitalize()) + 1:02d}"


def list_files(spark: SparkSession, folder: str) -> list[str]:
    """All files under a folder of any file system that Spark reads, in order."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
    out = []
    while found.hasNext():
        out.append(found.next().getPath().toString())
    return sorted(out)


def discover_months(spark: SparkSession, folder: str, start: str, end: str) -> tuple[list[str], list[str]]:
    """(files, missing months) of an inclusive month range."""
    wanted = months_between(start, end)
    by_month: dict[str, list[str]] = {}
    for f in list_files(spark, folder):
        month = month_of_file(f)
        if month:
            by_month.setdefault(month, []).append(f)
    return [f for m in wanted for f in by_month.get(m, [])], [m for m in wanted if m not in by_month]


def file_name() -> Column:
    """The name of the file a row was read from."""
    return F.col("_metadata.file_name")


def source_month(file: Column) -> Column:
    """yyyy-MM by the file name, null for other names."""
    numbers = F.create_map(*[x for i, m in enumerate(MONTHS) for x in (F.lit(m), F.lit(f"{i + 1:02d}"))])
    year, month = F.regexp_extract(file, _MONTHLY.pattern, 1), F.initcap(F.regexp_extract(file, _MONTHLY.pattern, 2))
    number = F.try_element_at(numbers, month)
    return F.when((year != "") & number.isNotNull(), F.concat_ws("-", year, number))


def read_csv(spark: SparkSession, paths: str | Iterable[str], schema: StructType = RAW) -> DataFrame:
    """CSV files with header, every column text, with their file's name.

    A .gz file is read whole by one task; its rows are dealt again by size, so what follows isn't bound to it.
    """
    rows = _csv(spark, paths, schema)
    return rows.hint("rebalance") if any(f.endswith(".gz") for f in rows.inputFiles()) else rows


def _csv(spark: SparkSession, paths: str | Iterable[str], schema: StructType) -> DataFrame:
    rows = spark.read.schema(schema).option("header", True).csv(paths if isinstance(paths, str) else list(paths))
    return rows.select("*", file_name().alias("source_file"))


def read_numbered_csv(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """CSV rows with source_row_number, the line of each row in its file: 2 after the header.

    Rows are numbered by block: lines of a file are dealt in order of their byte
    offset, so partition and place in it order them; one pass counts, one numbers.
    """
    rows = _csv(spark, paths, RAW)
    at, block, first, earlier = unused(rows.columns, "at", "block", "first", "earlier")
    rows = rows.withColumn(at, F.monotonically_increasing_id()).withColumn(block, F.shiftright(at, 33))
    blocks = rows.groupBy("source_file", block).agg(F.count(F.lit(1)).alias("n"), F.min(at).alias(first))
    before = Window.partitionBy("source_file").orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("source_file", block, first, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(earlier))
    keyed = rows.join(starts, ["source_file", block])
    return keyed.withColumn("source_row_number", F.col(at) - F.col(first) + F.col(earlier) + 2).drop(at, block, first, earlier)


def read_jsonl(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON lines of a folder and its subfolders; blank lines are skipped."""
    return spark.read.schema(schema).option("recursiveFileLookup", True).json(path)


def read_parquet(spark: SparkSession, path: str, **partitions: Iterable) -> DataFrame:
    """A Parquet table; ``column=values`` prunes partitions."""
    df = spark.read.parquet(path)
    for column, values in partitions.items():
        df = df.where(F.col(column).isin(*values))
    return df


def read_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def stream_json(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """A stream of text lines (value) with arrival times, from files as they appear."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(folder).select("value", F.col("_metadata.file_modification_time").alias("timestamp"))


def stream_kafka(spark: SparkSession, servers: str, topic: str, starting: str = "latest", fail_on_loss: bool = False, max_offsets: int | None = None) -> DataFrame:
    """A stream of text messages (value) with their times, where the Kafka connector is installed."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", starting).option("failOnDataLoss", str(fail_on_loss).lower())
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().selectExpr("CAST(value AS STRING) AS value", "timestamp")
