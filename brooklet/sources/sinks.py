"""Writers: Parquet by partition, JSON lines, CSV, text, quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def hadoop_path(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, fs = hadoop_path(spark, path)
    return fs.exists(where)


def delete(spark: SparkSession, path: str, allowed_under: str) -> None:
    """Remove a path, only below the given root."""
    root = allowed_under.rstrip("/") + "/"
    if not path.startswith(root) or ".." in path or path == root:
        raise ValueError(f"{path} is not below {root}")
    where, fs = hadoop_path(spark, path)
    fs.delete(where, True)


def partitioned_writer(df: DataFrame, partition: str | None, files: int | None = None):
    """Rows of one partition value meet in few files: dealt by the value and rebalanced by size, or in ``files`` files at most."""
    if partition is None:
        return df.write
    if files:
        spread = F.pmod(F.xxhash64(*df.columns), F.lit(files))
        return df.repartition(F.col(partition), spread).write.partitionBy(partition)
    return df.hint("rebalance", partition).write.partitionBy(partition)


def replace_table(df: DataFrame, path: str) -> None:
    """Overwrite a folder of Parquet files."""
    df.write.mode("overwrite").parquet(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).json(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_text(spark: SparkSession, lines: list[str], path: str) -> None:
    spark.createDataFrame([(x,) for x in lines], "value string").write.mode("overwrite").text(path)


def quarantine(rejects: DataFrame, root: str, run_id: str) -> None:
    """Rejected rows go beside the tables, a folder for each run and source month.

    Rows whose hash lies in quarantine already, of this run or an earlier one that
    stopped halfway, are not written again. A row's hash fixes its month, so only
    the folders of the batch's months are read (one entry for each).
    """
    spark, folder = rejects.sparkSession, f"{root}/_quarantine"
    everywhere = f"{folder}/run_id=*/source_month=*"
    where, fs = hadoop_path(spark, everywhere)
    if fs.globStatus(where):
        months = [r[0] for r in rejects.select("source_month").distinct().collect()]
        held = spark.read.schema("record_hash string, source_month string").option("basePath", folder).json(everywhere)
        held = held.where(F.col("source_month").isin(*months) if months else F.lit(False)).select("record_hash")
        rejects = rejects.join(held, "record_hash", "left_anti")
    if not rejects.isEmpty():
        rejects.withColumn("rejected_at", F.current_timestamp()).write.mode("append").partitionBy("source_month").json(f"{folder}/run_id={run_id}")
