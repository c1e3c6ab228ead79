"""Helpers shared by the training-data operators: reads, shared scratch tables, Arrow maps, samples."""

from __future__ import annotations

import ctypes
import functools
import gc
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Executors share no folder with the driver, so functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules["brooklet.llm"])

#: Word separators of the word contracts: the complement of ``[^\x20\x09-\x0D]``.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A map over batches that gives freed memory back when its task ends: Python workers live on after it."""

    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        gc.collect()  # what earlier tasks brought with them: functions that arrive by value hang in cycles
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return wrapped


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of few rows and bytes, so that Python workers stay small beside very long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2048")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


_scratch: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a folder of its own; on a cluster that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="brooklet-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def written(df: DataFrame, name: str, group_bytes: int | None = None) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet in the shared folder and read it back.

    Unlike a cached frame it survives lost executors, and its file sizes give
    the optimizer a measured bound before it broadcasts anything. The table goes
    with ``dropped``, ``drop_scratch`` or, at the latest, the driver's JVM.

    ``group_bytes`` is for rows of megabytes: row groups end near that size, looked at
    with each row. By default the writer looks every 100 rows, holds them all until
    then, and a reader unpacks the group's arrays at once.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    system, where = _hadoop(spark, path)
    system.deleteOnExit(where)
    _scratch.append(path)
    writer = df.write
    if group_bytes:
        writer = writer.options(**{"parquet.block.size": group_bytes, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1})
    writer.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.scratch_path = path
    return back


def _hadoop(spark: SparkSession, path: str) -> tuple:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _removed(spark: SparkSession, path: str) -> None:
    system, where = _hadoop(spark, path)
    system.delete(where, True)
    system.cancelDeleteOnExit(where)
    if path in _scratch:
        _scratch.remove(path)


def dropped(df: DataFrame) -> None:
    """Remove a scratch table that no later plan reads."""
    path = getattr(df, "scratch_path", None)
    if path:
        _removed(df.sparkSession, path)


def scratch_tables() -> list[str]:
    """The paths of the scratch tables that stand."""
    return list(_scratch)


def drop_scratch(spark: SparkSession, keep: Iterable[str] = ()) -> None:
    """Remove all scratch tables but those of some paths; frames that read them can't run any more."""
    for path in set(_scratch) - set(keep):
        _removed(spark, path)


def unused(columns: Iterable[str], *names: str) -> list[str]:
    """The names, each lengthened until it clashes with no column (Spark compares without case)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def every(df: DataFrame) -> list[Column]:
    """All columns by quoted name, whatever characters the names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def map_all(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType) -> DataFrame:
    """A map over all columns; batches name them c0, c1, .. since the call resolves names that hold dots wrongly."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]).mapInArrow(run, schema)


def byte_column(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A string column as UTF-8 bytes, null as empty."""
    column = batch.column(batch.schema.get_field_index(name))
    return [x or b"" for x in column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()]


def pieces(batch: pa.RecordBatch, texts: list[bytes], limit: int = 1 << 22):
    """Split a batch into (row numbers, texts) runs of about ``limit`` bytes, a longer text alone."""
    rows: list[int] = []
    size = 0
    for i, t in enumerate(texts):
        if rows and size + len(t) > limit:
            yield rows, [texts[j] for j in rows]
            rows, size = [], 0
        rows.append(i)
        size += len(t)
    if rows:
        yield rows, [texts[j] for j in rows]


def bucket(column: Column, modulus: int) -> Column:
    """crc32 of the value as text, modulo ``modulus``: the split between learning and held-out rows."""
    return F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(modulus))


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, limit: int, learn: Column | None = None) -> DataFrame:
    """At most ``limit`` labelled documents (doc_id, label, text), chosen by the hash order of their ids.

    Of documents that share an id the least text is taken, of labels the least.
    The bound is a parameter of the caller; only ids and labels (``limit`` of
    them at most) pass the driver, so the broadcast side has a proven size.
    """
    spark = docs.sparkSession
    rows = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    if learn is not None:
        rows = rows.where(learn)
    each = rows.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(F.col(label).cast("int")).alias("label"))
    picked = each.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit).collect()
    side = spark.createDataFrame(sorted((r["doc_id"], r["label"]) for r in picked), "doc_id long, label int")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(side), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))


#: What a false alarm costs, against a miss, where a cut is calibrated.
CAUTION = 10


def calibrated(p: np.ndarray, wanted: np.ndarray, caution: float = CAUTION) -> float:
    """The cut that makes recall less ``caution`` times the share of false alarms greatest; in the middle of a gap."""
    values, at = np.unique(p, return_inverse=True)
    caught = np.bincount(at, wanted == 1, len(values))
    return calibrated_counts(values, caught, np.bincount(at, minlength=len(values)) - caught, caution)


def calibrated_counts(values: np.ndarray, wanted: np.ndarray, others: np.ndarray, caution: float = CAUTION) -> float:
    """The same from how many wanted and other rows have each of some ascending values."""
    before = lambda n: np.append(0, np.cumsum(n))
    hits, alarms = 1 - before(wanted) / max(1, wanted.sum()), 1 - before(others) / max(1, others.sum())  # cut k: rows from value k on are caught
    best = int(np.argmax(hits - caution * alarms))
    low, high = (values[best - 1] if best else 0.0), (values[best] if best < len(values) else 1.0)
    return float((low + high) / 2)
