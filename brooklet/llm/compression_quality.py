"""Quality by compression: dictionaries of good and of bad text, and the difference they make.

Two zstandard dictionaries are trained on labelled text of either class. A text
is compressed with both, all of it, in blocks of ``PIECE`` bytes (a parameter of
the model: training, calibration and scoring use the same); the difference of the
two compressed sizes per byte of text, through a logistic calibration fitted on
labelled rows that trained no dictionary, is the score. Equal differences have
equal scores.

Null and empty texts have difference 0 and get its calibrated score. Without
four labelled texts (not empty) of each class the score is the share of label 1
for all (0.5 without labels).
Rows that repeat, in doc_id or altogether, are scored each for itself and alike;
for learning, one row of each labelled id (the least text) counts, and equal rows
count once. An empty table gives an empty result. Only doc_id and text are read,
so other columns, whatever their names, change nothing. Learning uses at most
``SAMPLE`` labelled rows, up to half of them, and ``TRAIN_ROWS`` of each class,
for dictionaries (documented bounds). Texts are always taken whole: one that is
longer than a dictionary trains none, unless its class has no shorter one, and
the others are calibrated on in the tasks that read them. Every text, however
long, is scored whole, in the task that reads it.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.llm.common import bucket, byte_column, dropped, labelled_rows, released, table, written

SAMPLE = 8192
PIECE = 512
DICTIONARY = 64 << 10
TRAIN_ROWS = 1500
LEVEL = 3


class Model(NamedTuple):
    good: bytes
    bad: bytes
    slope: float
    offset: float
    centre: float
    scale: float


class Compressors:
    def __init__(self, model: Model) -> None:
        self.model = model
        self.good, self.bad = self._of(model.good), self._of(model.bad)

    @staticmethod
    def _of(content: bytes) -> zstandard.ZstdCompressor:
        d = zstandard.ZstdCompressionDict(content)
        d.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)

    def difference(self, text: bytes) -> float:
        """Bytes that the good dictionary saves against the bad one, per byte of text."""
        if not text:
            return 0.0
        saved = 0
        for i in range(0, len(text), PIECE):
            piece = text[i : i + PIECE]
            saved += len(self.bad.compress(piece)) - len(self.good.compress(piece))
        return saved / len(text)

    def score(self, texts: list[bytes]) -> np.ndarray:
        m = self.model
        d = np.array([self.difference(t) for t in texts])
        return 1 / (1 + np.exp(-np.clip(m.slope * (d - m.centre) / m.scale + m.offset, -40, 40)))


def dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary; of too little text, the text itself."""
    samples = [t[i : i + PIECE] for t in texts for i in range(0, len(t), PIECE)]
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY:]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.01) -> tuple[float, float]:
    """(slope, offset) of a one-feature logistic regression, by Newton steps."""
    a = np.stack([x, np.ones_like(x)], 1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p) + 1e-9)[:, None]).T @ a + ridge * np.eye(2)
        step = np.linalg.solve(h, a.T @ (y - p) - ridge * w)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def calibrated(good: bytes, bad: bytes, d: np.ndarray, y: np.ndarray) -> Model:
    """The model of two dictionaries and the differences of labelled rows."""
    centre, scale = (float(d.mean()), float(d.std()) or 1.0) if len(d) else (0.0, 1.0)
    return Model(good, bad, *logistic((d - centre) / scale, y.astype(float)), centre, scale)


def differences(rows: DataFrame, good: bytes, bad: bytes) -> list[tuple[float, int]]:
    """(difference, label) of rows (text, label), sorted."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = Compressors(Model(good, bad, 0.0, 0.0, 0.0, 1.0))
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([compressors.difference(t) for t in byte_column(batch, "text")], pa.float64()), batch.column(1)], ["d", "label"])

    return sorted((r["d"], r["label"]) for r in rows.select("text", "label").mapInArrow(run, "d double, label int").collect())


def score(docs: DataFrame, model: Model | float, held_out: Column) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    names = ["doc_id", "held_out", "score", "predicted"]

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = None if isinstance(model, float) else Compressors(model)
        for batch in batches:
            texts = byte_column(batch, "text")
            s = np.full(len(texts), model) if compressors is None else compressors.score(texts)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def fit_from(docs: DataFrame, labels: DataFrame, learn: Column | None = None, sample: int = SAMPLE) -> Model | float:
    """The model of a bounded sample of labelled rows, or the share of label 1 where there is nothing to learn."""
    labelled = labelled_rows(docs, labels, "quality", sample, learn).select("text", "label").distinct()
    rows = written(labelled.withColumn("order", F.xxhash64("text")), "labelled")
    try:
        return _fit(rows)
    finally:
        dropped(rows)


def _fit(rows: DataFrame) -> Model | float:
    # At most SAMPLE rows of three numbers.
    known = sorted((r["label"], r["order"], r["size"] or 0) for r in rows.select("label", "order", F.octet_length("text").alias("size")).collect())
    full = {y: [(order, size) for label, order, size in known if label == y and size] for y in (0, 1)}
    if min(map(len, full.values())) < 4:
        return sum(label for label, _, _ in known) / len(known) if known else 0.5
    trains = F.lit(False)
    for y, found in full.items():
        longest = max(DICTIONARY, min(size for _, size in found))
        able = [order for order, size in found if size <= longest]
        last = able[: min(TRAIN_ROWS, (len(found) + 1) // 2)][-1]
        trains = trains | ((F.col("label") == y) & (F.col("order") <= last) & (F.octet_length("text") <= longest))
    some = rows.where(F.octet_length("text") > 0)
    by: dict[int, list[bytes]] = {0: [], 1: []}
    for r in some.where(trains).orderBy("label", "order", "text").collect():
        by[r["label"]].append(r["text"].encode())
    good, bad = dictionary(by[1]), dictionary(by[0])
    found = differences(some.where(~trains), good, bad)
    return calibrated(good, bad, np.array([d for d, _ in found]), np.array([y for _, y in found]))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    remainder = bucket(F.col("doc_id"), 3)
    model = fit_from(docs, table(spark, sf_dir, "labels"), remainder != 1)
    return score(docs, model, F.coalesce(remainder == 1, F.lit(False)))


QUERIES = {"op10_quality_classifier": op10_quality_classifier}
ORACLES: dict[str, str] = {}
