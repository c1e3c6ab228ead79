"""Toxicity by cumulative-link ordinal regression over sparse text features.

P(grade >= k) = logistic(w . x - t_k) for grades 1..``GRADES``, with one weight
vector w for all ordered thresholds t_1 < t_2 < ..; the severity is the expected
grade, the sum of these probabilities. Features are the logarithms of one plus
the counts of lower-cased words and of their beginnings of 3 to 8 letters; the
``FEATURES`` with the strongest association with the toxic label are used (ties:
by name), each found in at least ``SUPPORT`` toxic rows.

Labels are binary, so what the model grades is out of fold: the labelled rows are
halved by the hash of their texts, a binary model of either half scores the
other, and toxic rows get the tercile of that score. The probability of grade 1
from which a row counts as toxic is calibrated the same way, on rows that the
scoring model wasn't fitted to: it makes recall less ``CAUTION`` times the share
of false alarms greatest, and lies in the middle of the gap where that is so.

Null, empty and letterless texts have no features and get the severity of such
rows. Without rows of both labels, or without features, everything has severity 0
and nothing is toxic; where a half lacks them, all toxic rows are of grade 1 and
the cut is 0.5. Rows that repeat, in doc_id or altogether, are scored each for
itself and alike; for learning, one row of each labelled id (the least text)
counts, and equal rows count once. An empty table gives an empty result. Only
doc_id and text are read, so other columns change nothing. The model is fitted on
at most ``SAMPLE`` labelled rows (documented bound) with whole texts, whose
features are counted where they are read; every text, however long, is scored
whole, in the task that reads it.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.llm.common import CAUTION, calibrated, dropped, labelled_rows, released, table, written

SAMPLE = 8192
FEATURES, SUPPORT, RATIO = 256, 3, 3
BEGINNINGS = range(3, 9)
GRADES = 3
_WORD = re.compile(r"[^\W\d_]+")
#: Feature counts that a task gathers before it hands them on.
_HELD = 200_000
_PARTS = ["clean_0", "clean_1", "toxic_0", "toxic_1"]  # label and half


def word_features(word: str) -> list[str]:
    """The word, closed by a space, and its beginnings."""
    return [word + " ", *(word[:k] for k in BEGINNINGS if k <= len(word))]


class Model(NamedTuple):
    index: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray
    cut: float = 0.5

    def vectors(self, texts: Iterable[str | None], known: dict[str, tuple[int, ...]] | None = None) -> np.ndarray:
        """The features of some texts, a row for each."""
        known = {} if known is None else known
        rows = [np.zeros((0, len(self.index)))]
        for text in texts:
            rows.append(np.log1p(counted(text, self.index, known))[None])
        return np.concatenate(rows)

    def at_least(self, x: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1..GRADES."""
        return 1 / (1 + np.exp(-np.clip((x @ self.weights)[:, None] - self.thresholds, -40, 40)))


def counted(text: str | None, index: dict[str, int], known: dict[str, tuple[int, ...]]) -> np.ndarray:
    """How often each feature of an index occurs; ``known`` remembers some words' features."""
    x = np.zeros(len(index))
    if len(known) > 300_000:
        known.clear()
    for word in _WORD.findall((text or "").lower()):
        hits = known.get(word)
        if hits is None:
            hits = known[word] = tuple(index[f] for f in word_features(word) if f in index)
        for i in hits:
            x[i] += 1
    return x


def feature_counts(rows: DataFrame) -> DataFrame:
    """(feature, and in how many rows of each label and half it occurs) of rows (text, label, half)."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[int]] = {}

        def given() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), *(pa.array([v[k] for v in held.values()], pa.int64()) for k in range(4))], ["feature", *_PARTS])
            held.clear()
            return out

        for batch in batches:
            for text, label, half in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                part = 2 * label + half
                for f in {f for w in set(_WORD.findall((text or "").lower())) for f in word_features(w)}:
                    held.setdefault(f, [0, 0, 0, 0])[part] += 1
                if len(held) >= _HELD:
                    yield given()
        yield given()

    found = rows.select("text", "label", "half").mapInArrow(run, "feature string, " + ", ".join(f"{c} long" for c in _PARTS))
    return found.groupBy("feature").agg(*(F.sum(c).alias(c) for c in _PARTS))


def selected(counts: DataFrame, sizes: dict[str, int], halves: Iterable[int]) -> list[str]:
    """The features most associated with the label in some halves, by the likelihood ratio of presence."""
    both = lambda kind: sum((F.col(f"{kind}_{h}") for h in halves), F.lit(0))
    p, n = (sum(sizes[f"{kind}_{h}"] for h in halves) for kind in ("toxic", "clean"))
    if not p or not n:
        return []
    a, b = F.col("a"), F.col("b")
    part = lambda k, total: F.when(k > 0, k * F.log(k / total * (p + n) / (a + b))).otherwise(0.0)
    able = counts.select("feature", both("toxic").alias("a"), both("clean").alias("b")).where((a >= SUPPORT) & ((a + 0.5) / (p + 1) > RATIO * (b + 0.5) / (n + 1)))
    return [r["feature"] for r in able.orderBy((part(a, p) + part(b, n)).desc(), "feature").limit(FEATURES).collect()]


def sparse(rows: DataFrame, names: list[str]) -> list[tuple[int, int, list[int], list[float]]]:
    """(label, half, places, counts) of rows (text, label, half)."""
    index = {f: i for i, f in enumerate(names)}

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            found = [counted(t, index, known) for t in batch.column(0).to_pylist()]
            at = [np.flatnonzero(x) for x in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array([i.tolist() for i in at], pa.list_(pa.int32())), pa.array([x[i].tolist() for x, i in zip(found, at, strict=True)], pa.list_(pa.float64()))],
                ["label", "half", "places", "counts"],
            )

    out = rows.select("text", "label", "half").mapInArrow(run, "label int, half int, places array<int>, counts array<double>").collect()
    return sorted((r["label"], r["half"], r["places"], r["counts"]) for r in out)


def fit_ordinal(x: np.ndarray, grade: np.ndarray, grades: int = GRADES, ridge: float = 0.3, steps: int = 500) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) by gradient steps (Adam); thresholds stay ordered as sums of exponentials."""
    total = len(x)
    both, times = np.unique(np.concatenate([x, grade[:, None]], 1), axis=0, return_counts=True)  # equal rows are one row with a weight
    x, grade = both[:, :-1], both[:, -1].astype(int)
    n, f = x.shape
    w, raw = np.zeros(f), np.concatenate([[2.0], np.full(grades - 1, 0.0)])
    m, v = np.zeros(f + grades), np.zeros(f + grades)
    steps_at = (np.arange(1, grades + 1) == grade[:, None]).astype(float) - (np.arange(1, grades + 1) == grade[:, None] + 1)
    for step in range(1, steps + 1):
        t = np.cumsum(np.concatenate([raw[:1], np.exp(raw[1:])]))
        above = 1 / (1 + np.exp(-np.clip((x @ w)[:, None] - t, -40, 40)))
        full = np.concatenate([np.ones((n, 1)), above, np.zeros((n, 1))], 1)
        each = np.maximum(full[np.arange(n), grade] - full[np.arange(n), grade + 1], 1e-9)
        # d log P(grade) / d logit_k: the two cut points around the grade.
        slope = times[:, None] * above * (1 - above) * steps_at / each[:, None]
        gw = -(x.T @ slope.sum(1)) + ridge * w
        gt = slope.sum(0)
        tail = np.cumsum(gt[::-1])[::-1]
        g = np.concatenate([gw, [tail[0]], tail[1:] * np.exp(raw[1:])]) / total
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, raw = w - move[:f], raw - move[f:]
    return w, np.cumsum(np.concatenate([raw[:1], np.exp(raw[1:])]))


def graded(score: np.ndarray, toxic: np.ndarray, grades: int = GRADES) -> np.ndarray:
    """0 for clean rows, for toxic ones 1 and the number of quantiles that their score exceeds."""
    cuts = np.quantile(score[toxic == 1], np.arange(1, grades) / grades)
    return np.where(toxic == 1, 1 + np.searchsorted(cuts, score, side="left"), 0)


def fit(rows: list[tuple[int, int, list[int], list[float]]], names: list[str], of_half: list[list[str]], chosen: list[str]) -> Model | None:
    """The model of some rows (label, half, places among ``names``, counts).

    ``chosen`` are the features of all rows, ``of_half[h]`` those that half h alone would choose.
    """
    toxic, half = np.array([r[0] for r in rows], int), np.array([r[1] for r in rows], int)
    if not chosen or not len(rows) or toxic.min() == toxic.max():
        return None
    x = np.zeros((len(rows), len(names)))
    for i, (_, _, places, counts) in enumerate(rows):
        x[i, places] = counts
    x = np.log1p(x)
    at = {f: i for i, f in enumerate(names)}
    columns = lambda some: [at[f] for f in some]
    halves = [half == h for h in (0, 1)]
    able = all(of_half[h] and 0 < toxic[halves[h]].sum() < halves[h].sum() for h in (0, 1))
    grade, cut = toxic, 0.5
    if able:
        apart = np.zeros(len(rows))
        for h in (0, 1):  # each half is scored by the other's model
            some, own = columns(of_half[h]), halves[h]
            w, t = fit_ordinal(x[own][:, some], toxic[own], grades=1)
            apart[~own] = x[~own][:, some] @ w - t[0]
        grade = graded(apart, toxic)
        p = np.zeros(len(rows))
        for h in (0, 1):
            some, own = columns(of_half[h]), halves[h]
            w, t = fit_ordinal(x[own][:, some], grade[own])
            p[~own] = 1 / (1 + np.exp(-np.clip(x[~own][:, some] @ w - t[0], -40, 40)))
        cut = calibrated(p, toxic)
    w, t = fit_ordinal(x[:, columns(chosen)], grade)
    return Model({f: i for i, f in enumerate(chosen)}, w, t, cut)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, severity, p_toxic, grade, toxic) of every row."""
    names = ["doc_id", "severity", "p_toxic", "grade", "toxic"]

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                above = model.at_least(model.vectors(part.column(1).to_pylist(), known)) if model else np.zeros((part.num_rows, GRADES))
                severity = above.sum(1)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), pa.array(severity), pa.array(above[:, 0]), pa.array(np.rint(severity).astype(np.int32)), pa.array(above[:, 0] >= (model.cut if model else 2))], names
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, severity double, p_toxic double, grade int, toxic boolean")


def fit_from(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    labelled = labelled_rows(docs, labels, "toxic", sample).select(F.coalesce("text", F.lit("")).alias("text"), "label").distinct()
    rows = written(labelled.withColumn("half", F.pmod(F.xxhash64("text"), F.lit(2)).cast("int")), "labelled")
    sizes = dict.fromkeys(_PARTS, 0) | {_PARTS[2 * r["label"] + r["half"]]: r["count"] for r in rows.groupBy("label", "half").count().collect()}
    counts = written(feature_counts(rows), "features")
    chosen, *of_half = (selected(counts, sizes, halves) for halves in ((0, 1), (0,), (1,)))
    names = sorted({*chosen, *of_half[0], *of_half[1]})
    model = fit(sparse(rows, names), names, of_half, chosen) if chosen else None
    dropped(rows)
    dropped(counts)
    return model


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit_from(docs, table(spark, sf_dir, "labels")))


QUERIES = {"op4_toxicity": op4_toxicity}
ORACLES: dict[str, str] = {}
