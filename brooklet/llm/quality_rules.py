"""Quality rules: exact text statistics, base rules, and an isolation forest over the statistics.

Words are ``[^\\x20\\x09-\\x0D]+`` runs of the UTF-8 text (bytes.split() has the
same separators). Null and empty texts have all statistics 0 and fail the base
rule. Statistics are taken over whole texts, however long, one document at a time
in the task that reads it; nothing is shuffled. Rows that repeat, in doc_id or
altogether, are judged each for itself and alike. An empty table gives an empty
result. Reports read doc_id and text alone; ``kept_documents`` keeps all columns,
whatever their names. Of two rows with equal statistics both stay or both go.

The forest is fitted on all labelled rows (one row of each labelled id counts, that
of the least statistics). Good rows of one half (by a hash of the id) that pass the
base rules are those that trees grow from: each of the ``TREES`` takes ``TREE_ROWS``, as isolation
forests do, out of the first rows of all by a hash order, as many as the trees take together. The box
of the splits is that of all rows that pass. The other half grows none: there all rows are scored
and counted by score (in steps of 1 / ``SCALE``), from which the score
is calibrated from which a row goes (share of bad rows caught less
``CAUTION`` times the share of good ones lost is greatest, in the middle of the
gap where that is so), and there it shows which statistics serve: the forest
starts from all of ``RATIOS``, and one after another is left out as long as that
raises the calibrated figure. With fewer than 20 good rows to grow trees from,
or no row left to calibrate on, the forest rejects nothing. Statistics of documents are
written once, a hundredth of long texts; what passes the driver are the trees' rows and the counts.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.llm.common import CAUTION, byte_column, calibrated_counts, dropped, map_all, released, table, written

#: Scores are told apart in so many steps.
SCALE = 10_000
TREES, TREE_ROWS, SEED = 100, 256, 17
MIN_WORDS = 50
_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
_CONTINUATION = bytes(range(0x80, 0xC0))
_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(0x80, 0x100))
_FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks"]


def repeat_words(words: list[bytes]) -> int:
    """Words inside three-word windows found twice or more in the text, the first finding included."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = defaultdict(itertools.count().__next__)
    ids = np.fromiter(map(number.__getitem__, words), np.int64, n)
    v = len(number)
    pair = ids[:-1] * v + ids[1:]
    if v >= 2_000_000:
        pair = np.unique(pair, return_inverse=True)[1]
    code = pair[:-1] * v + ids[2:]
    order = np.argsort(code, kind="stable")
    same = code[order[1:]] == code[order[:-1]]
    if not same.any():
        return 0
    found = np.zeros(n - 2, bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    covered[:-2] = found
    covered[1:-1] |= found
    covered[2:] |= found
    return int(covered.sum())


def statistics(text: bytes) -> tuple[int, ...]:
    """The counts of ``_FIELDS`` for one UTF-8 text."""
    if not text:
        return (0,) * len(_FIELDS)
    words = text.split()
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    without = text.translate(None, _SPACE)
    return (
        len(words),
        len(without.translate(None, _CONTINUATION)),
        len(without) - len(without.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)),
        repeat_words(words),
        len(without) - len(without.translate(None, _UPPER)),
        len(without.translate(None, _LETTERS)),
    )


def base_failed(s: np.ndarray) -> np.ndarray:
    return (s[:, 0] < MIN_WORDS) | (100 * s[:, 4] > 50 * s[:, 0])


RATIOS = ["word length", "symbols", "capitals", "marks", "repeated words", "repeated lines", "log words"]


def features(s: np.ndarray) -> np.ndarray:
    """The statistics on comparable scales, one column for each of ``RATIOS``."""
    s = s.astype(float)
    words, chars = np.maximum(s[:, 0], 1), np.maximum(s[:, 1], 1)
    return np.stack([s[:, 1] / words, s[:, 2] / chars, s[:, 5] / chars, s[:, 6] / chars, s[:, 4] / words, s[:, 3] / words, np.log(words)], 1)


def _mean_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search in a binary tree of n rows."""
    n = np.asarray(n, float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


class IsolationForest:
    """Random splits over random subsamples; rows that few splits set apart are anomalous.

    Splits are drawn over a box, that of ``around`` (by default of x), and each
    half keeps its part of the box: a feature in which all of x agree still
    tells a row apart that differs in it.
    """

    def __init__(self, x: np.ndarray, around: np.ndarray | None = None, trees: int = TREES, rows: int = TREE_ROWS, seed: int = SEED) -> None:
        rng = np.random.default_rng(seed)
        box = x if around is None else around
        self.rows = max(2, min(rows, len(x)))
        self.depth = int(np.ceil(np.log2(self.rows)))
        self.trees = [self._tree(x[rng.choice(len(x), min(rows, len(x)), replace=False)], box.min(0), box.max(0), rng) for _ in range(trees)]

    def _tree(self, x: np.ndarray, low: np.ndarray, high: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
        nodes: list[list[float]] = []

        def grow(rows: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int) -> int:
            at = len(nodes)
            nodes.append([-1, 0.0, at, at, depth + float(_mean_path(len(rows)))])
            wide = np.flatnonzero(high > low) if len(rows) > 1 else np.array([], int)
            if depth < self.depth and len(wide):
                f = int(rng.choice(wide))
                cut = rng.uniform(low[f], high[f])
                below, above = high.copy(), low.copy()
                below[f] = above[f] = cut
                left = grow(rows[rows[:, f] <= cut], low, below, depth + 1)
                nodes[at] = [f, cut, left, grow(rows[rows[:, f] > cut], above, high, depth + 1), 0.0]
            return at

        grow(x, low, high, 0)
        t = np.array(nodes)
        return t[:, 0].astype(int), t[:, 1], t[:, 2].astype(int), t[:, 3].astype(int), t[:, 4]

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-mean path / expected path): near 1 for anomalies, below 0.5 for ordinary rows."""
        total = np.zeros(len(x))
        each = np.arange(len(x))
        for f, cut, left, right, length in self.trees:
            at = np.zeros(len(x), int)
            for _ in range(self.depth):
                at = np.where(f[at] < 0, at, np.where(x[each, np.maximum(f[at], 0)] <= cut[at], left[at], right[at]))
            total += length[at]
        return 2.0 ** (-total / len(self.trees) / float(_mean_path(self.rows)))


class Model(NamedTuple):
    forest: IsolationForest
    columns: list[int]  # of features
    cut: float  # rows of this anomaly and above go

    def steps(self, x: np.ndarray) -> np.ndarray:
        """The scores of some features in whole steps."""
        return np.rint(self.forest.score(x[:, self.columns]) * SCALE).astype(np.int64)

    def score(self, s: np.ndarray) -> np.ndarray:
        return self.steps(features(s)) / SCALE


#: How many bad and good rows (two columns) have each score, by model.
Counter = Callable[[list[Model]], np.ndarray]


def counted(models: list[Model], batches: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The counts of (features, good) rows."""
    found = np.zeros((len(models), SCALE + 1, 2), np.int64)
    for x, good in batches:
        for k, model in enumerate(models):
            found[k] += np.bincount(2 * model.steps(x) + good, minlength=2 * SCALE + 2).reshape(-1, 2)
    return found


def chosen(x: np.ndarray, box: np.ndarray, count: Counter, caution: float = CAUTION) -> Model:
    """The model whose trees grow from features ``x``, with the columns and the cut that serve best by the counts."""

    def tried(sets: list[list[int]]) -> list[tuple[float, Model]]:
        out, models = [], [Model(IsolationForest(x[:, c], box[:, c]), c, 0.0) for c in sets]
        for model, found in zip(models, count(models), strict=True):
            steps = np.flatnonzero(found.sum(1))
            bad, good = found[steps].T
            cut = calibrated_counts(steps / SCALE, bad, good, caution)
            gone = steps / SCALE >= cut
            caught = bad[gone].sum() / bad.sum() if bad.any() else 1.0
            out.append((caught - caution * (good[gone].sum() / good.sum() if good.any() else 0.0), model._replace(cut=cut)))
        return out

    (best,) = tried([list(range(len(RATIOS)))])
    while len(best[1].columns) > 1:
        fewer = max(tried([[c for c in best[1].columns if c != out] for out in best[1].columns]), key=lambda t: t[0])
        if fewer[0] <= best[0]:
            break
        best = fewer
    return best[1]


def fit(sample: list[tuple[tuple[int, ...], int]], caution: float = CAUTION) -> Model | None:
    """The model of (statistics, quality) rows at hand; None with too few good rows."""
    s, good = np.array([x for x, _ in sample]).reshape(-1, len(_FIELDS)), np.array([q for _, q in sample]) == 1
    able, grows = ~base_failed(s), np.arange(len(s)) % 2 == 0
    x, trees, rest = features(s), able & good & grows, able & ~grows
    if trees.sum() < 20 or not rest.any():
        return None
    return chosen(x[trees], x[able], lambda models: counted(models, iter([(x[rest], good[rest])])), caution)


def with_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of every text."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = np.array([statistics(t) for t in byte_column(batch, "text")], np.int64).reshape(-1, len(_FIELDS))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *map(pa.array, s.T.copy())], ["doc_id", *_FIELDS])

    return docs.select("doc_id", "text").mapInArrow(run, ", ".join(f"{c} long" for c in ["doc_id", *_FIELDS]))


def fit_from(docs: DataFrame, labels: DataFrame) -> Model | None:
    return fit_statistics(with_statistics(docs), labels)


def fit_statistics(stats: DataFrame, labels: DataFrame, caution: float = CAUTION) -> Model | None:
    """The model of all labelled rows, from the statistics of documents."""
    spark = stats.sparkSession
    marked = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.min(F.col("quality").cast("int")) == 1).alias("good"))
    each = stats.join(marked, "doc_id").groupBy("doc_id", "good").agg(F.min(F.struct(*_FIELDS)).alias("s")).select("doc_id", "good", "s.*")
    able = each.where((F.col("n_words") >= MIN_WORDS) & (100 * F.col("n_repeat_words") <= 50 * F.col("n_words")))
    grows = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(2)) == 0
    known = written(able.withColumn("grows", grows).repartition(spark.sparkContext.defaultParallelism, "doc_id"), "labelled-statistics")
    try:
        trees, rest = known.where("grows AND good"), known.where("NOT grows")
        drawn = trees.orderBy(F.xxhash64(F.lit(SEED + 1), "doc_id"), "doc_id").limit(TREES * TREE_ROWS).select(*_FIELDS).collect()
        if len(drawn) < 20 or rest.isEmpty():
            return None
        return chosen(features(np.array(drawn, np.int64)), _box(known), lambda models: _counted(rest, models), caution)
    finally:
        dropped(known)


def _features(batch: pa.RecordBatch) -> np.ndarray:
    return features(np.stack([batch.column(batch.schema.get_field_index(c)).to_numpy() for c in _FIELDS], 1))


def _box(known: DataFrame) -> np.ndarray:
    """The least and the greatest of each feature, two rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _features(batch)
                yield pa.RecordBatch.from_arrays([pa.array([k]) for k in (*x.min(0), *x.max(0))], [f"f{k}" for k in range(2 * len(RATIOS))])

    ends = known.select(*_FIELDS).mapInArrow(run, ", ".join(f"f{k} double" for k in range(2 * len(RATIOS))))
    n = len(RATIOS)
    return np.array(ends.agg(*[F.min(f"f{k}") for k in range(n)], *[F.max(f"f{k}") for k in range(n, 2 * n)]).first()).reshape(2, n)


def _counted(rest: DataFrame, models: list[Model]) -> np.ndarray:
    """The counts of all rows, at most SCALE numbers for each model and label."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = counted(models, ((_features(b), b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)) for b in batches if b.num_rows))
        at = np.nonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (*at, found[at])], ["model", "step", "good", "n"])

    out = np.zeros((len(models), SCALE + 1, 2), np.int64)
    for r in rest.select("good", *_FIELDS).mapInArrow(run, "model long, step long, good long, n long").groupBy("model", "step", "good").agg(F.sum("n").alias("n")).collect():
        out[r.model, r.step, r.good] = r.n
    return out


def _verdicts(s: np.ndarray, model: Model | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base_failed, anomaly, kept) of statistics rows."""
    failed, anomaly = base_failed(s), np.zeros(len(s))
    if model is not None and len(s):
        anomaly = model.score(s)
        return failed, anomaly, ~failed & (anomaly < model.cut)
    return failed, anomaly, ~failed


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the statistics, base_failed, kept and the anomaly score of every document."""
    stats = written(with_statistics(docs), "statistics")
    model = fit_statistics(stats, labels)
    names = ["doc_id", *_FIELDS[:5], "base_failed", "kept", "anomaly"]

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = np.stack([c.to_numpy() for c in batch.columns[1:]], 1)
            failed, anomaly, kept = _verdicts(s, model)
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(failed), pa.array(kept), pa.array(anomaly)], names)

    return stats.select("doc_id", *_FIELDS).mapInArrow(run, ", ".join([f"{c} long" for c in names[:6]] + ["base_failed boolean, kept boolean, anomaly double"]))


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, columns unchanged."""
    model = fit_from(docs, labels)
    names, at = docs.columns, docs.columns.index("text")

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = np.array([statistics(t) for t in byte_column(batch, f"c{at}")], np.int64).reshape(-1, len(_FIELDS))
            yield batch.filter(pa.array(_verdicts(s, model)[2])).rename_columns(names)

    return map_all(docs, run, docs.schema)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op9_quality_rules": op9_quality_rules}
ORACLES: dict[str, str] = {}
