"""Hard negatives of anchor vectors, by vantage-point trees over norm-augmented vectors.

Scores are inner products of whole numbers. A component ``sqrt(M - |x|^2)`` more
(M: the greatest squared norm) gives all vectors one norm, so with the anchor's
added component 0 a score s is a distance ``sqrt(|q|^2 + M - 2 s)``: nearest is
best, and a window of scores is an annulus.

Plan. Rows are dealt to regions, the leaves of a vantage-point tree over a bounded
sample (``SAMPLED`` rows for each of at most ``REGIONS`` regions reach the driver,
and travel with the tasks); every row is dealt. A region of more than ``SHARD``
rows, also one of mere copies, is split by row into shards. A task reads a shard,
builds a tree over it, and then streams the anchors that visit it, batch by batch
(of a batch, the anchors that a leaf may serve are scored with it in one product);
anchors are taken in blocks of ``ANCHORS``, which tasks of their own serve.

Positives: an anchor first visits the region nearest to it, then those that can
hold a row as near as the last of what it found. Negatives: it visits the regions
that its annuli meet. In a shard, leaves are visited inside the
annulus (the nearest one, then all in one order for the whole batch), and an anchor
skips those that can't hold anything better. All bounds carry a slack over rounding
and scores are whole numbers, so results are exact: the best of each shard are merged
by partial limits. A shard gives at most the wanted number of rows for an anchor.

Defined cases: rows without id, label or vector, or with a component that is null
or not finite, take no part. Rows that repeat an id, or a whole row, are rows of
their own; a row is never its own positive. Ties go by id. Vectors of unequal
lengths count as ended by zeros. An empty table gives an empty result. Squared norms must stay under
2**53, else it is an error, since scores wouldn't be exact. Other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brooklet.llm.common import bounded_batches, released, table, written

POSITIVES, NEGATIVES, LOW_PERCENT, HIGH_PERCENT = 5, 3, 50, 95
SHARD, LEAF, REGIONS, SAMPLED, ANCHORS = 8192, 128, 1024, 16, 1 << 17
_EXACT = 1 << 53


class Tree:
    """A vantage-point tree over rows; ``leaves`` of it are runs of ``order``.

    A node splits its rows at the median distance from a vantage row, one far from
    the first; equal rows are split all the same. For each leaf and each node above
    it the least and greatest distance of the leaf's rows is kept.
    """

    def __init__(self, vectors: np.ndarray, most: float, leaf: int) -> None:
        self.most = most
        spare = np.sqrt(np.maximum(most - (vectors * vectors).sum(1), 0))
        self.order = np.arange(len(vectors))
        self.vantages: list[np.ndarray] = []
        self.spares: list[float] = []
        self.cuts: list[float] = []
        self.children: list[list[int]] = []  # a node's sides: a node, or ~leaf
        self.leaves: list[tuple[int, int]] = []
        self._above: list[list[tuple[int, float, float]]] = []
        away: list[np.ndarray] = []  # by depth, of every row
        todo = [(0, len(vectors), 0, [], None)]
        while todo:
            low, high, depth, path, parent = todo.pop()
            rows = self.order[low:high]
            if high - low <= leaf:
                name = ~len(self.leaves)
                self.leaves.append((low, high))
                self._above.append([(node, away[t][rows].min(initial=np.inf), away[t][rows].max(initial=0)) for t, node in enumerate(path)])
            else:
                name = len(self.vantages)
                seen = self._between(vectors, spare, rows, vectors[rows[0]], spare[rows[0]])
                vantage = rows[int(seen.argmax())]
                far = self._between(vectors, spare, rows, vectors[vantage], spare[vantage])
                if depth == len(away):
                    away.append(np.zeros(len(vectors)))
                away[depth][rows] = far
                by = np.argsort(far, kind="stable")
                self.order[low:high] = rows[by]
                middle = (high - low) // 2
                self.vantages.append(vectors[vantage])
                self.spares.append(float(spare[vantage]))
                self.cuts.append(float(far[by[middle]]))
                self.children.append([0, 0])
                # The near side first, so that leaves come in order.
                todo += [(low + middle, high, depth + 1, [*path, name], (name, 1)), (low, low + middle, depth + 1, [*path, name], (name, 0))]
            if parent:
                self.children[parent[0]][parent[1]] = name
        self.depth = max(map(len, self._above))
        self.nodes = np.array(self.vantages) if self.vantages else np.zeros((0, vectors.shape[1]))
        self.bounds = self.padded(self._above)

    def _between(self, vectors: np.ndarray, spare: np.ndarray, rows: np.ndarray, vantage: np.ndarray, own: float) -> np.ndarray:
        return np.sqrt(np.maximum(2 * self.most - 2 * (vectors[rows] @ vantage + spare[rows] * own), 0))

    def padded(self, above: list[list[tuple[int, float, float]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(nodes, least, greatest distance) by leaf and depth; what a leaf lacks bounds nothing."""
        node, least, greatest = np.zeros((len(above), self.depth), int), np.full((len(above), self.depth), -np.inf), np.full((len(above), self.depth), np.inf)
        for i, path in enumerate(above):
            for t, (name, low, high) in enumerate(path):
                node[i, t], least[i, t], greatest[i, t] = name, low, high
        return node, least, greatest

    def score_bounds(self, anchors: np.ndarray, bounds: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(least, greatest) score that rows of each leaf can have with each anchor."""
        own = (anchors * anchors).sum(1)[:, None]
        node, least, greatest = bounds
        near, far = np.zeros((len(anchors), len(node))), np.full((len(anchors), len(node)), np.inf)
        if len(self.nodes):
            away = np.sqrt(np.maximum(own + self.most - 2 * anchors @ self.nodes.T, 0))
            for t in range(self.depth):
                there = away[:, node[:, t]]
                np.maximum(near, np.maximum(least[:, t] - there, there - greatest[:, t]), out=near)
                np.minimum(far, there + greatest[:, t], out=far)
        slack = 0.5 + 1e-6 * self.most
        return (own + self.most - far**2) / 2 - slack, (own + self.most - near**2) / 2 + slack

    def leaf_of(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(leaf, distances from the nodes above it) of any vectors; distances behind the last are nan."""
        spare = np.sqrt(np.maximum(self.most - (vectors * vectors).sum(1), 0))
        at, away = np.zeros(len(vectors), int) if self.cuts else np.full(len(vectors), -1), np.full((len(vectors), self.depth), np.nan)
        for t in range(self.depth):
            for name in np.unique(at[at >= 0]):
                rows = np.flatnonzero(at == name)
                far = self._between(vectors, spare, rows, self.vantages[name], self.spares[name])
                away[rows, t] = far
                at[rows] = np.where(far < self.cuts[name], *self.children[name])
        return ~at, away


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Rows of a list column as floats, shorter ones ended by zeros."""
    sizes, flat = np.diff(column.offsets.to_numpy()), column.flatten().to_numpy()
    if (sizes == width).all():
        return flat.reshape(-1, width).astype(float)
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


class Shard:
    """The rows of a shard, in order of its tree's leaves."""

    def __init__(self, rows: pa.Table, width: int, most: float) -> None:
        vectors = _matrix(rows["vector"].combine_chunks(), width)
        self._tree = Tree(vectors, most, LEAF)
        of = lambda name: rows[name].to_numpy()[self._tree.order]
        self._vectors, self._row, self._id, self._label = vectors[self._tree.order], of("row"), of("vec_id"), of("label")
        self._labels, at = np.unique(self._label, return_inverse=True)
        self._holds = np.zeros((len(self._labels), len(self._tree.leaves)), bool)  # by label and leaf
        for i, (a, b) in enumerate(self._tree.leaves):
            self._holds[at[a:b], i] = True

    def best(self, k: int, same: bool, anchors: np.ndarray, label: np.ndarray, own: np.ndarray, of: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
        """(query, score, vec_id, row): the first k rows of each query, in order.

        Query i asks for rows of the label of anchor ``of[i]`` (or of others) but the
        anchor itself, with scores from ``low[i]`` to ``high[i]``. Each visits its nearest leaf
        first; then the leaves are swept, and only queries whose bounds still meet a leaf
        score it, all of them in one product.
        """
        least, greatest = self._tree.score_bounds(anchors, self._tree.bounds)
        there = np.searchsorted(self._labels, label)
        known = self._labels[np.minimum(there, len(self._labels) - 1)] == label
        alike = self._holds[np.minimum(there, len(self._labels) - 1)] & known[:, None]
        serves = alike if same else (self._holds.sum(0) > alike)
        reach = np.where(serves[of] & (least[of] <= high[:, None]), np.minimum(greatest[of], high[:, None]), -np.inf)
        bar = np.asarray(low, float).copy()  # the score that the k-th row of each query must reach
        held = _Best(len(of), k)
        todo = (reach >= bar[:, None]) & (reach > -np.inf)
        home = np.where(todo.any(1), np.where(todo, reach, -np.inf).argmax(1), -1)

        def visit(leaf: int, queries: np.ndarray) -> None:
            a, b = self._tree.leaves[leaf]
            who, at = np.unique(of[queries], return_inverse=True)
            scores = anchors[who] @ self._vectors[a:b].T
            scores[((self._label[a:b] == label[who, None]) != same) | (self._row[a:b] == own[who, None])] = -np.inf
            scores = scores[at]
            fits = (scores >= bar[queries, None]) & (scores <= high[queries, None]) & (scores > -np.inf)
            if b - a > k and np.count_nonzero(fits) > 4 * k * len(queries):
                fits &= scores >= np.partition(np.where(fits, scores, -np.inf), -k, axis=1)[:, [-k]]
            i, j = np.nonzero(fits)
            if len(i):
                full, worst = held.add(queries[i], scores[i, j], self._id[a + j], self._row[a + j])
                bar[full] = np.maximum(bar[full], worst)

        for leaf in np.unique(home[home >= 0]).tolist():
            visit(leaf, np.flatnonzero(home == leaf))
        todo[np.flatnonzero(home >= 0), home[home >= 0]] = False
        for leaf in np.argsort(-np.where(todo, reach, -np.inf).max(0, initial=-np.inf), kind="stable").tolist():
            queries = np.flatnonzero(todo[:, leaf] & (reach[:, leaf] >= bar))
            if len(queries):
                visit(leaf, queries)
        return held.rows()


class _Best:
    """The first k rows of some queries by score, then id, then row."""

    def __init__(self, queries: int, k: int) -> None:
        self._k, self._n = k, np.zeros(queries, int)
        self._score, self._id, self._row = np.zeros((queries, k)), np.zeros((queries, k), np.int64), np.zeros((queries, k), np.int64)

    def add(self, query: np.ndarray, score: np.ndarray, vec_id: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Take more rows; returns (queries among them that hold k rows, their worst scores)."""
        touched = np.unique(query)
        i, j = np.nonzero(np.arange(self._k) < self._n[touched, None])
        i = touched[i]
        query, score = np.append(i, query), np.append(self._score[i, j], score)
        vec_id, row = np.append(self._id[i, j], vec_id), np.append(self._row[i, j], row)
        by = np.lexsort((row, vec_id, -score, query))
        query = query[by]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        keep = place < self._k
        by, query, place = by[keep], query[keep], place[keep]
        self._score[query, place], self._id[query, place], self._row[query, place] = score[by], vec_id[by], row[by]
        np.maximum.at(self._n, query, place + 1)
        full = touched[self._n[touched] == self._k]
        return full, self._score[full, self._k - 1]

    def rows(self) -> tuple[np.ndarray, ...]:
        i, j = np.nonzero(np.arange(self._k) < self._n[:, None])
        return i, self._score[i, j].astype(np.int64), self._id[i, j], self._row[i, j]


_ROW = "row long, vec_id long, label int, vector array<long>"
_FOUND = "anchor long, anchor_id long, positive long, positive_id long, positive_score long, score long, vec_id long, row long"


def _searched(batches: Iterator[pa.RecordBatch], width: int, most: float, search) -> Iterator[pa.RecordBatch]:
    """Runs of (shard, block): rows first, then the anchors that visit them."""
    held: list[pa.RecordBatch] = []
    shard, run, open_ = None, None, False
    for batch in batches:
        key = np.stack([batch[k].to_numpy().astype(np.int64) for k in ("shard", "block", "kind")])
        ends = np.append(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1, batch.num_rows)
        begin = 0
        for end in ends.tolist():
            part = batch.slice(begin, end - begin)
            here, kind = (int(key[0, begin]), int(key[1, begin])), key[2, begin]
            begin = end
            if here != run:
                held, shard, run, open_ = [], None, here, True
            if kind == 0:
                held.append(part)
                continue
            if open_:
                shard, held, open_ = Shard(pa.Table.from_batches(held), width, most) if held else None, [], False
            if shard is None:
                continue
            for i in range(0, part.num_rows, 256):
                found = search(shard, part.slice(i, 256), width)
                if len(found[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], [x.split()[0] for x in _FOUND.split(", ")])


def _numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def _all_positives(count: int):
    def search(shard: Shard, anchors: pa.RecordBatch, width: int) -> list:
        own, ids, label = (_numbers(anchors[n]) for n in ("row", "vec_id", "label"))
        n = len(own)
        of, score, vec_id, row = shard.best(count, True, _matrix(anchors["vector"], width), label, own, np.arange(n), np.full(n, -np.inf), np.full(n, np.inf))
        none = pa.nulls(len(of), pa.int64())
        return [own[of], ids[of], none, none, none, score, vec_id, row]

    return search


def _all_negatives(count: int, low: int, high: int):
    def search(shard: Shard, anchors: pa.RecordBatch, width: int) -> list:
        own, ids, label = (_numbers(anchors[n]) for n in ("row", "vec_id", "label"))
        asked = [(k, p["row"], p["vec_id"], p["score"], *window(p["score"], low, high)) for k, wanted in enumerate(anchors["wanted"].to_pylist()) for p in wanted]
        of, positive, positive_id, positive_score, first, last = np.array([x for x in asked if x[4] <= x[5]], np.int64).reshape(-1, 6).T
        at, score, vec_id, row = shard.best(count, False, _matrix(anchors["vector"], width), label, own, of, first, last)
        return [own[of[at]], ids[of[at]], positive[at], positive_id[at], positive_score[at], score, vec_id, row]

    return search


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """The least and greatest whole score between ``low`` and ``high`` percent of a score."""
    return -(-low * score // 100), high * score // 100


class _Map:
    """Regions: the tree over the sample, what bounds each region's rows, and its shards."""

    def __init__(self, tree: Tree, bounds: tuple, first: list[int], splits: list[int]) -> None:
        self.tree, self.bounds, self.first, self.splits = tree, bounds, first, splits


def _dealt(rows: DataFrame, width: int, most: float, total: int, shard: int) -> tuple[DataFrame, _Map]:
    """(rows with their shard, the map of regions)."""
    regions = min(REGIONS, -(-total // shard))
    sample = rows.orderBy(F.xxhash64("row"), "row").limit(regions * SAMPLED).select("vector").collect()
    vectors = np.zeros((len(sample), width))
    for i, r in enumerate(sample):
        vectors[i, : len(r.vector)] = r.vector
    tree = Tree(vectors, most, SAMPLED if regions > 1 else len(sample))

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf, away = tree.leaf_of(_matrix(batch["vector"], width))
            columns = [*batch.columns, pa.array(leaf.astype(np.int32)), pa.array(list(away), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "region", "away"])

    placed = written(rows.mapInArrow(run, f"{_ROW}, region int, away array<double>"), "regions")
    sizes = {r.region: r["count"] for r in placed.groupBy("region").count().collect()}  # a row for each region
    spread = placed.select("region", F.posexplode("away").alias("depth", "d")).where("NOT isnan(d)").groupBy("region", "depth").agg(F.min("d").alias("low"), F.max("d").alias("high"))
    seen = {(r.region, r.depth): (r.low, r.high) for r in spread.collect()}
    paths = [[(node, *seen.get((i, t), (np.inf, 0.0))) for t, (node, _, _) in enumerate(path)] for i, path in enumerate(tree._above)]
    splits = [-(-sizes.get(i, 0) // shard) for i in range(len(paths))]
    first = np.cumsum([0, *splits]).tolist()
    side = rows.sparkSession.createDataFrame([(i, first[i], splits[i]) for i in sizes], "region int, first long, splits long")  # one row for each region
    sharded = placed.join(F.broadcast(side), "region").withColumn("shard", F.col("first") + F.pmod(F.xxhash64("row"), "splits"))
    return sharded.select("shard", *[x.split()[0] for x in _ROW.split(", ")]), _Map(tree, tree.padded(paths), first, splits)


def _visiting(anchors: DataFrame, where: _Map, width: int, choose, more: str) -> DataFrame:
    """A row for each anchor and shard that it visits; ``choose`` picks regions from (batch, k, least, greatest)."""
    schema = f"{_ROW}, {more}shard long"

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 512) for b in batches for i in range(0, b.num_rows, 512)):
            least, greatest = where.tree.score_bounds(_matrix(batch["vector"], width), where.bounds)
            rows, shards = [], []
            for k in range(batch.num_rows):
                for region in choose(batch, k, least[k], greatest[k]):
                    own = range(where.first[region], where.first[region] + where.splits[region])
                    rows += [k] * len(own)
                    shards += own
            out = batch.take(pa.array(rows, pa.int64()))
            names = [x.split()[0] for x in _ROW.split(", ")] + (["wanted"] if more else [])
            yield pa.RecordBatch.from_arrays([*(out[n] for n in names), pa.array(shards, pa.int64())], [*names, "shard"])

    return anchors.mapInArrow(run, schema)


def _home(batch: pa.RecordBatch, k: int, least: np.ndarray, greatest: np.ndarray) -> list[int]:
    return [int(greatest.argmax())]


def _as_near(count: int):
    def choose(batch: pa.RecordBatch, k: int, least: np.ndarray, greatest: np.ndarray) -> list[int]:
        scores = batch["scores"][k].as_py() or []
        bound = min(scores) if len(scores) >= count else -np.inf
        return [i for i in np.flatnonzero(greatest >= bound).tolist() if i != int(greatest.argmax())]

    return choose


def _in_windows(low: int, high: int):
    def choose(batch: pa.RecordBatch, k: int, least: np.ndarray, greatest: np.ndarray) -> list[int]:
        meets = np.zeros(len(least), bool)
        for p in batch["wanted"][k].as_py():
            first, last = window(p["score"], low, high)
            if first <= last:
                meets |= (greatest >= first) & (least <= last)
        return np.flatnonzero(meets).tolist()

    return choose


_WANTED = "wanted array<struct<row: long, vec_id: long, score: long>>"


def _search(sharded: DataFrame, visits: DataFrame, blocks: int, tasks: int, width: int, most: float, search) -> DataFrame:
    blank = F.lit(None).cast(_WANTED.split(" ", 1)[1].replace(": ", ":"))
    rows = sharded.select("shard", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(0).alias("kind"), *[x.split()[0] for x in _ROW.split(", ")], blank.alias("wanted"))
    block = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block")
    comers = visits.select("shard", block, F.lit(1).alias("kind"), *[x.split()[0] for x in _ROW.split(", ")], F.col("wanted") if "wanted" in visits.columns else blank.alias("wanted"))
    met = rows.unionByName(comers).repartition(tasks, "shard", "block").sortWithinPartitions("shard", "block", "kind", "row")

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _searched(batches, width, most, search)

    return met.mapInArrow(run, _FOUND)


def _first(found: DataFrame, group: list[str], k: int) -> DataFrame:
    """The first k of each group by score, then id, with their rank; a limit in each task comes before the shuffle."""
    order = Window.partitionBy(*group).orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def usable(rows: DataFrame, vector: str, label: Column | None = None, component: Column | None = None) -> DataFrame:
    """(row, vec_id, label, vector) of the rows that take part; ``component`` turns ``x``, a component as double, into a whole number."""
    x = F.col(f"`{vector}`")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")))
    good = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & finite)
    whole = (lambda v: v.cast("long")) if component is None else component
    named = F.col("label") if label is None else label
    return good.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), named.cast("int").alias("label"), F.transform(x, whole).alias("vector"))


def hard_negatives(rows: DataFrame, every: int = 50, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW_PERCENT, high: int = HIGH_PERCENT, shard: int = SHARD) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of ``usable`` rows.

    Anchors are the rows whose id is divisible by ``every``. For each of an
    anchor's first ``positives`` other rows of its label come the first
    ``negatives`` rows of other labels that score from ``low`` to ``high`` percent of it.
    """
    held = written(rows, "vectors")
    norm = F.aggregate("vector", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))
    is_anchor = F.col("vec_id") % every == 0
    total, width, most, n = held.agg(F.count(F.lit(1)), F.max(F.size("vector")), F.max(norm), F.count_if(is_anchor)).first()
    columns = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not total or not n:
        return rows.sparkSession.createDataFrame([], columns)
    if most >= _EXACT:
        raise ValueError("squared norms of 2**53 or more don't give exact scores")
    width = max(1, width)
    sharded, where = _dealt(held, width, most, total, shard)
    sharded = written(sharded, "shards")
    anchors, blocks = sharded.where(is_anchor).drop("shard"), -(-n // ANCHORS)
    tasks = min(2048, max(1, where.first[-1] * blocks))
    search = lambda visits, f: written(_search(sharded, visits, blocks, tasks, width, most, f), "found")
    near = search(_visiting(anchors, where, width, _home, ""), _all_positives(positives))
    scores = _first(near, ["anchor"], positives).groupBy("anchor").agg(F.collect_list("score").alias("scores"))
    again = anchors.join(scores.withColumnRenamed("anchor", "row"), "row", "left")
    far = search(_visiting(again, where, width, _as_near(positives), ""), _all_positives(positives))
    chosen = _first(near.union(far), ["anchor"], positives)
    wanted = chosen.groupBy(F.col("anchor").alias("row")).agg(F.collect_list(F.struct("row", "vec_id", "score")).alias("wanted"))
    met = search(_visiting(anchors.join(wanted, "row"), where, width, _in_windows(low, high), f"{_WANTED}, "), _all_negatives(negatives, low, high))
    return _first(met, ["anchor", "positive"], negatives).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    label = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    rows = usable(table(spark, sf_dir, "embeddings"), "embedding", label, lambda v: F.floor(v.cast("double") * 256))
    return hard_negatives(rows)


QUERIES = {"op12_hard_negatives": op12_hard_negatives}
ORACLES = {
    "op12_hard_negatives": """WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS alike, b.vec_id, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score FROM usable a JOIN usable b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id) WHERE NOT alike AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 3"""
}
