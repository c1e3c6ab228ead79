import random

import numpy as np
import pyarrow as pa
import pytest

from brooklet.llm import hard_negatives as hn
from pyspark.sql import functions as F

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, every=50, positives=5, negatives=3, low=50, high=95):
    """By the plain definition, over rows of (vec_id, whole numbers, label)."""
    out = []
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))  # noqa: B905, E731
    for k, (i, v, label) in enumerate(rows):
        if i % every:
            continue
        scored = sorted(((-dot(v, w), j, at, y) for at, (j, w, y) in enumerate(rows) if at != k))
        for s, j, _, _ in [x for x in scored if x[3] == label][:positives]:
            fits = [x for x in scored if x[3] != label and low * -s <= 100 * -x[0] <= high * -s]
            out += [(i, j, r + 1, x[1], -s, -x[0]) for r, x in enumerate(fits[:negatives])]
    return sorted(out)


def made(kind, n=400, width=6, seed=3):
    rng = random.Random(seed)
    centers = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(4)]
    rows = []
    for i in range(n):
        c = rng.choice(centers)
        v = [x + rng.gauss(0, 0.3) for x in c]
        if kind == "copies" and i % 3:
            v = centers[0]
        if kind == "few values":
            v = [rng.choice((-1.0, 0.0, 0.5)) for _ in range(width)]
        if kind == "unequal":
            v = v[: rng.randrange(width + 1)]
        rows.append((i, [float(np.float32(x)) for x in v], rng.randrange(3)))
    return rows


@pytest.mark.parametrize("kind", ["spread", "copies", "few values", "unequal"])
@pytest.mark.parametrize(("shard", "leaf"), [(8192, 128), (37, 4)])
def test_equals_brute_force(spark, monkeypatch, kind, shard, leaf):
    monkeypatch.setattr(hn, "LEAF", leaf)
    rows = made(kind)
    whole = [(i, [int(np.floor(256 * x)) for x in v], y) for i, v, y in rows]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    usable = hn.usable(frame, "embedding", component=lambda v: F.floor(v.cast("double") * 256))
    assert sorted(map(tuple, hn.hard_negatives(usable, every=20, shard=shard).collect())) == brute(whole, every=20)


def test_rows_that_take_no_part_and_repeats(spark):
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.75, 0.0], 2), (2, [0.75, 0.0], 2), (3, [0.6, 0.1], 2)]
    odd = [(4, None, 1), (5, [1.0, None], 1), (6, [float("nan"), 0.0], 1), (7, [float("inf"), 0.0], 1), (8, [1.0, 0.0], None), (None, [1.0, 0.0], 1)]
    frame = spark.createDataFrame(rows + odd, SCHEMA).withColumn("row", F.lit("x")).withColumn("shard", F.lit(1))
    usable = hn.usable(frame, "embedding", component=lambda v: F.floor(v.cast("double") * 256))
    whole = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v], y) for i, v, y in rows]
    got = sorted(map(tuple, hn.hard_negatives(usable).collect()))
    assert got == brute(whole) and {r[1] for r in got} == {0, 1}
    assert hn.hard_negatives(usable.where("false")).collect() == [] and hn.hard_negatives(usable.where("vec_id > 1")).collect() == []


def test_scores_that_are_no_longer_exact_are_an_error(spark):
    frame = hn.usable(spark.createDataFrame([(0, [3e9], 1)], SCHEMA), "embedding")
    with pytest.raises(ValueError, match="exact"):
        hn.hard_negatives(frame)


def test_a_visit_skips_leaves_and_regions():
    """Clustered rows: most leaves are never scored, and the bounds hold for every row."""
    rng = np.random.default_rng(5)
    centers = rng.normal(0, 500, (8, 16))
    vectors = np.floor(centers[rng.integers(0, 8, 4000)] + rng.normal(0, 20, (4000, 16)))
    most = float((vectors * vectors).sum(1).max())
    tree = hn.Tree(vectors, most, 64)
    anchors = vectors[:20]
    least, greatest = tree.score_bounds(anchors, tree.bounds)
    for i, (a, b) in enumerate(tree.leaves):
        scores = anchors @ vectors[tree.order[a:b]].T
        assert (scores >= least[:, [i]]).all() and (scores <= greatest[:, [i]]).all()
    best = np.sort(anchors @ vectors.T, axis=1)[:, -5]
    assert (greatest >= best[:, None]).mean() < 0.5
    leaf, _ = tree.leaf_of(vectors)
    where = np.empty(4000, int)
    for i, (a, b) in enumerate(tree.leaves):
        where[tree.order[a:b]] = i
    assert (leaf == where).mean() > 0.99  # equal distances may go either way


class Counted(np.ndarray):
    products = 0

    def __array_ufunc__(self, ufunc, method, *inputs, **more):
        Counted.products += ufunc is np.matmul
        return getattr(ufunc, method)(*[np.asarray(x) for x in inputs], **more)


def test_a_batch_of_anchors_scores_a_leaf_in_one_product():
    """Not a product for each anchor and leaf; rows without structure, so that most anchors visit most leaves."""
    rng = np.random.default_rng(5)
    vectors = np.floor(rng.normal(0, 30, (600, 24))).astype(np.int64)
    label = rng.integers(0, 3, 600).astype(np.int32)
    most = float((vectors * vectors).sum(1).max())
    rows = pa.table({"row": np.arange(600), "vec_id": np.arange(600), "label": label, "vector": pa.array(list(vectors))})
    shard = hn.Shard(rows, 24, most)
    shard._vectors, Counted.products = shard._vectors.view(Counted), 0
    found = hn._all_positives(5)(shard, rows.slice(0, 256).to_batches()[0], 24)
    assert Counted.products <= 2 * len(shard._tree.leaves)
    got = sorted(zip(found[0].tolist(), found[5].tolist(), found[6].tolist(), strict=True))
    want = []
    for i in range(256):
        scores = vectors @ vectors[i]
        alike = [j for j in range(600) if j != i and label[j] == label[i]]
        want += [(i, int(scores[j]), j) for j in sorted(alike, key=lambda j: (-scores[j], j))[:5]]
    assert got == sorted(want)


def test_windows():
    assert hn.window(99, 50, 95) == (50, 94) and hn.window(0, 50, 95) == (0, 0)
    low, high = hn.window(-10, 50, 95)
    assert low > high
