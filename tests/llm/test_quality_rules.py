import random
import re

import numpy as np
import pytest

from brooklet.llm import quality_rules as qr
from brooklet.llm.common import calibrated
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text)
    windows = {}
    for k in range(len(words) - 2):
        windows.setdefault(tuple(words[k : k + 3]), []).append(k)
    inside = {k + j for at in windows.values() if len(at) > 1 for k in at for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), sum(x in lines[:k] for k, x in enumerate(lines)), len(inside))


TEXTS = ["", " \n\t", "a", "a b", "a a a", "a a a a", "a b c a b c", "x\ny\nx\n \nx", "é ü # * $$ <b>", "one\x0btwo\x0cthree\x1cfour\x85five\xa0six\n\nsix", "w " * 500]


@pytest.mark.parametrize("text", TEXTS)
def test_statistics(text):
    assert qr.statistics(text.encode())[:5] == brute(text)


def test_random_statistics():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice(["a", "b", " ", "\n", "#", "é", "a b a "]) for _ in range(rng.randrange(60)))
        assert qr.statistics(text.encode())[:5] == brute(text), repr(text)


def corpus(n=400):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 9)))
    rows, labels = [], []
    for k in range(n):
        good = k % 5 != 0
        words = [word() for _ in range(80)]
        rows.append((k, " ".join(words if good else [w.upper() + rng.choice("$%*") * 3 for w in words])))
        labels.append((k, int(good), 0))
    return rows, labels


def test_forest_rejects_junk_and_keeps_the_rest(spark, docs):
    rows, labels = corpus()
    rows += [(1000, None), (1001, ""), (1002, "short text"), (1003, "same same same " * 40), (1004, rows[1][1]), (1004, rows[1][1])]
    out = qr.judge(docs(rows, extra=["label", "kept", "n_words"]), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).collect()
    assert len(out) == len(rows)
    for r in out:
        text = dict(rows)[r.doc_id] or ""
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    good = [r.kept for r in out if r.doc_id < 400 and r.doc_id % 5]
    assert np.mean(good) > 0.97 and np.mean([r.kept for r in out if r.doc_id < 400 and r.doc_id % 5 == 0]) < 0.1


def test_no_labels_and_no_rows(spark, docs):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    rows, labels = corpus(20)
    assert all(r.kept for r in qr.judge(docs(rows), none).collect())
    assert qr.judge(docs([]), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).count() == 0
    kept = qr.kept_documents(docs(rows + [(99, None)], extra=["label"]), none)
    assert kept.count() == 20 and kept.columns[-1] == "label"


def test_anomalies_have_short_paths():
    x = np.random.default_rng(1).normal(size=(500, 3))
    forest = qr.IsolationForest(x)
    assert forest.score(np.array([[9.0, 9, 9]]))[0] > forest.score(np.zeros((1, 3)))[0] + 0.15


def test_paths_equal_brute_force():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(300, 3)), np.zeros((20, 3)), np.ones((5, 3))])
    forest = qr.IsolationForest(x, trees=12, rows=64)

    def path(tree, row):
        f, cut, left, right, length = tree
        at = 0
        while f[at] >= 0:
            at = left[at] if row[f[at]] <= cut[at] else right[at]
        return length[at]

    def expected(n):
        return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n

    points = np.concatenate([x[:50], rng.normal(size=(50, 3)) * 9])
    want = [2 ** (-np.mean([path(t, row) for t in forest.trees]) / expected(64)) for row in points]
    assert np.allclose(forest.score(points), want)


def test_leaves_hold_the_rows_that_reach_them():
    """A leaf's length is its depth plus what a tree of its rows would add: the rows of a tree reproduce all leaves."""
    x = np.random.default_rng(5).normal(size=(64, 2))
    forest = qr.IsolationForest(x, trees=3, rows=64)
    for f, cut, left, right, length in forest.trees:
        reached = {}
        for row in x:
            at, depth = 0, 0
            while f[at] >= 0:
                at, depth = (left[at] if row[f[at]] <= cut[at] else right[at]), depth + 1
            reached.setdefault(at, []).append(depth)
        for at, depths in reached.items():
            assert length[at] == depths[0] + qr._mean_path(len(depths))


def test_labels_decide_which_statistics_serve():
    """A statistic that sets good rows apart is left out; the cut keeps the rows that grew no tree."""
    rng = np.random.default_rng(7)
    sample = []
    for k in range(800):
        good = k % 4 != 0
        n = int(rng.integers(60, 400))
        repeats = int(n * 0.45) if good and k % 9 == 1 else 0
        symbols = int(rng.integers(0, 5)) if good else 2 * n
        sample.append(((n, 5 * n + symbols, symbols, 0, repeats, n // 10, n // 5 + symbols), int(good)))
    model = qr.fit(sample)
    assert qr.RATIOS.index("symbols") in model.columns or qr.RATIOS.index("word length") in model.columns or qr.RATIOS.index("marks") in model.columns
    s, good = np.array([x for x, _ in sample]), np.array([q for _, q in sample]) == 1
    kept = model.score(s) < model.cut
    assert kept[good].mean() > 0.98 and kept[~good].mean() < 0.05
    assert qr.fit([]) is None and qr.fit(sample[:30]) is None
    assert qr.fit([x for x in sample if x[1]]) is not None


def test_very_long_texts_and_clashing_names(spark, docs):
    rows, labels = corpus(60)
    long = " ".join(f"w{k}" for k in range(60_000))
    out = {r.doc_id: r for r in qr.judge(docs([(1, long), (2, long + " w1 w2 w3"), (2, "a b c " * 30_000)]), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).collect()}
    assert out[1].n_words == 60_000 and out[1].n_repeat_words == 0
    frame = docs(rows, extra=["c0", "c1", "anomaly", "a.b", "n_words"])
    assert qr.kept_documents(frame, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).columns == frame.columns


def test_every_labelled_row_counts(spark):
    """The trees, the box and the cut come from all labelled rows: more than any bounded number of ids, whatever the order of their hashes."""
    n = 30_000
    bad, stats = "id % 300 = 7", "doc_id long, " + ", ".join(f"{c} long" for c in qr._FIELDS)
    symbols = f"if({bad}, 40 + id % 9, id % 4)"
    rows = spark.range(n).selectExpr("id AS doc_id", "100 + id % 50 AS n_words", f"500 + {symbols} AS word_chars", f"{symbols} AS n_symbols", "0L AS n_dup_lines", "0L AS n_repeat_words", "id % 11 AS n_upper", f"20 + {symbols} AS n_marks")
    labels = spark.range(n).selectExpr("id AS doc_id", f"int(NOT ({bad})) AS quality")
    seen = []
    count = qr._counted
    qr._counted = lambda rest, models: seen.append(count(rest, models)) or seen[-1]
    try:
        model = qr.fit_statistics(rows.to(spark.createDataFrame([], stats).schema), labels)
    finally:
        qr._counted = count
    half = rows.where(F.pmod(F.xxhash64(F.lit(qr.SEED), "doc_id"), F.lit(2)) != 0)
    assert seen[0][0].sum() == half.count() > 8192 and seen[0][0][:, 0].sum() == half.where("doc_id % 300 = 7").count()
    s = np.array([tuple(r)[1:] for r in rows.collect()])
    gone = model.score(s) >= model.cut
    assert gone[7::300].all() and gone.sum() == n // 300


def test_cuts_from_counts_equal_cuts_from_rows():
    rng = np.random.default_rng(3)
    for k in range(50):
        p, wanted = rng.integers(0, 12, 40) / 12, rng.integers(0, 2, 40) * (k != 0)
        up = np.append(np.unique(p), np.inf)
        gain = [(p[wanted == 1] >= u).sum() / max(1, wanted.sum()) - 10 * (p[wanted == 0] >= u).sum() / max(1, (1 - wanted).sum()) for u in up]
        best = int(np.argmax(np.round(gain, 9)))
        cut = calibrated(p, wanted)
        assert np.isclose(gain[best], (p[wanted == 1] >= cut).sum() / max(1, wanted.sum()) - 10 * (p[wanted == 0] >= cut).sum() / max(1, (1 - wanted).sum()))
