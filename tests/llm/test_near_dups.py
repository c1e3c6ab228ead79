import random

import numpy as np
import pytest

from brooklet.llm import near_dups as nd


def brute(rows, size, percent=80):
    """component of each id, by comparing all pairs."""
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        k = min(size, len(w))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if w else set()
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in sets}


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def corpus(seed, groups=6, size=8, words=60):
    rng, rows = random.Random(seed), []
    vocabulary = [f"w{k}" for k in range(400)]
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(words)]
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randrange(0, 6)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rows.append(" ".join(w))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize(("seed", "size"), [(1, 4), (2, 5)])
def test_equals_brute_force(spark, docs, seed, size):
    rows = corpus(seed)
    assert got(nd.near_duplicates(docs(rows), shingle=size)) == brute(rows, size)


def test_recall_over_ten_thousand_documents(spark, docs):
    """Groups around the threshold: every link of full sets is found, in effect (components), and no other."""
    rows = corpus(11, groups=1250, size=8, words=60)
    rng = random.Random(12)
    rows = [(i, " ".join(w if rng.random() > 0.01 else f"y{rng.randrange(10**6)}" for w in t.split())) for i, t in rows]
    sets = {i: {tuple(w[k : k + 4]) for k in range(57)} for i, t in rows for w in [t.split()]}
    holders = {}
    for i, x in sets.items():
        for g in x:
            holders.setdefault(g, []).append(i)
    pairs = {(a, b) for held in holders.values() for a in held for b in held if a < b}
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    linked = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for a, b in linked:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    assert len(rows) == 10_000 and len(linked) > 1500
    out = {r.doc_id: r.component_id for r in nd.near_duplicates(docs(rows), shingle=4).collect()}
    assert out == {i: root(i) for i in sets}


def test_families_of_many_blocks(spark, docs, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 3)
    rows = corpus(5, groups=2, size=20)
    assert got(nd.near_duplicates(docs(rows), shingle=4)) == brute(rows, 4)


def test_ids_of_several_texts(spark, docs):
    a, b = " ".join(f"a{k}" for k in range(40)), " ".join(f"b{k}" for k in range(40))
    rows = [(5, a), (5, b), (6, a + " x"), (7, b + " x"), (1, b + " y"), (9, "z z z z")]
    out = {r.doc_id: r.component_id for r in nd.near_duplicates(docs(rows), shingle=4).collect()}
    assert out == {1: 1, 5: 1, 6: 1, 7: 1, 9: 9}


def test_edge_cases(spark, docs):
    long = " ".join(f"x{k}" for k in range(30_000))
    rows = [(1, None), (2, ""), (3, "  \n\t "), (4, "one two"), (5, "ONE two"), (6, "one"), (7, long), (8, long + " tail"), (9, "a b c d e f"), (10, "a b c d e f")]
    assert got(nd.near_duplicates(docs(rows, extra=["key", "band", "family", "component"]), shingle=4)) == brute(rows, 4)
    assert nd.near_duplicates(docs([]), shingle=4).count() == 0


def test_repeated_and_null_ids(spark, docs):
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "a b c d e f g"), (None, "a b c d e f g"), (3, "q r s t u v")]
    result = {(r.doc_id, r.component_id, r.kept) for r in nd.near_duplicates(docs(rows), shingle=4).collect()}
    assert result == {(1, 1, True), (2, 1, False), (None, None, True), (3, 3, True)}
    kept = sorted((r.doc_id is not None, r.doc_id or 0) for r in nd.kept_documents(docs(rows, extra=["__gone", "__again", "lost", "twice", "Place", "a.b"])).collect())
    assert kept == [(False, 0), (True, 1), (True, 3)]


def test_rows_of_one_id_leave_the_first(spark, docs):
    rows = [(1, "b " * 9), (1, "a " * 9), (1, "a " * 9), (2, "c d e f g")]
    kept = nd.kept_documents(docs(rows)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(1, "a " * 9), (2, "c d e f g")]
    assert nd.kept_documents(docs([], extra=["lost"])).count() == 0


def test_blocks_of_a_family_find_what_one_block_does(spark, monkeypatch):
    reps = spark.createDataFrame([(i, 5, [7, i]) for i in range(10)], "doc_id bigint, n_shingles bigint, bands array<bigint>")
    whole = {(r.family, r.low, r.high, r.side, r.id) for r in nd._families(reps).collect()}
    assert whole == {(0, 0, 0, 3, i) for i in range(10)}
    met = {}
    for r in nd._families(reps, block=3).collect():
        met.setdefault((r.low, r.high), []).append((r.id, r.side))
    pairs = {(a, b) for rows in met.values() for a, x in rows for b, y in rows if a < b and x | y == 3}
    assert pairs == {(a, b) for a in range(10) for b in range(10) if a < b}


def test_links_without_a_center():
    # 0 is unlike the others, which are alike.
    sets = [np.arange(0, 100, dtype=np.uint64) + 1000] + [np.concatenate([np.arange(90), [200 + k]]).astype(np.uint64) for k in range(4)]
    coded = (nd.sketch(sets) & np.uint64(0xFF)).astype(np.uint8)
    assert nd.hopeful(coded, np.array([len(x) for x in sets]), np.full(5, 3), 80).tolist() == [False, True, True, True, True]
    assert not nd.hopeful(coded, np.array([len(x) for x in sets]), np.array([3, 1, 1, 1, 1]), 80).any()
    links = nd.family_links(sets, coded, np.full(5, 3), 80)
    joined = {x for pair in links for x in pair}
    assert joined == {1, 2, 3, 4} and len(links) == 3


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(3)
    a = np.unique(rng.integers(0, 1 << 60, 900).astype(np.uint64))
    b = np.concatenate([a[:800], rng.integers(0, 1 << 60, 100).astype(np.uint64)])
    s = nd.sketch([a, np.unique(b), a[:1], a[:3]])
    assert (s != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
    assert abs((s[0] == s[1]).mean() - 0.8) < 0.1


def test_components_of_chains(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(50)] + [(100, 101), (7, 7)], "a bigint, b bigint")
    got_ = {r.id: r.component for r in nd.components(links).collect()}
    assert got_ == {**{k: 0 for k in range(51)}, 100: 100, 101: 100}
