import hashlib
import random

import numpy as np
import pytest

from brooklet.llm import fm_index


def brute(rows, window):
    """(doc_id, n_words, n_removed, kept_sha256) by the plain definition; a null id comes first."""
    order = lambda i: -(1 << 63) if i is None else i
    split = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, words in split:
        for k in range(len(words) - window + 1):
            w = tuple(words[k : k + window])
            first[w] = min(first.get(w, order(i)), order(i))
    out = []
    for i, words in split:
        gone = {k + j for k in range(len(words) - window + 1) if first[tuple(words[k : k + window])] < order(i) for j in range(window)}
        out.append((i, len(words), len(gone), hashlib.sha256(b" ".join(w for k, w in enumerate(words) if k not in gone)).hexdigest()))
    return sorted(map(str, out))


def corpus(seed, n=60, vocabulary=30):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(vocabulary)}"
    passages = [[word() for _ in range(rng.randrange(9, 60))] for _ in range(5)]
    phrase = [word() for _ in range(9)]
    rows = []
    for i in range(n):
        text = []
        for _ in range(rng.randrange(4)):
            text += [word() for _ in range(rng.randrange(30))]
            p = rng.choice([*passages, phrase, phrase])
            lo = rng.randrange(len(p) // 2)
            text += p[lo : rng.randrange(lo, len(p)) + 1]
        rows.append((rng.randrange(n) if i % 9 == 0 else i, " ".join(text)))
    return rows


ODD = [(None, None), (900, ""), (901, " \t\n "), (902, "é\x0b" * 40), (None, "z" * 9000), (903, "u " * 300), (904, "u " * 300), (904, "u " * 300), (903, "v " * 60)]


@pytest.mark.parametrize(("window", "shard", "varied"), [(12, 1 << 19, 4096), (12, 40, 4096), (12, 100, 2), (33, 1 << 19, 1), (8, 1, 3)])
def test_report_equals_brute_force(spark, docs, window, shard, varied):
    rows = corpus(window + shard) + ODD
    frame = docs(rows, extra=["words", "H", "first", "a.b"]).repartition(3)
    got = fm_index.removal_report(frame, window, shard=shard, varied=varied)
    assert sorted(map(str, map(tuple, got.collect()))) == brute(rows, window)


def test_index_finds_every_window():
    rng = np.random.default_rng(1)
    texts = [rng.integers(1, 4, rng.integers(1, 40)) for _ in range(50)]
    owner = rng.integers(0, 1000, 50)
    for window in (1, 2, 5, 7, 16):
        index = fm_index.FmIndex(texts, owner, window)
        held = {}
        for t, i in zip(texts, owner.tolist(), strict=True):
            for k in range(len(t) - window + 1):
                w = tuple(t[k : k + window].tolist())
                held[w] = min(held.get(w, i), i)
        for t, got in zip(texts, index.least_owners(texts), strict=True):
            assert got.tolist() == [held[tuple(t[k : k + window].tolist())] for k in range(len(t) - window + 1)]


def test_ranks_equal_counts():
    rng = np.random.default_rng(2)
    for kinds in (1, 2, 5, 300):
        data = rng.integers(0, kinds, 777)
        wavelet = fm_index.Wavelet(data, kinds)
        symbol, at = rng.integers(0, kinds, 200), rng.integers(0, 778, 200)
        assert wavelet.rank(symbol, at).tolist() == [int((data[:j] == c).sum()) for c, j in zip(symbol, at, strict=True)]


def test_documents_keep_their_columns(spark, docs):
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(1, f"own  words\n{passage} end"), (2, f"other\t{passage}"), (3, "x  y"), (4, None), (None, passage + " null")]
    frame = docs(rows, extra=["owner", "LOWS", "a.b"])
    got = {r.doc_id: r for r in fm_index.deduplicated_documents(frame).collect()}
    assert fm_index.deduplicated_documents(frame).columns == frame.columns
    assert {i: r.text for i, r in got.items()} == {1: "own words end", 2: "other", 3: "x  y", 4: None, None: passage + " null"}
    assert got[2].n_chars == 5 and got[3].n_chars == 4 and got[1]["a.b"] == "x"


def test_empty_table(spark, docs):
    assert fm_index.removal_report(docs([])).collect() == []
    with pytest.raises(ValueError, match="at least"):
        fm_index.repeated_spans(docs([]), 3)
