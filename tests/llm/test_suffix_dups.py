import hashlib
import random

import numpy as np
import pytest

from brooklet.llm import suffix_dups as sd


def brute(rows, keep, length=sd.LENGTH):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = {}
    for i, b in texts:
        for p in range(len(b) - length + 1):
            seen[b[p : p + length]] = seen.get(b[p : p + length], 0) + 1
    out, first = [], set()
    for i, b in texts:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            hit = seen[w] > 1 if keep == "none" else w in first
            first.add(w)
            if hit:
                gone[p : p + length] = b"\1" * length
        spans = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 9)))
    passages = [" ".join(word() for _ in range(n)) for n in (20, 45, 60, 90)]
    rows = []
    for i in range(40):
        parts = [" ".join(word() for _ in range(rng.randrange(5, 60)))]
        for _ in range(rng.randrange(0, 4)):
            p = rng.choice(passages)
            cut = rng.randrange(0, max(1, len(p) - 205))
            parts += [p[cut:], " ".join(word() for _ in range(rng.randrange(0, 30)))]
        rows.append((i, " ".join(parts)))
    return rows + [(40, rows[3][1]), (41, rows[3][1][50:])]


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, docs, keep, seed):
    rows = corpus(seed)
    assert got(sd.removal_report(docs(rows), keep)) == brute(rows, keep)


@pytest.mark.parametrize("keep", ["none", "first"])
def test_edge_cases(spark, docs, keep):
    run = "ab" * 400
    rows = [(1, None), (2, ""), (3, "x" * 199), (4, "x" * 199), (5, "y" * 200), (6, "y" * 200), (7, "z" * 1000), (8, run), (9, run[1:]), (10, "é" * 150), (11, "q" + "é" * 150)]
    assert got(sd.removal_report(docs(rows, extra=["key", "id", "mark", "lows", "h"]), keep)) == brute(rows, keep)
    assert sd.removal_report(docs([]), keep).count() == 0


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("group", [1, 3, 12])
def test_hot_groups_give_the_same_spans(spark, docs, keep, group):
    rows = corpus(5)

    def covered(found):
        return {(r.id, r.one, r.two, p) for r in found for low, high in zip(r.lows, r.highs, strict=True) for p in range(max(low, 0), high)}

    assert covered(sd.repeated_spans(docs(rows), keep, group=group).collect()) == covered(sd.repeated_spans(docs(rows), keep).collect())


def anchored(seed, n=60, binary=False):
    """Contexts around one anchor string that share more or less to either side."""
    rng = random.Random(seed)
    some = lambda k: bytes(rng.choice(b"ab\0" if binary else b"abcdef") for _ in range(k))
    anchor, sides = some(sd.GRAM), [(some(136), some(136)) for _ in range(4)]
    contexts, left = [], []
    for _ in range(n):
        a, b = rng.choice(sides)[0], rng.choice(sides)[1]
        x, y = rng.randrange(137), rng.randrange(137)
        before = (some(rng.randrange(137)) + a[136 - x :])[-136:]
        contexts.append(before + anchor + (b[:y] + some(rng.randrange(137)))[:136])
        left.append(len(before))
    return contexts, left


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("seed", range(6))
def test_matched_starts_equal_brute_force(keep, seed):
    contexts, left = anchored(seed, binary=seed % 2 == 1)
    windows = {}
    for i, (c, x) in enumerate(zip(contexts, left, strict=True)):
        for start in range(max(0, x - 136), min(x, len(c) - sd.LENGTH) + 1):
            windows.setdefault((c[start : start + sd.LENGTH], x - start), []).append((i, start))
    want = {}
    for at in windows.values():
        for i, start in at[0 if keep == "none" else 1 :] if len(at) > 1 else []:
            want.setdefault(i, []).append(start)
    found = sd.matched_starts(contexts, np.array(left, np.int64), keep)
    assert {i: (low, high) for i, low, high in zip(*(x.tolist() for x in found), strict=True)} == {i: (min(s), max(s)) for i, s in want.items()}


@pytest.mark.parametrize("seed", range(8))
def test_previous_factors_equal_brute_force(seed):
    rng = random.Random(seed)
    text = "".join(rng.choice("ab") for _ in range(rng.randrange(2, 60)))
    order = sorted(range(len(text)), key=lambda i: text[i:])

    def shared(i, j):
        n = 0
        while max(i, j) + n < len(text) and text[i + n] == text[j + n]:
            n += 1
        return n

    common = np.array([shared(i, j) for i, j in zip(order, order[1:], strict=False)])
    got_ = sd.previous_factors(np.array(order), common)
    assert got_.tolist() == [max((shared(i, j) for j in range(i)), default=0) for i in order]
    assert sd.previous_factors(-np.array(order), common).tolist() == [max((shared(i, j) for j in range(i + 1, len(text))), default=0) for i in order]


def test_parts_cover_every_offset_once():
    bounds = [sd.part_bounds(k) for k in range(sd.PARTS)]
    assert bounds[0][0] == 0 and bounds[-1][1] == sd.LENGTH - sd.GRAM + 1 and all(a[1] == b[0] for a, b in zip(bounds, bounds[1:], strict=False))


@pytest.mark.parametrize("keep", ["none", "first"])
def test_a_string_in_every_document_and_a_very_long_text(spark, docs, keep):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    passage = " ".join(word() for _ in range(45))
    rows = [(i, word() + " " + passage + " " + word()) for i in range(300)] + [(300, " ".join(word() for _ in range(30_000)) + passage)]
    want = brute(rows, keep)
    assert got(sd.removal_report(docs(rows), keep)) == want
    spans = sd.repeated_spans(docs(rows), keep, group=50).collect()
    assert sum(len({p for low, high in zip(r.lows, r.highs, strict=True) for p in range(max(0, low), high)}) for r in spans) == sum(r[2] for r in want)


def test_repeated_rows(spark, docs):
    text = " ".join(f"w{k}" for k in range(100))
    none = {(r.doc_id, r.n_removed) for r in sd.removal_report(docs([(1, text), (1, text), (2, "other")]), "none").collect()}
    assert none == {(1, len(text)), (2, 0)}
    first = {(r.doc_id, r.n_removed) for r in sd.removal_report(docs([(1, text), (2, text), (None, text)]), "first").collect()}
    assert first == {(None, 0), (1, len(text)), (2, len(text))}


@pytest.mark.parametrize("group", [1, sd.GROUP])
@pytest.mark.parametrize("same", [1, None])
def test_repeated_rows_in_differing_contexts_keep_one_copy(spark, docs, same, group):
    """Rows that repeat id and text are one document; what they share with another stays in them."""
    rng = random.Random(11)
    some = lambda n, of: "".join(rng.choice(of) for _ in range(n))
    shared = some(260, "abcd")
    a, b = some(300, "efgh") + shared + some(300, "efgh"), some(340, "ijkl") + shared + some(260, "ijkl")
    rows = [(same, a), (same, a), (2, b)]
    want = {(same, a): a, (2, b): b.replace(shared, "")}
    spans = sd.repeated_spans(docs(rows), "first", group).collect()
    assert [r.id for r in spans] == [2]
    out = sd.deduplicated_documents(docs(rows)).collect()
    assert sorted(len(r.text) for r in out) == [600, 860, 860] and all(r.text in want.values() for r in out)
    report = {(r.doc_id, r.n_removed) for r in sd.removal_report(docs(rows), "none").collect()}
    assert report == {(same, 860), (2, 260)}


def test_rows_of_one_id_are_told_apart_by_128_bits(spark, docs):
    frame = sd._keyed(docs([(None, "a"), (None, "b")]))
    assert [f.dataType.simpleString() for f in frame.select("one", "two").schema] == ["bigint", "bigint"]
    assert frame.select("one").distinct().count() == frame.select("two").distinct().count() == 2


def test_documents_keep_their_columns(spark, docs):
    text = " ".join(f"w{k}" for k in range(100))
    out = sd.deduplicated_documents(docs([(1, text + " one"), (2, "two " + text), (3, None)], extra=["lows", "key"])).orderBy("doc_id").collect()
    assert [r.text for r in out] == [text + " one", "two ", None] and [r.n_chars for r in out] == [len(text) + 4, 4, None] and out[0].lows == "x"


def test_clashing_names(spark, docs):
    names = ["__id", "__mark", "__lows", "__highs", "owner", "hashed", "Lows", "highs", "id", "a.b"]
    text = " ".join(f"w{k}" for k in range(100))
    frame = docs([(1, text), (2, text)], extra=names)
    out = sd.deduplicated_documents(frame).orderBy("doc_id").collect()
    assert out[0].asDict().keys() == set(frame.columns) and [r.text for r in out] == [text, ""]
    assert sd.deduplicated_documents(docs([], extra=names)).count() == 0


def test_only_known_modes(spark, docs):
    with pytest.raises(ValueError):
        sd.repeated_spans(docs([]), "last")
