import hashlib
import random

from brooklet.llm import fingerprints as fp
from pyspark.sql import functions as F


def shingles(text, size=5):
    w = text.encode().split()
    k = min(size, len(w))
    return {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if w else set()


def likeness(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def check(spark, docs, rows, error=0.15):
    out = {r.doc_id: r for r in fp.fingerprints(docs(rows, extra=["key", "bucket", "stop", "next_text", "tie", "part", "before", "a.b"])).collect()}
    ordered = sorted(rows, key=lambda r: r[0])
    assert len(out) == len(rows)
    for k, (i, text) in enumerate(ordered):
        text, after = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        q = len(text) // 4
        edited = text[: len(text) - q] + after[:q]
        r = out[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(r.near_edited - likeness(text, edited)) <= error and abs(r.near_next - likeness(text, after)) <= error
        if len(shingles(text) | shingles(edited)) <= fp.K:
            assert abs(r.near_edited - likeness(text, edited)) < 1e-9
    return out


def test_random_documents(spark, docs, monkeypatch):
    monkeypatch.setattr(fp, "ROWS_PER_PART", 3)
    rng = random.Random(1)
    rows = [(k * 3, " ".join(rng.choice(["ab", "cd", "éf", "gh", "日本"]) + str(rng.randrange(9)) for _ in range(rng.randrange(0, 300)))) for k in range(40)]
    rng.shuffle(rows)
    check(spark, docs, rows)


def test_edge_cases(spark, docs):
    out = check(spark, docs, [(1, None), (2, ""), (3, "one two"), (4, "one two"), (5, "a b c d e f"), (6, " \t\n"), (7, "x" * 9999)])
    assert out[3].fingerprint == out[4].fingerprint and out[1].fingerprint == out[2].fingerprint == ""
    only = check(spark, docs, [(1, "a b c d e f g h")])
    assert only[1].near_next == 1.0
    assert fp.fingerprints(docs([])).count() == 0


def test_repeated_and_null_ids(spark, docs, monkeypatch):
    monkeypatch.setattr(fp, "ROWS_PER_PART", 1)
    out = fp.fingerprints(docs([(1, "aaaa"), (1, "bbbb"), (None, "cccc"), (2, "dddd"), (2, "dddd")])).collect()
    edited = lambda a, b: hashlib.sha256((a[:3] + b[:1]).encode()).hexdigest()
    one, two = ([("cccc", x), (x, y), (y, "dddd"), ("dddd", "dddd"), ("dddd", "cccc")] for x, y in (("aaaa", "bbbb"), ("bbbb", "aaaa")))
    assert sorted(r.edited_sha256 for r in out) in [sorted(edited(a, b) for a, b in want) for want in (one, two)]


def test_one_id_of_many_rows_is_cut_in_parts(spark, docs, monkeypatch):
    monkeypatch.setattr(fp, "ROWS_PER_PART", 4)
    rng = random.Random(4)
    rows = [(k if k % 3 else 7, f"{rng.random()} text {k}") for k in range(120)]
    led = {r.text: (r.doc_id, r.next_text) for r in fp.with_next(docs(rows).select("doc_id", "text"), ["text"]).collect()}
    text, walk = next(t for i, t in rows if i == 1), []
    for _ in rows:  # one walk over all rows, ids ascending
        walk.append((led[text][0], text))
        text = led[text][1]
    assert len(set(walk)) == 120 and text == walk[0][1] and [i for i, _ in walk] == sorted(i for i, _ in rows)
    ranges = fp.cut_points([7, 7, 7, 40, 80], 1, 119, 2)
    assert ranges == [(1, 6, 2), (7, 7, 6), (8, 39, 2), (40, 79, 2), (80, 119, 2)]


def test_parts_ascend_with_the_order(spark):
    keys = [(k, t) for k in [fp._NULL_ID, -5, 0, 1, 2, 900, 2**62] for t in (-(2**63), -3, 0, 2**63 - 1)]
    ranges = fp.cut_points([-5, 0, 0, 900], fp._NULL_ID, 2**62, 3)
    got = spark.createDataFrame(keys, "key bigint, tie bigint").select("key", "tie", fp._part(ranges, F.col("key"), F.col("tie")).alias("part")).orderBy("key", "tie").collect()
    assert [r.part for r in got] == sorted(r.part for r in got) and got[0].part == 0 and got[-1].part < sum(r[2] for r in ranges)


def test_columns_keep_their_values(spark, docs):
    led = fp.with_next(docs([(1, "a"), (2, "b")], extra=["key", "bucket", "part", "next_text"]), ["text"]).orderBy("doc_id").collect()
    assert [(r.key, r.bucket, r.part, r.next_text) for r in led] == [("x", "x", "x", "b"), ("x", "x", "x", "a")]


def test_sketches_merge_and_estimate(spark):
    words = [f"w{k}" for k in range(2000)]
    a, b = " ".join(words[:1500]), " ".join(words[500:2000])
    df = spark.createDataFrame([(a, b, a + " " + b)], "a string, b string, ab string")
    df = df.select(*[fp.sketch(F.col(c)).alias(c) for c in df.columns])
    row = df.select(
        fp.resemblance(F.col("a"), F.col("b")).alias("r"), fp.containment(F.col("a"), F.col("b")).alias("c"), fp.distinct_shingles(F.col("a")).alias("n"),
        fp.distinct_shingles(fp.merged(F.col("a"), F.col("b"))).alias("m"),
    ).first()
    assert abs(row.r - 0.5) < 0.15 and abs(row.c - 2 / 3) < 0.2 and abs(row.n - 1496) < 450 and abs(row.m - 1994) < 600


def test_no_python_in_the_plan(spark, docs):
    plan = fp.fingerprints(docs([(1, "a b c"), (2, "d")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
