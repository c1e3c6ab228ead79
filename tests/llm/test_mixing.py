from collections import Counter

import duckdb
import pytest

from brooklet.llm import mixing


def targets(sizes, weights=(3, 1, 2)):
    """Reshare the excess until no source is above twice its size."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, stopped = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in stopped]
        left = total - sum(stopped.values())
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] >= 2 * sizes[s]]
        if not over:
            return {**share, **stopped}
        stopped |= {s: 2 * sizes[s] for s in over}


CASES = [
    [(1, "a b c", None, "s1"), (2, "d e", None, "s2"), (3, None, None, "s2"), (4, "", None, None), (5, "x " * 100, None, "s3")],
    [(k, "w " * (k % 7 + 1), None, f"s{k % 5}") for k in range(60)] + [(100 + k, "w " * 50, None, "big") for k in range(40)],
    [(1, None, None, None)],
    [(1, "a b", None, "é"), (2, "a b", None, "z"), (3, "a", None, "")],
    [],
]


@pytest.mark.parametrize("rows", CASES)
def test_targets(spark, docs, rows):
    out = mixing.mix(docs(rows, extra=["size", "target", "rate"])).collect()
    assert len(out) == len(rows)
    sizes = Counter()
    for _, text, _, source in rows:
        sizes[source] += len((text or "").split())
    if rows:
        want = targets(dict(sizes))
        for r in out:
            assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
            assert 0 <= r.copies <= 2


@pytest.mark.parametrize("rows", CASES[:2])
def test_equals_sql(spark, docs, tables, rows):
    folder = tables(documents=docs(rows))
    c = duckdb.connect()
    c.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    want = sorted(map(tuple, c.sql(mixing.ORACLE).fetchall()))
    assert sorted(map(tuple, mixing.op8_mixing(spark, folder).collect())) == want


def test_taken_is_near_the_target_and_reruns_agree(spark, docs):
    rows = [(k, "w " * (k % 9 + 1), None, f"s{k % 4}") for k in range(4000)]
    a = sorted(map(tuple, mixing.mix(docs(rows)).collect()))
    assert a == sorted(map(tuple, mixing.mix(docs(rows).repartition(7)).collect()))
    taken, target = Counter(), {}
    for _, source, size, _, t, copies in a:
        taken[source] += size * copies
        target[source] = t
    for s, t in target.items():
        assert abs(taken[s] - t) < 0.1 * t


def test_documents_appear_as_often_as_the_mix_says(spark, docs):
    df = docs(CASES[1], extra=["__source", "__rate", "__copy", "key", "Rate", "copy", "a.b"])
    want = {r.doc_id: r.copies for r in mixing.mix(df).collect() if r.copies}
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns and Counter(r.doc_id for r in out.collect()) == want


def test_no_python_in_the_plan(spark, docs):
    plan = mixing.mix(docs(CASES[1]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_copies_stand_side_by_side(spark, docs):
    ids = [r.doc_id for r in mixing.mixed_documents(docs(CASES[1])).collect()]
    assert len(ids) > len(set(ids)) and len(set(ids)) == 1 + sum(a != b for a, b in zip(ids, ids[1:], strict=False))


def test_very_long_text_and_empty_table(spark, docs):
    out = mixing.mix(docs([(1, "w " * 200_000, None, "a"), (2, "x", None, "b")])).collect()
    assert {r.doc_id: r.size for r in out} == {1: 200_000, 2: 1}
    assert mixing.mixed_documents(docs([], extra=["key"])).count() == 0


def test_many_sources_are_numbered_by_ranges(spark, docs, monkeypatch):
    """Sizes that stop source after source, and more ranges than one."""
    from brooklet.operators import ranking

    monkeypatch.setattr(ranking, "ROWS_PER_RANGE", 7)
    monkeypatch.setattr(mixing, "global_positions", lambda df, orders: ranking.global_positions(df, orders, 7))
    rows = [(k, "w " * (2 ** (k % 9)), None, f"h{k:03d}") for k in range(60)] + [(100, "w w", None, None), (101, None, None, "empty")]
    out = mixing.mix(docs(rows)).collect()
    want = targets({r[3]: len((r[1] or "").split()) for r in rows})
    assert len(out) == 62 and all(r.target == pytest.approx(want[r.source]) for r in out)
