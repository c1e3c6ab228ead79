import random

import pytest

import corpus_pipeline
from brooklet.llm import bpe, mixing, near_dups, quality_rules, suffix_dups
from brooklet.llm.queries import ORACLES, QUERIES


def corpus(spark, docs, tables):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghijk") for _ in range(rng.randrange(3, 8)))
    passage = " ".join(word() for _ in range(70))
    rows, labels = [], []
    for k in range(120):
        text = " ".join(word() for _ in range(90))
        if k % 10 == 0:
            text += " " + passage
        if k % 7 == 0:
            text = " ".join(w.upper() + "***" for w in text.split())
        rows.append((k, text, "en", f"s{k % 3}"))
        labels.append((k, int(k % 7 != 0), 0))
    rows += [(200, rows[1][1], "en", "s1"), (201, rows[1][1] + " end", "en", "s2"), (202, None, None, None), (203, "", "en", "s0")]
    return tables(documents=docs(rows, extra=["own"]), labels=spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))


def test_stages_do_their_work(spark, docs, tables):
    folder = corpus(spark, docs, tables)
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, frame, folder)
        path = f"{folder}/stage-{len(seen)}"
        out.write.parquet(path)
        seen[name] = (frame, out, spark.read.parquet(path))
        frame = seen[name][2]
    names = list(seen)
    assert names == ["quality rules", "minhash near-dedup", "suffix-array dedup", "source mixing", "bpe"]
    for name in names[:-1]:
        assert seen[name][2].columns == seen[name][0].columns, name
    ids = lambda n: sorted(r.doc_id for r in seen[n][2].collect())
    quality = ids(names[0])
    assert 202 not in quality and 203 not in quality and sum(i % 7 == 0 for i in quality if i < 120) <= 2 and sum(i % 7 != 0 for i in quality if i < 120) >= 100
    assert not {200, 201} & set(ids(names[1])) and 1 in ids(names[1])
    texts = {r.doc_id: r.text for r in seen[names[2]][2].collect()}
    before = {r.doc_id: r.text for r in seen[names[1]][2].collect()}
    cut = {i for i in texts if texts[i] != before[i]}
    assert cut and cut <= {i for i in texts if i % 10 == 0} and min(i for i in texts if i % 10 == 0) not in cut
    copies = {r.doc_id: r.copies for r in mixing.mix(seen[names[2]][2]).collect() if r.copies}
    assert {i: ids(names[3]).count(i) for i in set(ids(names[3]))} == copies
    final = seen[names[4]][2].collect()
    codec = bpe.Codec(bpe.Vocabulary.read(bpe.default_vocabulary()), bpe.library_script())
    assert len(final) == len(ids(names[3])) and all(list(r.ids) == codec.encode(texts[r.doc_id]) for r in final)


def test_run_equals_the_stages(spark, docs, tables):
    folder = corpus(spark, docs, tables)
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    want = quality_rules.kept_documents(frame, spark.read.parquet(f"{folder}/labels.parquet"))
    want = bpe.encoded_documents(mixing.mixed_documents(suffix_dups.deduplicated_documents(near_dups.kept_documents(want), "first")))
    assert sorted(map(str, corpus_pipeline.run(spark, folder).collect())) == sorted(map(str, want.collect()))


NAMES = ["__id", "__mark", "__lows", "__gone", "__source", "__rate", "lows", "lost", "key", "rate", "copy", "Owner", "c0", "a.b"]


def stages_over(spark, folder):
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{folder}/stage-{k}"
        stage(spark, frame, folder).write.parquet(path)
        yield spark.read.parquet(path)
        frame = spark.read.parquet(path)


def test_columns_of_any_name(spark, docs, tables):
    rng = random.Random(3)
    text = " ".join(f"w{rng.randrange(9999)}" for _ in range(90))
    rows = [(1, text, "en", "a"), (1, text + " more", "en", "a"), (2, "other " + text[::-1], "en", None), (None, text.upper(), None, "b")]
    folder = tables(documents=docs(rows, extra=NAMES), labels=spark.createDataFrame([], "doc_id bigint, quality int, toxic int"))
    *kept, last = stages_over(spark, folder)
    assert all(set(NAMES) < set(frame.columns) for frame in kept) and all(r["Owner"] == "x" and r["a.b"] == "x" for frame in kept for r in frame.collect())
    assert last.count() == kept[-1].count() and corpus_pipeline.run(spark, folder).count() == last.count()


def test_empty_tables(spark, docs, tables):
    folder = tables(documents=docs([], extra=NAMES), labels=spark.createDataFrame([], "doc_id bigint, quality int, toxic int"))
    assert [frame.count() for frame in stages_over(spark, folder)] == [0] * 5
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_repeated_rows_and_long_texts(spark, docs, tables):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghijk") for _ in range(6))
    long = " ".join(word() for _ in range(40_000))
    rows = [(1, long, "en", "a")] * 3 + [(2, " ".join(word() for _ in range(80)), "en", "a")] + [(3, None, None, None)] * 2
    folder = tables(documents=docs(rows), labels=spark.createDataFrame([], "doc_id bigint, quality int, toxic int"))
    *kept, last = stages_over(spark, folder)
    assert [sorted(r.doc_id for r in frame.collect()) for frame in kept[:3]] == [[1, 1, 1, 2], [1, 2], [1, 2]]
    assert {r.doc_id for r in last.collect()} <= {1, 2}


def test_scratch_tables_go(spark, docs, tables):
    from brooklet.llm import common

    folder = corpus(spark, docs, tables)
    before = common.scratch_tables()
    corpus_pipeline.run(spark, folder).count()
    left = set(common.scratch_tables()) - set(before)
    assert len(left) <= 2  # the last stage's input
    common.drop_scratch(spark, keep=before)
    assert common.scratch_tables() == before


def test_a_cluster_needs_a_shared_folder():
    from brooklet.llm import common

    class Conf:
        def __init__(self, **held):
            self.held = held

        def get(self, name, default=None):
            return self.held.get(name.replace(".", "_"), default)

    class Session:
        conf = Conf(spark_master="spark://host:7077")

    with pytest.raises(ValueError):
        common.shared_folder(Session())
    Session.conf = Conf(spark_master="spark://host:7077", spark_checkpoint_dir="hdfs://x")
    assert common.shared_folder(Session()) == "hdfs://x"


def test_registry():
    import __spark_entry__ as entry

    assert {f"op{n}" for n in range(1, 11)} == {q.split("_")[0] for q in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_repeated_rows_of_a_null_id_keep_their_text(spark, docs):
    """Near-dedup keeps all rows of a null id; what they share with another document stays in them."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    passage = " ".join(word() for _ in range(45))
    a, b = (" ".join([*(word() for _ in range(90)), passage, *(word() for _ in range(90))]) for _ in range(2))
    kept = near_dups.kept_documents(docs([(None, a), (None, a), (2, b)]))
    out = suffix_dups.deduplicated_documents(kept, "first").collect()
    assert sorted(r.doc_id or 0 for r in out) == [0, 0, 2]
    assert all(r.text == a for r in out if r.doc_id is None) and all(passage not in r.text for r in out if r.doc_id == 2)
