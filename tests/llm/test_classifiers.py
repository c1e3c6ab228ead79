import random
import re

import numpy as np
import pytest
import zstandard

from brooklet.llm import compression_quality as cq
from brooklet.llm import language as lang
from brooklet.llm import toxicity as tx
from brooklet.llm.common import bucket
from pyspark.sql import functions as F

LABELS = "doc_id bigint, quality int, toxic int"
SYLLABLES = {"en": ["the", "ing", "and", "wh", "sh"], "de": ["sch", "ung", "ei", "der", "ü"], "fr": ["eau", "eux", "qu", "é", "le"]}


def prose(rng, kind="en", words=60):
    return " ".join("".join(rng.choice(SYLLABLES[kind]) for _ in range(rng.randrange(1, 4))) for _ in range(words))


# Toxicity.


def toxic_corpus(n=600):
    rng, rows, labels = random.Random(1), [], []
    for k in range(n):
        words = prose(rng, words=40).split()
        bad = k % 6 == 0
        if bad:
            for _ in range(rng.choice([2, 4, 8])):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "SCUM!", "vequ" + rng.choice("abcdef"), "moron,"]))
        rows.append((k, " ".join(words)))
        labels.append((k, 1, int(bad)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark, docs):
    rows, labels = toxic_corpus()
    model = tx.fit_from(docs(rows), spark.createDataFrame(labels[:400], LABELS))
    out = {r.doc_id: r for r in tx.score(docs(rows, extra=["severity", "label"]), model).collect()}
    held = [(out[i], y) for i, _, y in labels[400:]]
    assert np.mean([r.toxic for r, y in held if y]) > 0.95 and np.mean([r.toxic for r, y in held if not y]) < 0.02
    assert np.all(np.diff(model.thresholds) > 0)
    assert all(0 <= r.severity <= tx.GRADES and 0 <= r.p_toxic <= 1 for r in out.values())
    mild, harsh = model.at_least(model.vectors(["idiot scum", "idiot scum moron idiot scum moron vequa vequb"])).sum(1)
    assert harsh > mild


def test_toxicity_edges(spark, docs):
    rows, labels = toxic_corpus(60)
    none = tx.fit_from(docs(rows), spark.createDataFrame([], LABELS))
    assert none is None and not any(r.toxic for r in tx.score(docs(rows), none).collect())
    assert tx.fit_from(docs(rows), spark.createDataFrame([(i, q, 1) for i, q, _ in labels], LABELS)) is None
    assert tx.fit_from(docs([]), spark.createDataFrame(labels, LABELS)) is None
    model = tx.fit_from(docs(rows), spark.createDataFrame(labels, LABELS))
    assert tx.score(docs([]), model).count() == 0
    out = tx.score(docs([(1, None), (2, ""), (3, "1234"), (3, "1234"), (None, "x " * 50_000)], extra=["half", "Grade", "a.b"]), model).collect()
    assert len(out) == 5 and not any(r.toxic for r in out)


def test_toxicity_reads_whole_texts_and_ignores_repeated_rows(spark, docs):
    rows, labels = toxic_corpus()
    rows = [(i, "plain words " * 30_000 + t if i % 60 == 0 else t) for i, t in rows]  # the insults stand behind 360,000 letters
    labels = spark.createDataFrame(labels, LABELS)
    once, again = tx.fit_from(docs(rows), labels), tx.fit_from(docs(rows + rows[:50]), labels.union(labels))
    assert once.index == again.index and np.allclose(once.weights, again.weights) and once.cut == again.cut
    out = {r.doc_id: r.toxic for r in tx.score(docs(rows), once).collect()}
    assert np.mean([out[i] for i in range(0, 600, 60)]) >= 0.9


def test_feature_counts_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(tx, "_HELD", 5)
    rng = random.Random(8)
    rows = [(" ".join(rng.choice(["Idiot", "idiots", "été", "ab", "x1y"]) for _ in range(rng.randrange(6))), rng.randrange(2), rng.randrange(2)) for _ in range(40)]
    want = {}
    for text, label, half in rows:
        for f in {f for w in re.findall(r"[^\W\d_]+", text.lower()) for f in [w + " ", *(w[:k] for k in range(3, 9) if k <= len(w))]}:
            want.setdefault(f, [0, 0, 0, 0])[2 * label + half] += 1
    counts = tx.feature_counts(spark.createDataFrame(rows, "text string, label int, half int"))
    assert {r.feature: [r.clean_0, r.clean_1, r.toxic_0, r.toxic_1] for r in counts.collect()} == want
    sizes = {p: sum(1 for _, label, half in rows if 2 * label + half == k) for k, p in enumerate(tx._PARTS)}

    def gain(f):
        a, b, p, n = want[f][3], want[f][1], sizes["toxic_1"], sizes["clean_1"]
        rate = (a + b) / (p + n)
        return sum(k * np.log(k / t / rate) for k, t in ((a, p), (b, n)) if k)

    able = [f for f, (_, b, _, a) in want.items() if a >= tx.SUPPORT and (a + 0.5) / (sizes["toxic_1"] + 1) > tx.RATIO * (b + 0.5) / (sizes["clean_1"] + 1)]
    assert tx.selected(counts, sizes, [1]) == sorted(able, key=lambda f: (-round(gain(f), 9), f))


def test_ordinal_regression_finds_the_least_loss():
    """Against a plain search: no small move of any parameter lowers the penalised loss; equal rows are weighed right."""
    rng = np.random.default_rng(3)
    x = rng.integers(0, 3, (80, 2)).astype(float)
    grade = np.clip((x @ [1.0, 0.5] + rng.normal(size=80)).round().astype(int), 0, 3)
    x, grade = np.concatenate([x, x[:30]]), np.concatenate([grade, grade[:30]])

    def loss(w, t):
        above = np.concatenate([np.ones((len(x), 1)), 1 / (1 + np.exp(-((x @ w)[:, None] - t))), np.zeros((len(x), 1))], 1)
        return -np.log(above[np.arange(len(x)), grade] - above[np.arange(len(x)), grade + 1]).sum() + 0.15 * (w @ w)

    w, t = tx.fit_ordinal(x, grade, steps=3000)
    least = loss(w, t)
    for k in range(2):
        for step in (-0.05, 0.05):
            assert loss(w + step * np.eye(2)[k], t) > least - 1e-6
    for k in range(3):
        for step in (-0.05, 0.05):
            assert loss(w, t + step * np.eye(3)[k]) > least - 1e-6


def test_grades_and_cut():
    score, toxic = np.array([0.0, 1, 2, 3, 9, 9]), np.array([0, 1, 1, 1, 0, 1])
    assert tx.graded(score, toxic).tolist() == [0, 1, 1, 2, 0, 3]
    assert tx.calibrated(np.array([0.1, 0.2, 0.6, 0.8]), np.array([0, 0, 1, 1])) == pytest.approx(0.4)
    assert tx.calibrated(np.array([0.5, 0.5, 0.9]), np.array([0, 1, 1])) == pytest.approx(0.7)


# Quality by compression.


def quality_corpus(n=600):
    rng = random.Random(2)
    rows, labels = [], []
    for k in range(n):
        good = k % 4 != 0
        words = prose(rng, words=80).split()
        rows.append((k, " ".join(words if good else [w.upper() + "%%%" for w in words])))
        labels.append((k, int(good), 0))
    return rows, labels


def test_compression_on_held_out_rows(spark, docs, tables):
    rows, labels = quality_corpus()
    folder = tables(documents=docs(rows), labels=spark.createDataFrame(labels, LABELS))
    out = cq.op10_quality_classifier(spark, folder).collect()
    truth = {i: q for i, q, _ in labels}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    assert np.mean([r.predicted == truth[r.doc_id] for r in out if r.held_out]) > 0.97
    crc = {r.doc_id: r.b for r in docs(rows).select("doc_id", bucket(F.col("doc_id"), 3).alias("b")).collect()}
    assert all(r.held_out == (crc[r.doc_id] == 1) for r in out)


def brute_score(model, text):
    """Both compressions of every block, by the library's plain interface."""
    sizes = []
    for content in (model.bad, model.good):
        d = zstandard.ZstdCompressionDict(content)
        c = zstandard.ZstdCompressor(level=cq.LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
        sizes.append(sum(len(c.compress(text[i : i + cq.PIECE])) for i in range(0, len(text), cq.PIECE)))
    d = (sizes[0] - sizes[1]) / len(text) if text else 0.0
    return 1 / (1 + np.exp(-(model.slope * (d - model.centre) / model.scale + model.offset)))


def test_compression_scores_equal_brute_force(spark, docs):
    rows, labels = quality_corpus(200)
    model = cq.fit_from(docs(rows), spark.createDataFrame(labels, LABELS))
    some = [*rows[:20], (900, None), (901, ""), (902, "x"), (903, rows[4][1] + rows[5][1] * 300), (903, rows[4][1]), (904, rows[4][1]), (None, "é " * 60_000)]
    out = cq.score(docs(some, extra=["score", "label", "order", "a.b"]), model, F.lit(False)).collect()
    got = sorted((str(r.doc_id), round(r.score, 9)) for r in out)
    assert got == sorted((str(i), round(float(brute_score(model, (t or "").encode())), 9)) for i, t in some)


def test_compression_learns_from_whole_texts(spark, docs, monkeypatch):
    rows, labels = quality_corpus(120)
    plain = "the same beginning of every page " * 200  # longer than the prefix of any sample
    model = cq.fit_from(docs([(i, plain + t * 40) for i, t in rows]), spark.createDataFrame(labels, LABELS))
    out = {r.doc_id: r.predicted for r in cq.score(docs(rows), model, F.lit(False)).collect()}
    assert np.mean([out[i] == q for i, q, _ in labels]) > 0.97
    monkeypatch.setattr(cq, "DICTIONARY", 1024)  # all texts are longer: the shortest of each class trains
    assert isinstance(cq.fit_from(docs([(i, t * 9) for i, t in rows]), spark.createDataFrame(labels, LABELS)), cq.Model)


def test_compression_edges(spark, docs):
    rows, labels = quality_corpus(80)
    labelled = spark.createDataFrame(labels, LABELS)
    once, again = cq.fit_from(docs(rows), labelled), cq.fit_from(docs(rows + rows[:9]), labelled.union(labelled))
    assert once == again
    assert cq.score(docs([]), once, F.lit(False)).count() == 0
    of = lambda some, kinds: cq.fit_from(docs(some), spark.createDataFrame([(i, q, 0) for i, q in kinds], LABELS))
    assert of([], []) == 0.5 and of([(1, "a"), (2, "b")], [(1, 1), (2, 1)]) == 1.0 and of([(1, "a"), (2, None)], [(1, 0), (2, 0)]) == 0.0
    assert {r.score for r in cq.score(docs([(1, "a")]), 0.5, F.lit(False)).collect()} == {0.5}


# Language.


def test_language_on_held_out_rows(spark, docs, tables):
    rng = random.Random(4)
    rows = [(k, prose(rng, kind), kind, "s") for k, kind in enumerate(["en", "de", "fr"] * 100)]
    folder = tables(documents=docs(rows))
    out = lang.op5_language_id(spark, folder).collect()
    truth = {i: kind for i, _, kind, _ in rows}
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in out if r.held_out]) > 0.97
    assert all(0 <= r.score <= 1 for r in out)


def test_language_edges(spark, docs, tables):
    rng = random.Random(5)
    rows = [(k, prose(rng, kind), kind, None) for k, kind in enumerate(["en", "fr"] * 30)]
    rows += [(100, None, "en"), (101, "", None), (102, "12 34 !", "fr"), (103, "x", None), (None, prose(rng, "fr", 20_000), None), (104, "日本", None)]
    out = {r.doc_id: r for r in lang.op5_language_id(spark, tables(documents=docs(rows, extra=["lang_pred"]))).collect()}
    assert [out[k].lang_pred for k in (100, 101, 102)] == ["und"] * 3 and out[None].lang_pred == "fr" and out[104].lang_pred in ("en", "fr")
    assert lang.identify(docs([]), None, F.lit(False)).count() == 0
    assert {r.lang_pred for r in lang.identify(docs([(1, "abc")]), None, F.lit(False)).collect()} == {"und"}


@pytest.mark.parametrize("text", ["abcabcabd", "aaaa", "abab" * 20, "xyz"])
def test_automaton_holds_every_substring(text):
    go = lang.automaton([ord(c) for c in text])

    def follows(word):
        state = 1
        for c in word:
            state = go[state].get(ord(c), 0)
            if not state:
                return False
        return True

    assert all(follows(text[i:j]) for i in range(len(text)) for j in range(i, len(text) + 1))
    assert not follows(text + "q") and not follows("q")


def test_moves_share_no_cell_and_states_no_place():
    """Every move is found at its cell and no other; the cells are hardly more than the moves, for any number of languages."""
    rng = random.Random(9)
    width, begin, found = 30, 1, {}
    for words in (["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(1, 9))) for _ in range(n)] for n in (1, 7, 400, 400)):
        go = lang.automaton([ord(c) - 95 for c in "`".join(words)])
        place, end = lang.placed(go, width, begin)
        own = [p for p, row in zip(place, go, strict=True) if row]
        assert len(set(own)) == len(own) and all(begin <= p < end for p in own) and all(not p for p, row in zip(place, go, strict=True) if not row)
        cells = [p + s for p, row in zip(place, go, strict=True) for s in row]
        assert len(set(cells)) == len(cells) and not found.keys() & set(cells)
        found |= dict.fromkeys(cells)
        assert end - begin <= 1.1 * len(cells) + 8 * width + lang.LOOK_BACK
        begin = end + width


def test_many_languages_make_a_small_model():
    rng = random.Random(10)
    words = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 8))) for _ in range(120))
    letters = {f"l{k:02}": "".join(rng.sample("abcdefghijklmnopqrstuvwxyz", 6)) for k in range(60)}
    texts = {name: words(x) for name, x in letters.items()}
    model = lang.fit({name: [t] for name, t in texts.items()})
    assert len(model.moves) < 3.2 * sum(map(len, texts.values())) + 60 * (8 * model.width + lang.LOOK_BACK)
    assert np.mean([lang.predict(model, [words(x)])[0][0] == name for name, x in letters.items()]) > 0.9


@pytest.mark.parametrize("lanes", [1, 3, 1000])
def test_phrases_equal_brute_force(monkeypatch, lanes):
    """Whole texts of many lengths, whether they go in lanes, byte by byte, or both."""
    monkeypatch.setattr(lang, "LANES", lanes)
    monkeypatch.setattr(lang, "STEPS", 16)
    rng = random.Random(lanes)
    bases = {"a": "the cat sat on the mat", "b": "dog house and the dog"}
    model = lang.fit({name: [t] for name, t in bases.items()})
    texts = ["the dog", "x", "zzz", "cat " * 200] + ["".join(rng.choice("thecadogs zé") for _ in range(rng.choice([1, 16, 17, 60, 300]))) for _ in range(30)]
    found = lang.phrases(model, [model.symbols[np.frombuffer(t.encode(), np.uint8)] for t in texts])
    assert found.tolist() == [[brute_phrases(base, t, model) for base in bases.values()] for t in texts]
    costs = [[n * w for n, w in zip(row, model.weights, strict=True)] for row in found.tolist()]
    assert [x for x, _ in lang.predict(model, texts)] == [model.names[int(np.argmin(c))] if t.strip() else "und" for t, c in zip(texts, costs, strict=True)]


def test_only_letters_make_a_language():
    model = lang.fit({"a": ["the cat"], "b": ["dog house"]})
    assert lang.predict(model, ["½", "²", "Ⅷ", "①", "12 !", "", None, "_"]) == [("und", 0.0)] * 8
    assert all(x in "ab" for x, _ in lang.predict(model, ["ª", "日", "ʰ"]))


def test_languages_tie_by_name():
    model = lang.fit({"b": ["same text"], "a": ["same text"]})
    assert lang.predict(model, ["same"]) == [("a", 0.5)]


def test_learning_takes_whole_texts():
    assert lang.chosen(["aaa", "b" * 9, "cc"], 5) == ["aaa", "cc"] and lang.chosen(["b" * 9, "c" * 8], 5) == ["b" * 9] and lang.chosen([], 5) == []


def test_a_language_of_long_and_of_repeated_rows(spark, docs, tables, monkeypatch):
    rng = random.Random(6)
    rows = [(k, prose(rng, "en"), "en") for k in range(40)] + [(k, prose(rng, "de", 20_000), "de") for k in range(100, 104)] + [(7, prose(rng, "fr"), "fr")] * 30
    monkeypatch.setattr(lang, "LEARN_BYTES", 2000)
    out = lang.op5_language_id(spark, tables(documents=docs(rows, extra=["part", "place", "most", "Score"]))).collect()
    assert len(out) == len(rows) and {r.lang_pred for r in out if r.doc_id >= 100} == {"de"} and len({(r.lang_pred, r.score) for r in out if r.doc_id == 7}) <= 2


def brute_phrases(base, text, model):
    code = lambda t: bytes(model.symbols[np.frombuffer(t.encode(), np.uint8)])
    base, text, n, at = code(base), code(text), 0, 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in base and text[at : at + 1] in base:
            size += 1
        n, at = n + 1, at + size
    return n
