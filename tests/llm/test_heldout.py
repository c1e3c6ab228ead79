import random

from brooklet.llm import heldout


def test_figures_over_a_small_corpus(spark, docs, tables):
    rng = random.Random(6)
    syllables = {"en": ["the", "ing", "and", "wh", "sh"], "de": ["sch", "ung", "ei", "der", "ü"]}
    rows, labels = [], []
    for k in range(500):
        lang = "de" if k % 3 == 0 else "en"
        words = ["".join(rng.choice(syllables[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(80)]
        toxic, good = k % 5 == 0, k % 4 != 0
        if toxic:
            words[::9] = [rng.choice(["idiot", "scum", "moron"]) for _ in words[::9]]
        rows.append((k, " ".join(words if good else [w.upper() + "***" for w in words]), lang, "s"))
        labels.append((k, int(good), int(toxic)))
    found = heldout.figures(spark, tables(documents=docs(rows), labels=spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")))
    assert found["op4_toxicity"]["recall"] > 0.9 and found["op4_toxicity"]["false_alarms"] < 0.05
    assert found["op9_quality_rules"]["recall"] > 0.9 and found["op9_quality_rules"]["false_alarms"] < 0.1
    assert found["op5_language_id"]["accuracy"] > 0.95 and found["op10_quality_classifier"]["accuracy"] > 0.95
    assert 0 < found["op4_toxicity"]["wanted"] + found["op4_toxicity"]["others"] < 200
