"""Held-out figures of the fitted operators: ``python -m brooklet.llm.heldout FOLDER`` prints one JSON line for each.

Operators 5 and 10 hold rows out by their contracts. Toxicity and the quality
forest, whose queries learn from all labels, learn here without the labels of
rows whose crc32(doc_id as text) mod 5 is 0 and are judged on those.
"""

from __future__ import annotations

import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.llm import compression_quality, language, quality_rules, toxicity
from brooklet.llm.common import bucket, table


def rates(rows: DataFrame, caught: str, wanted: str) -> dict[str, float | int]:
    """Counts and shares of two boolean columns."""
    r = rows.agg(
        F.count_if(wanted).alias("wanted"), F.count_if(F.expr(f"{wanted} AND {caught}")).alias("caught"),
        F.count_if(F.expr(f"NOT {wanted}")).alias("others"), F.count_if(F.expr(f"NOT {wanted} AND {caught}")).alias("alarms"),
    ).first()
    return {**r.asDict(), "recall": round(r["caught"] / max(1, r["wanted"]), 4), "false_alarms": round(r["alarms"] / max(1, r["others"]), 4)}


def figures(spark: SparkSession, folder: str) -> dict[str, dict[str, float | int]]:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held = bucket(F.col("doc_id"), 5) == 0
    known, asked = labels.where(~held), labels.where(held)
    out = {}
    scored = toxicity.score(docs, toxicity.fit_from(docs, known)).join(asked.select("doc_id", (F.col("toxic") == 1).alias("bad")).where("bad IS NOT NULL"), "doc_id")
    out["op4_toxicity"] = rates(scored, "toxic", "bad")
    judged = quality_rules.judge(docs, known).where("NOT base_failed").join(asked.select("doc_id", (F.col("quality") == 0).alias("bad")).where("bad IS NOT NULL"), "doc_id")
    out["op9_quality_rules"] = rates(judged, "NOT kept", "bad")
    found = language.op5_language_id(spark, folder).where("held_out").join(docs.select("doc_id", "lang").where("lang IS NOT NULL AND text IS NOT NULL"), "doc_id")
    right = found.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.expr("lang = lang_pred")).alias("right")).first()
    out["op5_language_id"] = {**right.asDict(), "accuracy": round(right["right"] / max(1, right["rows"]), 4)}
    told = compression_quality.op10_quality_classifier(spark, folder).where("held_out").join(labels.select("doc_id", "quality").where("quality IS NOT NULL"), "doc_id")
    right = told.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.expr("predicted = quality")).alias("right"), F.count_if(F.expr("quality = 0 AND predicted = 0")).alias("bad_caught"), F.count_if(F.expr("quality = 0")).alias("bad")).first()
    out["op10_quality_classifier"] = {**right.asDict(), "accuracy": round(right["right"] / max(1, right["rows"]), 4)}
    return out


if __name__ == "__main__":
    session = SparkSession.builder.appName("heldout").getOrCreate()
    for name, found in figures(session, sys.argv[1]).items():
        print(json.dumps({"query": name, "folder": sys.argv[1], **found}), flush=True)
