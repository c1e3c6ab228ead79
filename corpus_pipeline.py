"""The corpus pipeline: documents in, token ids out, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's documents. All but the last return the
columns of documents, and any other columns, whatever their names, untouched. An
empty table gives an empty result in every stage; texts are taken whole, however
long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from brooklet.llm import bpe, mixing, near_dups, quality_rules, suffix_dups
from brooklet.llm.common import bounded_batches, drop_scratch, scratch_tables, table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go: null and empty texts among them. Repeated rows stay or go together."""
    bounded_batches(spark)
    return quality_rules.kept_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one of the smallest id.

    Rows without words and rows of a null id stay. Of rows with one id the first
    by text, then by all columns, stays.
    """
    bounded_batches(spark)
    return near_dups.kept_documents(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each repeated string of 200 bytes the copy of the smallest (id, text hash, place) stays.

    Null texts stay null. Rows that repeat id and text count as one document; a
    null id comes before all others.
    """
    bounded_batches(spark)
    return suffix_dups.deduplicated_documents(docs, keep="first")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents enter as often as the mix takes them, copies side by side.

    Null texts have no words, null sources are one source; rows of one id share a draw.
    """
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and a digest of what they decode to; null counts as empty. Copies side by side are encoded once."""
    bounded_batches(spark)
    return bpe.encoded_documents(docs)


STAGES = [
    ("quality rules", quality),
    ("minhash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_strings),
    ("source mixing", mixture),
    ("bpe", tokens),
]

#: SQL can express neither the anomaly forest nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each but the last written in the shared folder and read again.

    What a stage wrote on its way goes with it, its input with the next one.
    """
    docs, standing = table(spark, sf_dir, "documents"), scratch_tables()
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline")
        drop_scratch(spark, keep=[*standing, docs.scratch_path])
    return STAGES[-1][1](spark, docs, sf_dir)
