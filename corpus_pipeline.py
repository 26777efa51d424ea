"""Corpus pipeline over ``documents``: five stages, each one of the
training-data operators; a stage's result is written and read again as the
next one's input.

Each stage judges its own input, drops or repeats rows by its operator's
decisions and, but for the last, returns the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plyspark.llm.common import staged
from plyspark.llm.exact_dedup import drop_copies
from plyspark.llm.jaccard_join import keep_one_of_each
from plyspark.llm.mixing import mixed_documents
from plyspark.llm.packing import default_tokenizer, pack
from plyspark.llm.toxicity import THRESHOLD, score_texts, train

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose toxicity score reaches the threshold. The model
    learns from ``labels`` of this input."""
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score_texts(docs.select(*COLUMNS), model, keep_text=True)
    return scored.where(F.col("score") < THRESHOLD).select(*COLUMNS)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest ``doc_id`` stays."""
    return drop_copies(docs.select(*COLUMNS))


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest
    ``doc_id`` stays."""
    return keep_one_of_each(docs.select(*COLUMNS))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixed_documents(docs.select(*COLUMNS))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences, without their ids."""
    return pack(docs.select(*COLUMNS), default_tokenizer()).drop("ids")


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("jaccard_join", jaccard_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: The classifier and the tokenizer can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = staged(docs, f"pipeline-{name}")
    return docs
