"""From raw documents to packed sequences: five stages, each written and read again by the next.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that its predecessor kept. All but the last
return the columns of ``docs``; the last returns the pieces of documents with their places in sequences. Rows with nulls, empty or repeated
texts are handled as the operators state; an empty table passes through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minekit.checks.views import table
from minekit.functions.storage import settle
from minekit.llm.decontamination import Decontamination
from minekit.llm.language import LanguageEvidence
from minekit.llm.neardup import NearDuplicates
from minekit.llm.packing import Packing
from minekit.llm.toxicity import Toxicity


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold; fitted on the labels of the documents at hand."""
    operator = Toxicity()
    return operator.accepted(docs, operator.fit(docs, table(spark, sf_dir, "labels")))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the corpus languages; declared language and source are the evidence beside the text."""
    operator = LanguageEvidence()
    model = operator.fit(docs.select("text", F.col("lang").alias("declared")))
    evidence = docs.select(
        "doc_id", "text", F.col("lang").alias("declared"), F.lit(None).cast("string").alias("suffix"), F.col("source").alias("host")
    )
    return operator.accepted(docs, evidence, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 % of its 5-word shingles; repeated rows count as copies."""
    return NearDuplicates(shingle=5, percent=80).deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return Decontamination().clean(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 2048 tokens."""
    return Packing(public_tokenizers.path("word_bpe_49k.json"), end_id=1, size=2048).run(docs)


STAGES = [
    ("toxicity", toxicity),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

# fitted models and edit distances have no SQL form; tests compare the stages with plain versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
