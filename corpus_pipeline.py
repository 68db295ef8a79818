"""Corpus pipeline: five operators of ``strata.llm`` one after the other.

Each stage takes (spark, docs, sf_dir) and works on every row that its
predecessor kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import jaccard, langid, mixing, packing, quality
from strata.llm.common import cut, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; those rejected go."""
    return langid.keep_identified(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ranking trained on ``labels`` accepts."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, similarity 0.8."""
    return jaccard.keep_one(docs, n=5, percent=80)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that each source meets its target."""
    return mixing.take(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document with its sequence and offset."""
    return packing.pack(docs)


STAGES = [
    ("language ID", language_id),
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", ngram_jaccard),
    ("mixing sources to target weights", source_mix),
    ("best-fit packing", sequence_packing),
]

#: Trained models and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs, f"pipeline-{k}")
    return docs
