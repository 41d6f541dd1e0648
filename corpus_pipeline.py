"""A corpus pipeline in five stages over the training-data operators.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet and read again as the next one's docs.  All but the last return the
columns of ``documents``; stages work on all rows their predecessor kept.

Defined results: rows with NULLs, empty texts and repeated rows pass through the
operators as their modules say; of a class of near-duplicates one row with the
smallest doc_id stays (a row without a doc_id only where its class has none);
documents without words are no near-duplicates of each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroom.llm import decontaminate, jaccard, quality, toxicity
from tallyroom.llm.catalog import bpe_digests, default_tokenizer
from tallyroom.llm.common import Workspace, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as good ones; learns from all labels of the documents at hand."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return quality.keep_good(docs, quality.fit(docs, labels))


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not score as toxic; learns from all labels of the documents at hand."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    labels = labels.join(docs.select("doc_id"), "doc_id", "left_semi")
    return toxicity.keep_clean(docs, toxicity.fit(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, unchanged."""
    with Workspace(spark, "near-duplicates") as space:
        return space.keep(jaccard.representatives(docs, space))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of benchmark phrases; one that has no other words goes."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def bpe_round_trip(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document with their digests, and those of the decoded bytes."""
    return bpe_digests(docs, default_tokenizer())


STAGES = [
    ("quality classifier", quality_classifier),
    ("toxicity", toxicity_filter),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("byte-level BPE", bpe_round_trip),
]

#: Trained models decide which rows stay, so SQL has no way to say it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    with Workspace(spark, "pipeline") as space:
        for _, stage in STAGES[:-1]:
            docs = space.step(stage(spark, docs, sf_dir))
        return space.keep(STAGES[-1][1](spark, docs, sf_dir))
