"""The corpus pipeline: stages over documents, each written and read again by the next.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return the columns
of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import decontaminate, language, line_dedup, ngram_join, packing
from ledgerloom.llm.shared import scratch


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what language identification rejects. The languages are learned from the whole documents table."""
    return language.keep_identified(docs, language.learn(spark.read.parquet(f"{sf_dir}/documents.parquet")))


def remove_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes blocks of lines that an earlier document has too; documents that lose all their lines so go."""
    return line_dedup.dedup(docs, drop_emptied=True, more=None)


def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    return ngram_join.keep_first(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts benchmark passages out; drops documents that are mostly benchmark."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the documents' pieces in sequences."""
    return packing.packed(docs)


STAGES = [
    ("language ID", identify_language),
    ("line dedup", remove_shared_lines),
    ("n-gram Jaccard join", join_near_copies),
    ("benchmark decontamination", remove_benchmark),
    ("best-fit packing", pack_sequences),
]

#: SQL can't express the stages: compression, alignment and packing among them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = scratch(docs, name.replace(" ", "-"))
    return docs
