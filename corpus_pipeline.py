"""From raw documents to packed sequences: quality rules, language, exact copies, near copies, packing.

Each stage takes (spark, docs, sf_dir) and gives a table that is written as Parquet
and read again as the next one's docs. All but the last keep the columns of documents,
and any further ones; the last gives pieces of sequences (doc_id, start, length,
ids_crc32, doc_tokens, sequence_id, offset) and no other columns.

Null, empty and blank texts fail the base rules of the first stage and go. A null language or
source is a group of its own there. Rows without an id stay in the fourth stage, each by
itself; of rows equal in text one stays in the third. Ids are meant to be distinct. An
empty table gives no pieces. Texts are taken whole by every stage, however long.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from gridloom.llm import exact_dedup, language_id, ngram_join, packing, quality_rules
from gridloom.llm._spark import holdout
from gridloom.plans.shared import shared_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and their own group's thresholds."""
    return quality_rules.keep_good(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language, told without ambiguity."""
    return language_id.keep_known(docs, language_id.fit(docs, learn=~holdout("doc_id", 4, 2)))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: five-word shingles, a similarity of 0.8 or more."""
    return ngram_join.keep_one(docs, k=5, percent=80)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 tokens."""
    return packing.pack(docs)


STAGES = [("quality rules", quality), ("language ID", language), ("exact dedup", exact), ("n-gram Jaccard join", near), ("packing", packed)]

#: Merged tries, code-book classifiers, prefix trees and the tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        path = f"{shared_folder(spark)}/pipeline-{i}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
