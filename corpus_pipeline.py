"""From raw documents to piece ids: quality rules, near duplicates, benchmark leaks, secrets, encoding.

Every stage takes (spark, docs, sf_dir) and works on all documents that the stage before has kept. All but the last
return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import jaccard, leaks, pieces, rules, secrets
from tallyloom.llm.common import cut, table

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return rules.keep_good(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard.one_of_each(docs)


def unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return leaks.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced."""
    return secrets.redacted(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of ids, the ids, and the text that they decode to."""
    ids = pieces.encoded(docs, pieces.read_model(PIECE_MODEL))
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality_rules", good),
    ("near_duplicates", distinct),
    ("benchmark_leaks", unleaked),
    ("secret_scans", without_secrets),
    ("piece_ids", encoded),
]

#: SQL has no shingle hashing, edit distance or piece merging; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table, each written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
