"""Registered queries of the text operators; each runs over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tallyloom.llm import (
    bytebpe, infill, jaccard, language, leaks, maintext, negatives, oracles, pieces, quotes, repeats, rules, secrets, shards,
)
from tallyloom.llm.common import table


PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.linked(table(spark, sf_dir, "conversations"))


def op2_trigram_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.listing(table(spark, sf_dir, "documents"))


def op3_output_code_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.fit(docs))


def op4_piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), pieces.read_model(PIECE_MODEL))


def op5_tiled_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op6_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_documents(table(spark, sf_dir, "documents"))


def op7_rule_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.measured(table(spark, sf_dir, "documents"))


def op8_text_to_tag_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintext.extract(table(spark, sf_dir, "pages"))


def op9_sparse_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeated_passages(table(spark, sf_dir, "documents"))


def op10_pigeonhole_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_secondary_sort_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mined(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.digests(table(spark, sf_dir, "documents"))


def op13_byte_merge_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytebpe.digests(table(spark, sf_dir, "documents"), bytebpe.read_ranks(BYTE_RANKS), public_tokenizers.PATTERN)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_quotation_links,
        op2_trigram_secret_scan,
        op3_output_code_language,
        op4_piece_round_trip,
        op5_tiled_jaccard_join,
        op6_hash_tree_shards,
        op7_rule_cascade,
        op8_text_to_tag_main_text,
        op9_sparse_suffix_repeats,
        op10_pigeonhole_leaks,
        op11_secondary_sort_negatives,
        op12_fill_in_middle,
        op13_byte_merge_fold,
        pipeline,
    )
}
ORACLES = oracles.ORACLES
