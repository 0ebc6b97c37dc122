"""The registered queries of this subpackage and their DuckDB SQL.

Each query applies its operator with production parameters to its whole table
and derives the digest columns of its contract from the operator's output.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripmetrics.llm.common import read_table
from tripmetrics.llm.minhash import near_duplicates
from tripmetrics.llm import sql
from tripmetrics.llm.fingerprint import edited_neighbours
from tripmetrics.llm.langid import identify
from tripmetrics.llm.mixing import mix_sources
from tripmetrics.llm.ngram_join import jaccard_join
from tripmetrics.llm.quality import judge
from tripmetrics.llm.quoting import thread
from tripmetrics.llm.simplex import cluster_vectors
from tripmetrics.llm.spelling import variant_groups
from tripmetrics.llm.spiece import encode
from tripmetrics.llm.substring import drop_repeats
from tripmetrics.llm.toxicity import score_toxicity
from tripmetrics.llm.warc import archive_folder, read_archives, write_archives

PIECE_MODEL = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


def op1_minhash_near_dedup(spark: SparkSession, data_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, data_dir, "documents"), size=2, percent=80)


def op2_quality_rules(spark: SparkSession, data_dir: str) -> DataFrame:
    judged = judge(read_table(spark, data_dir, "documents"), read_table(spark, data_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )


def op3_toxicity(spark: SparkSession, data_dir: str) -> DataFrame:
    return score_toxicity(read_table(spark, data_dir, "documents"), read_table(spark, data_dir, "labels"))


def op4_sentencepiece(spark: SparkSession, data_dir: str) -> DataFrame:
    return encode(read_table(spark, data_dir, "documents"), PIECE_MODEL)


def op5_fingerprints(spark: SparkSession, data_dir: str) -> DataFrame:
    return edited_neighbours(read_table(spark, data_dir, "documents"))


def op6_source_mixing(spark: SparkSession, data_dir: str) -> DataFrame:
    return mix_sources(read_table(spark, data_dir, "documents")).documents


def op7_substring_dedup(spark: SparkSession, data_dir: str) -> DataFrame:
    return drop_repeats(read_table(spark, data_dir, "documents"), window=35)


def op8_language_id(spark: SparkSession, data_dir: str) -> DataFrame:
    return identify(read_table(spark, data_dir, "documents"))


def op9_warc_bundles(spark: SparkSession, data_dir: str) -> DataFrame:
    index = write_archives(read_table(spark, data_dir, "pages"), archive_folder(spark))
    return read_archives(index).drop("url")


def op10_chat_threads(spark: SparkSession, data_dir: str) -> DataFrame:
    return thread(read_table(spark, data_dir, "conversations"))


def op11_ngram_jaccard(spark: SparkSession, data_dir: str) -> DataFrame:
    return jaccard_join(read_table(spark, data_dir, "documents"), size=5, percent=80)


def op12_spelling_variants(spark: SparkSession, data_dir: str) -> DataFrame:
    return variant_groups(read_table(spark, data_dir, "documents"))


def op13_centroid_clusters(spark: SparkSession, data_dir: str) -> DataFrame:
    return cluster_vectors(read_table(spark, data_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_quality_rules": op2_quality_rules,
    "op3_toxicity": op3_toxicity,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_fingerprints": op5_fingerprints,
    "op6_source_mixing": op6_source_mixing,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_language_id": op8_language_id,
    "op9_warc_bundles": op9_warc_bundles,
    "op10_chat_threads": op10_chat_threads,
    "op11_ngram_jaccard": op11_ngram_jaccard,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_centroid_clusters": op13_centroid_clusters,
}

ORACLE_SQL: dict[str, str] = {
    "op1_minhash_near_dedup": sql.NEAR_DEDUP,
    "op7_substring_dedup": sql.SUBSTRING_DEDUP,
    "op9_warc_bundles": sql.WARC,
    "op11_ngram_jaccard": sql.JACCARD_JOIN,
    "op12_spelling_variants": sql.VARIANTS,
    "op13_centroid_clusters": sql.CLUSTERS,
}
