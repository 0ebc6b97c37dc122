"""Corpus preparation: quality rules, near-dedup, substring dedup, source mix, encoding.

``STAGES`` lists (name, function).  Each function takes ``(spark, docs, data_dir)``
and returns a DataFrame, which is written and read again as the next stage's
documents.  All but the last return the columns of ``documents``.

Null, empty and repeated rows follow each operator's module; an empty table
passes through all stages.  The encoding has no SQL form, so the pipeline is tested
against a brute-force version.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmetrics.llm.common import cut, ensure_checkpoint_dir, read_table
from tripmetrics.llm.minhash import near_duplicates
from tripmetrics.llm.mixing import mixed_documents
from tripmetrics.llm.quality import learn_rules, text_counts, verdicts
from tripmetrics.llm.queries import PIECE_MODEL
from tripmetrics.llm.spiece import encode
from tripmetrics.llm.substring import drop_repeats

#: of the encoding: its workers share their executors with the other stages' memory
MEMO, CHUNK = 100_000, 1 << 19
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, data_dir: str) -> DataFrame:
    """Documents that fail the base rules or meet a learned rule go."""
    labels = read_table(spark, data_dir, "labels")
    # rules are learned from labelled documents: only these are counted for it
    marked = labels.where("quality in (0, 1)").select(F.col("doc_id").cast("long").alias("id")).distinct()
    labelled = docs.join(marked, docs["doc_id"].cast("long") == marked["id"], "left_semi")
    rules = learn_rules(cut(text_counts(labelled)), labels)
    # the learned expression runs where the texts are, so that none is shuffled
    counts = text_counts(docs, carry=("text", "lang", "source", "n_chars"))
    return verdicts(counts, rules).where("kept").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, data_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays (of equal rows one)."""
    kept = near_duplicates(docs).where("kept").select(F.col("doc_id").alias("id")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["id"]), "left_semi").dropDuplicates(["doc_id", "text"]).select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, data_dir: str) -> DataFrame:
    """Words in repeated passages go; texts that lose none stay as they are."""
    out = drop_repeats(docs, window=35, with_text=True, carry=("lang", "source"))
    return out.withColumn("text", F.col("kept_text")).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def source_mixing(spark: SparkSession, docs: DataFrame, data_dir: str) -> DataFrame:
    """The mix: a row for each document and pass over its source."""
    return mixed_documents(docs.select(*COLUMNS))


def sentencepiece(spark: SparkSession, docs: DataFrame, data_dir: str) -> DataFrame:
    """Token ids of the best segmentation of every mixed text."""
    return encode(docs, PIECE_MODEL, memo=MEMO, chunk=CHUNK)


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("source_mixing", source_mixing),
    ("sentencepiece", sentencepiece),
]

ORACLE_SQL = None


def run(spark: SparkSession, data_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    root = f"{ensure_checkpoint_dir(spark)}/pipeline/{uuid.uuid4().hex}"
    docs = read_table(spark, data_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, data_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(f"{root}/{k}_{name}")
            docs = spark.read.parquet(f"{root}/{k}_{name}")
    return docs
