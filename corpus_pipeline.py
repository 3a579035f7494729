"""Cleaning and packing of `documents`: stages that each apply one operator to what the last one kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import decontaminate, ngram_join, packing, secrets, toxicity
from quayside.llm.common import Scratch, ship, table

WORD_BPE = "word_bpe_49k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier, learned from all labels, does not reject."""
    ship(spark)
    return toxicity.not_toxic(docs, table(spark, sf_dir, "labels"))


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by n-gram similarity, the one with the smallest doc_id."""
    ship(spark)
    return ngram_join.one_of_each(docs, Scratch(spark, "copies"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose share of benchmark words stays under the limit; they are left as they are."""
    ship(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), Scratch(spark, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with found secrets replaced by a mark."""
    ship(spark)
    return secrets.redacted(docs, public_tokenizers.path(WORD_BPE))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents at their places in sequences, with a checksum of their ids."""
    ship(spark)
    pieces = packing.packed(docs, public_tokenizers.path(WORD_BPE))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", keep_one_copy),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scans", redact_secrets),
    ("packing", pack),
]

# The classifier, the forest and the tokenizer cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written and read by the next."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir))
    return docs
