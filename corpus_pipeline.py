"""A corpus-cleaning pipeline over the documents table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinis.llm import decontaminate, packing, secrets, simhash, toxicity
from affinis.llm.common import forget_since, give_back, row_hash, table, without_rows, written, written_so_far


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the toxicity model rejects."""
    give_back(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row with the smallest doc_id of each group of near copies."""
    give_back(spark)
    return simhash.without_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold benchmark items, also with other values in their slots."""
    give_back(spark)
    rows = docs.select(row_hash(docs).alias("doc_id"), "text")  # a row is one document, whatever its doc_id
    leaks = decontaminate.find_leaks(rows, table(spark, sf_dir, "benchmark"))
    return without_rows(docs, written(leaks.select(F.col("doc_id").alias("hash")).distinct(), "leaks"))


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces the secrets in every text by their kind; all documents stay."""
    give_back(spark)
    return secrets.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 4096 tokens."""
    give_back(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity_filter),
    ("simhash_near_dedup", simhash_near_dedup),
    ("decontamination", decontamination),
    ("secret_scans", secret_redaction),
    ("best_fit_packing", best_fit_packing),
]

#: SQL cannot express the first, second and last stage; tests hold the stages against brute force on small tables.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over documents, each written as Parquet and read again by the next; a stage's own tables go once it is written."""
    docs, mark = table(spark, sf_dir, "documents"), written_so_far()
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
        forget_since(spark, mark, docs)
    return STAGES[-1][1](spark, docs, sf_dir)
