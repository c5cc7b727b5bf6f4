"""Corpus pipeline: quality rules, exact dedup, near dedup, personal data, packing.

Every stage takes texts of any length, rows that repeat, columns of any name beside its own, and an empty table, which
stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tarmac.llm import exact_dedup, packing, pii, quality, simhash
from tarmac.llm.text import read
from tarmac.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects. Null and empty texts are rejected; rows that repeat an id are judged one by one."""
    return quality.kept(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the smallest id. Null counts as empty; rows that share that id
    stay together, and a null id stays where its group has no other."""
    return exact_dedup.deduplicated(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by SimHash, the one with the smallest id. Null counts as empty; of rows that share
    that id one stays."""
    return simhash.representatives(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in their texts replaced by its kind. Null and empty texts stay as they are."""
    return pii.without(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as token pieces placed in sequences: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Null
    counts as empty, an empty document is the end id alone; rows that repeat an id are packed one by one."""
    return packing.packed(packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1))


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_copies),
    ("SimHash near-dedup", near_copies),
    ("personal data", personal_data),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``; each one's rows are written as Parquet and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "_"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


#: Tokens and near duplicates are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None
