"""Every text operator as a named query over its whole table, and in SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tarmac.llm import (
    conversations,
    exact_dedup,
    hard_negatives,
    html_text,
    language_model,
    neighbours,
    packing,
    pii,
    quality,
    sentence_pieces,
    simhash,
    token_files,
    toxicity,
)
from tarmac.llm.text import read


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    return toxicity.assessed(documents, toxicity.learned(documents, read(spark, sf_dir, "labels")))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = packing.pieces(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return packing.packed(found)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measures(read(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.decisions(read(spark, sf_dir, "documents"))


def op5_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.digests(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    return token_files.read(*token_files.write(documents, public_tokenizers.path("byte_bpe_50k.json"), end_id=2))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.located(read(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decisions(read(spark, sf_dir, "documents"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(read(spark, sf_dir, "pages"))


def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    return language_model.scored(documents, language_model.learned(language_model.training(documents)))


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations")
    return conversations.audited(conversations.damaged(rows), rows)


def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    return neighbours.nearest(rows, rows.where("vec_id % 50 = 0"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hard_negatives.relabelled(read(spark, sf_dir, "embeddings"))
    return hard_negatives.mined(rows, rows.where("vec_id % 100 = 0"))


_ALL = (
    op1_toxicity,
    op2_packing,
    op3_quality_rules,
    op4_simhash,
    op5_sentence_pieces,
    op6_token_files,
    op7_pii,
    op8_exact_dedup,
    op9_html_text,
    op10_lm_scores,
    op11_conversations,
    op12_neighbours,
    op13_hard_negatives,
)
QUERIES = {f.__name__: f for f in _ALL}

ORACLES = {"op3_quality_rules": quality.SQL, "op8_exact_dedup": exact_dedup.SQL, "op13_hard_negatives": hard_negatives.SQL}
